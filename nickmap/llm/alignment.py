"""Alignment of two tokenizers over the same texts, by an associative monoid of fragments.

Byte offsets where tokens of both end cut a text's tokens into groups. A fragment is what a byte range knows of them: an
open prefix up to its first cut, closed groups, and an open suffix behind its last cut. Fragments of neighbouring ranges
compose in any bracketing, so a very long document is cut into ranges that Spark's tasks align by themselves, and a tree
of compositions puts it together. Tokens of the two that share a byte are linked, and the links are held to how many
documents of the whole corpus have them.

Neither tokenizer joins a single space between other characters to what stands before it, so texts are encoded by pieces
between such spaces, and a worker remembers the pieces it has met.
"""

from __future__ import annotations

import functools
import hashlib
import json
import pickle
import re
import zlib
from array import array
from typing import NamedTuple

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .tokens import _AT_SPACE, _BYTE, LONGEST, Encoder, tokenizer_path

#: Code points of a byte range of a long document; its bounds are moved to a cut where none lies within NEAR.
RANGE, NEAR = 32_768, 4_096
#: Characters of the documents that make a block, and fragments that are composed at once.
BLOCK, FAN = 4_000_000, 16
#: Pieces a worker remembers, in each of two generations.
REMEMBERED = 500_000

_BYTES_OF = {c: b for b, c in _BYTE.items()}
_HEX = re.compile(r"<0x([0-9A-F]{2})>")
_NONE = np.zeros(0, np.int64)


class Tokens(NamedTuple):
    """Ids of both tokenizers and the byte offsets at which they end."""

    a: np.ndarray = _NONE
    a_end: np.ndarray = _NONE
    b: np.ndarray = _NONE
    b_end: np.ndarray = _NONE

    def then(self, other: Tokens) -> Tokens:
        return Tokens(*map(np.concatenate, zip(self, other, strict=True)))

    def within(self, low: int, high: int) -> Tokens:
        """Those that end behind ``low`` and up to ``high``."""
        (i, j), (k, m) = np.searchsorted(self.a_end, [low, high], "right"), np.searchsorted(self.b_end, [low, high], "right")
        return Tokens(self.a[i:j], self.a_end[i:j], self.b[k:m], self.b_end[k:m])


class Fragment(NamedTuple):
    """What a byte range knows of the groups; without a cut all its tokens are ``prefix``."""

    prefix: Tokens = Tokens()
    cut: bool = False
    groups: bytes = b""
    n_groups: int = 0
    codes: np.ndarray = _NONE
    counts: np.ndarray = _NONE
    suffix: Tokens = Tokens()
    n_a: int = 0
    n_b: int = 0
    #: Whether the tokens' bytes are those of the text.
    same: bool = True


@functools.lru_cache(maxsize=2)
def _names(n: int) -> list[bytes]:
    """Ids as texts, each with a comma, a bar and a semicolon behind it."""
    return [b"%d%c" % (i, c) for i in range(n) for c in b",|;"]


def _counted(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and how often each occurs, or the sums of their ``counts``."""
    if not len(codes):
        return _NONE, _NONE
    order = np.argsort(codes, kind="stable") if counts is not None else None
    codes = np.sort(codes) if order is None else codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.diff(np.append(first, len(codes))) if order is None else np.add.reduceat(counts[order], first)


def _cuts(t: Tokens) -> np.ndarray:
    """Offsets at which tokens of both end."""
    ends = np.sort(np.concatenate([t.a_end, t.b_end]), kind="stable")
    return ends[1:][ends[1:] == ends[:-1]]


def _grouped(t: Tokens, width: int) -> tuple[np.ndarray, bytes, int]:
    """Codes of all links, the text of the groups, and their number, of tokens that begin and end at cuts.

    The ends of both are merged. Each stretch between neighbouring ends is one link, that of the two tokens in which it
    lies; an end of both closes a group."""
    n = len(t.a)
    if not n:
        return _NONE, b"", 0
    ends = np.concatenate([t.a_end, t.b_end])
    order = np.argsort(ends, kind="stable")  # of equal ends that of the first tokenizer comes first
    ends, is_a = ends[order], order < n
    both = np.append(False, ends[1:] == ends[:-1])
    a_seen = np.cumsum(is_a)
    b_seen = np.arange(1, len(ends) + 1) - a_seen
    last = np.flatnonzero(np.append(~both[1:], True))
    codes = t.a[a_seen[last] - (both | is_a)[last]].astype(np.int64) * width + t.b[b_seen[last] - (both | ~is_a)[last]]
    cut, of = np.flatnonzero(both), np.cumsum(both) - both
    place = np.where(is_a, a_seen - 1 + np.append(0, b_seen[cut])[of], b_seen - 1 + a_seen[cut][of])
    # Ids with what stands behind them: a bar behind a group's last of the first tokenizer, a semicolon behind its last one.
    ids = np.concatenate([t.a, t.b]).astype(np.int64)[order] * 3 + np.where(np.append(both[1:], False), 1, 0) + 2 * both
    shown = np.empty(len(ids), np.int64)
    shown[place] = ids
    names = _names(1 << max(17, int(ids.max() // 3).bit_length()))
    return codes, b"".join(map(names.__getitem__, shown.tolist()))[:-1], len(cut)


def fragment_of(t: Tokens, width: int, same: bool = True) -> Fragment:
    """The fragment of a byte range from the tokens that end in it; ``width`` is above all ids of the second tokenizer."""
    cuts = _cuts(t)
    if not len(cuts):
        return Fragment(t, n_a=len(t.a), n_b=len(t.b), same=same)
    codes, groups, n = _grouped(t.within(cuts[0], cuts[-1]), width)
    return Fragment(t.within(-1, cuts[0]), True, groups, n, *_counted(codes), t.within(cuts[-1], 1 << 62), len(t.a), len(t.b), same)


def compose(f: Fragment, g: Fragment, width: int) -> Fragment:
    """The fragment of two neighbouring ranges; associative, with ``Fragment()`` as its neutral element."""
    both = {"n_a": f.n_a + g.n_a, "n_b": f.n_b + g.n_b, "same": f.same and g.same}
    if not f.cut:
        return g._replace(prefix=f.prefix.then(g.prefix), **both)
    if not g.cut:
        return f._replace(suffix=f.suffix.then(g.prefix), **both)
    middle = f.suffix.then(g.prefix)
    links, text, _ = _grouped(middle, width)
    codes, counts = _counted(np.concatenate([f.codes, links, g.codes]), np.concatenate([f.counts, np.ones(len(links), np.int64), g.counts]))
    return Fragment(f.prefix, True, b";".join(x for x in (f.groups, text, g.groups) if x), f.n_groups + 1 + g.n_groups, codes, counts, g.suffix, **both)


def closed(f: Fragment, width: int) -> Fragment:
    """A whole text's fragment with its first group closed. All is empty where the tokens' bytes aren't the text's."""
    if not f.same or not f.cut:
        return Fragment(same=f.same)
    return compose(Fragment(cut=True), f, width)


class Aligner:
    """Both tokenizers: a byte-level one of the tokenizers library, which is given a space and the text, and one of
    sentencepiece, which adds that space itself. Special tokens' strings inside a text are plain text."""

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.plain, self.b = Encoder(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a = self.plain.tokenizer
        self.a.encode_special_tokens = True
        self.width = self.b.get_piece_size()
        self.a_bytes = [bytes(map(_BYTES_OF.get, x)) if x and set(x) <= set(_BYTES_OF) else (x or "").encode() for x in map(self.a.id_to_token, range(self.a.get_vocab_size()))]
        self.b_bytes = [bytes([int(m[1], 16)]) if self.b.is_byte(i) and (m := _HEX.fullmatch(x)) else x.replace("▁", " ").encode() for i, x in enumerate(map(self.b.id_to_piece, range(self.width)))]
        #: Pieces can be encoded by themselves if the first tokenizer parts words before their space and no token of the
        #: second has a space behind anything but spaces.
        settings = json.loads(self.a.to_str())
        words = settings["pre_tokenizer"] or {}
        #: Byte-level tokens without a normaliser are the text's bytes.
        self.exact = words.get("type") == "ByteLevel" and not words.get("add_prefix_space") and settings["normalizer"] is None
        self.parts = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not any(re.search(rb"[^ ] ", x) for x in self.b_bytes)
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.known: tuple[dict, dict] = ({}, {})

    def _first(self, piece: str) -> bytes:
        """Ids of the first tokenizer for a space and a piece."""
        ids = self.plain._plain(piece, "Ġ") if self.parts else None
        return self.plain._packed(self.a.encode(f" {piece}", add_special_tokens=False).ids) if ids is None else ids

    def encoded(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids of both tokenizers for pieces, each with the space before it."""
        new, old = self.known
        found = list(map(new.get, pieces))
        if None in found:
            unknown = {p for p, x in zip(pieces, found, strict=True) if x is None}
            missing = [p for p in unknown if p not in old]
            pack = lambda ids: array("i", ids).tobytes()
            here = dict(zip(missing, zip(map(self._first, missing), map(pack, self.b.encode(missing, num_threads=1)), strict=True), strict=True))
            here |= {p: old[p] for p in unknown if p not in here}
            found = [here[p] if x is None else x for p, x in zip(pieces, found, strict=True)]
            if len(new) + len(here) > REMEMBERED:
                self.known = new, old = {}, new
            new.update((p, x) for p, x in here.items() if len(p) <= LONGEST)
        return found

    def tokens(self, text: str) -> tuple[Tokens, bool]:
        """Tokens of a space and ``text``, and whether their bytes are the same as its own."""
        packed_a, packed_b = zip(*self.encoded(self.pieces(text)), strict=True)
        a, b = np.frombuffer(b"".join(packed_a), self.plain.dtype), np.frombuffer(b"".join(packed_b), np.int32)
        own = f" {text}".encode()
        same = (self.exact or b"".join(map(self.a_bytes.__getitem__, a.tolist())) == own) and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == own
        return Tokens(a, np.cumsum(self.a_size[a]), b, np.cumsum(self.b_size[b])), same

    def pieces(self, text: str) -> list[str]:
        return _AT_SPACE.split(text) if self.parts else [text]

    def whole(self, text: str | None) -> Fragment:
        """The closed fragment of a text."""
        if not text:
            return Fragment()
        t, same = self.tokens(text)
        if not same:
            return Fragment(same=False)
        codes, groups, n = _grouped(t, self.width)
        return Fragment(Tokens(), True, groups, n, *_counted(codes), n_a=len(t.a), n_b=len(t.b))

    def ranges(self, text: str, size: int = RANGE, near: int = NEAR):
        """Byte ranges of a space and ``text``: piece texts that hold the range whole, the offset of their first byte, and
        the range's bounds. Bounds lie ``size`` characters apart and anywhere in a word; where a word of over ``near``
        characters lies there, the bound is its end, so no character is in more than two ranges."""
        v, bounds, around = f" {text}", [0], [(0, 0)]
        while bounds[-1] + size < len(v) and self.parts:
            x = bounds[-1] + size
            before = [m.start() for m in _AT_SPACE.finditer(v, max(1, x - near), min(len(v), x + 2)) if m.start() <= x]
            after = _AT_SPACE.search(v, x)
            end = after.start() if after else len(v)
            if not before or end - x > near:
                x, before = end, [end]
            if x >= len(v):
                break
            bounds.append(x)
            around.append((before[-1], end))
        bounds.append(len(v))
        around.append((len(v), len(v)))
        at, offset = 0, 0
        for k in range(len(bounds) - 1):
            first, last = around[k][0], around[k + 1][1]
            offset, at = offset + len(v[at:first].encode()), first
            low = offset + len(v[first : bounds[k]].encode())
            yield v[first + 1 : last], offset, low, low + len(v[bounds[k] : bounds[k + 1]].encode())

    def fragment(self, text: str, offset: int, low: int, high: int) -> Fragment:
        """The fragment of one of ``ranges``: tokens that end within it."""
        t, same = self.tokens(text)
        return fragment_of(Tokens(t.a, t.a_end + offset, t.b, t.b_end + offset).within(low, high), self.width, same)


@functools.lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def _packed(rows: list[tuple], fragments: list[Fragment], digests: bool) -> tuple[bytes, bytes]:
    """A block: its distinct codes, and of each document the places of its codes among them."""
    codes = np.unique(np.concatenate([f.codes for f in fragments]))
    named = lambda f: hashlib.sha256(f.groups).digest() if digests and f.n_groups else f.groups
    docs = [(key, f.n_a, f.n_b, f.n_groups, named(f), np.diff(np.searchsorted(codes, f.codes), prepend=0).astype("<u4").tobytes(), f.counts.astype("<u4").tobytes()) for key, f in zip(rows, fragments, strict=True)]
    return codes.tobytes(), zlib.compress(pickle.dumps(docs), 1)


BLOCKS = "block long, codes binary, docs binary"


def _short(docs: DataFrame, a: str, b: str, digests: bool) -> DataFrame:
    """Blocks of documents of up to RANGE characters."""

    def align(batches):
        import pyarrow as pa

        part, n, al = TaskContext.get().partitionId(), 0, aligner(a, b)
        for batch in batches:
            keys, texts, at = batch.column("doc_id").to_pylist(), batch.column("text"), 0
            while at < len(keys):
                fragments, size = [], 0
                while at + len(fragments) < len(keys) and size < BLOCK:
                    text = texts[at + len(fragments)].as_py()
                    size += len(text or "")
                    fragments.append(al.whole(text))
                block = _packed(keys[at : at + len(fragments)], fragments, digests)
                yield pa.RecordBatch.from_arrays([pa.array([(part << 33) + n], pa.int64()), pa.array([block[0]], pa.binary()), pa.array([block[1]], pa.binary())], ["block", "codes", "docs"])
                at, n = at + len(fragments), n + 1

    return docs.select("doc_id", "text").mapInArrow(align, BLOCKS)


def _long(docs: DataFrame, a: str, b: str, digests: bool) -> DataFrame:
    """Blocks of one document each: its ranges are dealt out, and their fragments composed in a tree."""

    def cut(batches):
        import pyarrow as pa

        al = aligner(a, b)
        for batch in batches:
            for key, doc_id, text in zip(*(batch.column(x) for x in ("key", "doc_id", "text")), strict=True):
                cuts = list(al.ranges(text.as_py()))
                n = len(cuts)
                texts, offsets, lows, highs = zip(*cuts, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * n, pa.int64()), pa.array([doc_id.as_py()] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts, pa.string()), *(pa.array(x, pa.int64()) for x in (offsets, lows, highs))], ["key", "doc_id", "part", "text", "offset", "low", "high"])

    ranges = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text").mapInArrow(cut, "key long, doc_id long, part long, text string, offset long, low long, high long")

    def measure(batches):
        import pyarrow as pa

        al = aligner(a, b)
        for batch in batches:
            for row in range(batch.num_rows):
                text, offset, low, high = (batch.column(x)[row].as_py() for x in ("text", "offset", "low", "high"))
                blob = pickle.dumps(al.fragment(text, offset, low, high))
                yield pa.RecordBatch.from_arrays([*(batch.column(x).slice(row, 1) for x in ("key", "doc_id", "part")), pa.array([blob], pa.binary())], ["key", "doc_id", "part", "blob"])

    def merge(batches):
        import pyarrow as pa

        al = aligner(a, b)
        for batch in batches:
            for row in range(batch.num_rows):
                blobs = sorted(batch.column("blobs")[row].as_py(), key=lambda x: x["part"])
                f = functools.reduce(lambda x, y: compose(x, y, al.width), (pickle.loads(x["blob"]) for x in blobs), Fragment())
                yield pa.RecordBatch.from_arrays([*(batch.column(x).slice(row, 1) for x in ("key", "doc_id", "part")), pa.array([pickle.dumps(f)], pa.binary())], ["key", "doc_id", "part", "blob"])

    schema = "key long, doc_id long, part long, blob binary"
    fragments = written(written(ranges, "ranges").repartition("key", "part").mapInArrow(measure, schema), "fragments")
    last = fragments.agg(F.max("part")).first()[0] or 0
    while last:
        tree = fragments.groupBy("key", "doc_id", F.floor(F.col("part") / FAN).alias("part")).agg(F.collect_list(F.struct("part", "blob")).alias("blobs"))
        fragments, last = written(tree.mapInArrow(merge, schema), "fragments"), last // FAN

    def close(batches):
        import pyarrow as pa

        al = aligner(a, b)
        for batch in batches:
            for key, doc_id, blob in zip(*(batch.column(x) for x in ("key", "doc_id", "blob")), strict=True):
                block = _packed([doc_id.as_py()], [closed(pickle.loads(blob.as_py()), al.width)], digests)
                yield pa.RecordBatch.from_arrays([pa.array([-1 - key.as_py()], pa.int64()), pa.array([block[0]], pa.binary()), pa.array([block[1]], pa.binary())], ["block", "codes", "docs"])

    return fragments.mapInArrow(close, BLOCKS)


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """block, k, code, n: each distinct code of a block, its place in the block, and how many documents there hold it."""

    def spread(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                codes = np.frombuffer(batch.column("codes")[row].as_py(), np.int64)
                held = [np.cumsum(np.frombuffer(x[5], "<u4").astype(np.int64)) for x in pickle.loads(zlib.decompress(batch.column("docs")[row].as_py()))]
                n = np.bincount(np.concatenate(held), minlength=len(codes))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), batch.column("block")[row].as_py())), pa.array(np.arange(len(codes), dtype=np.int32)), pa.array(codes), pa.array(n.astype(np.int64))], ["block", "k", "code", "n"])

    return blocks.mapInArrow(spread, "block long, k int, code long, n long")


def pair_counts(pairs: DataFrame, width: int) -> DataFrame:
    """code, n, best: in how many documents each linked pair occurs, and whether no other pair of its first id has more."""
    counts = written(pairs.groupBy("code").agg(F.sum("n").alias("n")), "pair-counts").withColumn("a", F.floor(F.col("code") / width))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, a: str, b: str, digests: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups for each of ``docs`` (doc_id, text).

    ``a`` is a byte-level file of the tokenizers library, ``b`` a sentencepiece model; both read a space and the text.
    ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of the ids of each group, with ``digests`` groups_sha256 in its place. A
    link is a pair of tokens that share a byte; count_sum adds up in how many documents each link's pair of ids is linked,
    n_best counts links whose pair has as many as any pair of its first id. Texts that are null or empty or that either
    tokenizer doesn't give back byte by byte have zeros and an empty text. Null ids and repeated rows are documents like
    others; further columns are ignored; an empty table gives an empty result.

    Documents travel in blocks. A block's distinct pairs are joined to the corpus's counts, so links are never rows.
    """
    is_long = F.coalesce(F.length("text") > RANGE, F.lit(False))
    blocks = written(_short(docs.where(~is_long), a, b, digests).unionByName(_long(docs.where(is_long), a, b, digests)), "blocks")
    pairs = written(_block_pairs(blocks), "block-pairs")
    scored = pairs.select("block", "k", "code").join(pair_counts(pairs, aligner(a, b).width), "code")
    looked_up = scored.groupBy("block").agg(F.collect_list(F.struct("k", "n", "best")).alias("found"))
    text = "groups_sha256" if digests else "groups"
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def resolve(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                found = batch.column("found").slice(row, 1).flatten()
                k, n, best = (found.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in range(3)) if len(found) else (_NONE,) * 3
                of = np.zeros((2, len(k)), np.int64)
                of[:, k] = n, best
                rows, keys, texts = [], [], []
                for key, n_a, n_b, n_groups, groups, places, counts in pickle.loads(zlib.decompress(batch.column("docs")[row].as_py())):
                    at, m = np.cumsum(np.frombuffer(places, "<u4").astype(np.int64)), np.frombuffer(counts, "<u4").astype(np.int64)
                    rows.append((n_a, n_b, n_groups, int(m.sum()), int((of[1, at] * m).sum()), int((of[0, at] * m).sum())))
                    keys.append(key)
                    texts.append(groups.hex() if digests else groups.decode())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array(x, pa.int64()) for x in zip(*rows, strict=True)), pa.array(texts, pa.string())], ["doc_id", *names, text])

    return blocks.select("block", "docs").join(looked_up, "block", "left").select("found", "docs").mapInArrow(resolve, f"doc_id long, {', '.join(f'{x} long' for x in names)}, {text} string")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), digests=True)
