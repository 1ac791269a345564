"""Document fingerprints by I-Match: only terms within a band of inverse document frequency count, and the sorted
distinct terms of a document within each of several random subsets of that lexicon are hashed.

A subset's hash is equal for two texts where none of their differing terms lies in it, so subsets of several densities
give a graded likeness: the share of equal hashes among those that either text has.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: The band, as shares of the documents that hold a term. There are at most (mean distinct terms of a document) / LEAST
#: terms in it, however many documents there are, so the lexicon can be sent to every task.
LEAST, MOST = 0.001, 0.2
#: Subsets of the lexicon: so many of each density 1/2, 1/4, ... The sparse ones tell long texts of which half differs.
DENSITIES, EACH = 12, 8
#: Bytes of text in a range of neighbours, about.
RANGE = 64 << 20
#: Distinct terms a task counts before it hands its counts on.
COUNTED = 500_000
_TERM = re.compile(r"\w+")
_NONE = b"\0\0"


def terms(text: str | None) -> set[str]:
    return set(_TERM.findall(text.lower())) if text else set()


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST) -> frozenset[int]:
    """Hashes of the terms whose document frequency over all of ``docs`` (text) lies within the band."""
    from xxhash import xxh64_intdigest

    def count(batches):
        import pyarrow as pa

        def rows(counts, n):
            keys = np.fromiter((xxh64_intdigest(k.encode(errors="replace")) for k in counts), np.uint64, len(counts)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array([None, *keys.tolist()], pa.int64()), pa.array([n, *counts.values()], pa.int64())], ["term", "n"])

        counts, n = Counter(), 0
        for batch in batches:
            for text in batch.column("text"):
                counts.update(terms(text.as_py()))
                n += 1
                if len(counts) > COUNTED:
                    yield rows(counts, n)
                    counts, n = Counter(), 0
        yield rows(counts, n)

    counted = written(docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")), "frequencies")
    total = counted.where("term is null").select(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    band = counted.where(F.col("term").isNotNull() & (F.col("n") >= max(2, least * total)) & (F.col("n") <= most * total)).select("term").toArrow()
    return frozenset(np.sort(band.column("term").to_numpy()).view(np.uint64).tolist())


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Spreads 64-bit numbers by multiplying and shifting, a stream of its own for each salt."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(salt + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


class _Known(dict):
    """Hash of a term of the lexicon, None for other terms."""

    def __init__(self, known: frozenset[int]):
        super().__init__()
        self.known = known

    def __missing__(self, term: str) -> int | None:
        from xxhash import xxh64_intdigest

        if len(self) >= COUNTED:
            self.clear()
        h = xxh64_intdigest(term.encode(errors="replace"))
        self[term] = h = h if h in self.known else None
        return h


class Fingerprinter:
    """Fingerprints under a lexicon: DENSITIES * EACH hashes of two bytes, of which 0 marks an empty subset.

    A subset's hash is that of its terms in the text, distinct and sorted (by their own hashes). A text with terms but none
    in the lexicon is told by all its terms, in one subset of its own beside empty ones; a text without terms has empty
    subsets only. Texts with equal terms have equal fingerprints.
    """

    def __init__(self, known: frozenset[int]):
        self.memory = _Known(known)
        self.lexicon = np.sort(np.fromiter(known, np.uint64, len(known)))
        # Subset d * EACH + i holds a term where d + 1 bits of a number of its own are zero.
        held = [np.flatnonzero(_mixed(self.lexicon, s) >> np.uint64(63 - s // EACH) == 0) for s in range(DENSITIES * EACH)]
        place, subset = np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.uint8), [len(x) for x in held])
        order = np.argsort(place, kind="stable")
        self.subsets = subset[order]  # those of each term, one term after another
        self.starts = np.searchsorted(place[order], np.arange(len(self.lexicon) + 1))

    def digest(self, text: str | None) -> bytes:
        from xxhash import xxh32_intdigest

        found = terms(text)
        inside = [h for h in map(self.memory.__getitem__, found) if h is not None]
        if not inside:
            whole = (xxh32_intdigest(" ".join(sorted(found)).encode(errors="replace")) % 0xFFFF + 1).to_bytes(2, "big") if found else _NONE
            return whole + _NONE * (DENSITIES * EACH - 1)
        inside = np.sort(np.array(inside, np.uint64))
        places = np.searchsorted(self.lexicon, inside)
        n = self.starts[places + 1] - self.starts[places]
        ends = np.cumsum(n)
        subsets = self.subsets[np.arange(ends[-1]) + np.repeat(self.starts[places + 1] - ends, n)]
        order = np.argsort(subsets, kind="stable")
        bounds = np.searchsorted(subsets[order], np.arange(DENSITIES * EACH + 1)).tolist()
        each = memoryview(np.repeat(inside, n)[order].astype("<u8").tobytes())
        codes = [xxh32_intdigest(each[8 * a : 8 * b]) % 0xFFFF + 1 if a < b else 0 for a, b in zip(bounds, bounds[1:], strict=False)]
        return np.array(codes, ">u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal hashes among the subsets that either fingerprint has; 1 for two without any."""
    x, y = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
    either = (x != 0) | (y != 0)
    return float((x == y)[either].mean()) if either.any() else 1.0


def fingerprints(docs: DataFrame, known: frozenset[int]) -> DataFrame:
    """doc_id and fingerprint for each row of ``docs`` (doc_id, text); a null text is an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("string")
    def own(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = Fingerprinter(sent.value)
        for text in texts:
            yield text.map(lambda x: f.digest(x).hex(), na_action=None)

    return docs.select("doc_id", own("text").alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, known: frozenset[int]) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), of each text with its second half replaced, and their likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document in descending doc_id, the last taking the first. Null texts are empty; null ids come last; repeated ids
    follow one another in the order of their fingerprints, null ids in that of a hash of their texts; further columns are ignored; an empty table gives an empty result.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are dealt by id into ranges, null ids by a hash of their text, and each range is also sent the first
    document of the next one, so neighbours meet in one shuffle of the texts, which travel compressed. There are as many
    ranges and tasks as the size of the texts asks for.
    """
    import zstandard

    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(known)

    def squeeze(batches):
        import pyarrow as pa

        f, z = Fingerprinter(sent.value), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                texts = [x.as_py() or "" for x in some.column("text")]
                yield pa.RecordBatch.from_arrays([some.column("doc_id").cast(pa.int64()), some.column("spread").cast(pa.int64()), pa.array([z.compress(x.encode(errors="replace")) for x in texts], pa.binary()), pa.array([f.digest(x) for x in texts], pa.binary())], ["doc_id", "spread", "body", "print"])

    spread = F.when(F.col("doc_id").isNull(), F.xxhash64(F.coalesce("text", F.lit(""))))  # orders null ids
    base = docs.select("doc_id", "text", spread.alias("spread"))
    keys = written(base.select("doc_id", "spread", F.octet_length("text").alias("size")), "ids")
    size, n = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    ranges = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // RANGE)), max(1, n))
    # Ranges of about equal numbers of rows, counted from the highest ids; those of null ids are behind all.
    cut = lambda name: F.percentile_approx(name, [i / ranges for i in range(1, ranges)] or [0.5], 10_000)
    cuts = keys.agg(cut("doc_id").alias("ids"), cut("spread").alias("spreads")).first()
    ids, spreads = sorted(set(cuts["ids"] or [])), sorted(set(cuts["spreads"] or []))
    sent_cuts = lambda x: F.array(*[F.lit(c) for c in x]).cast("array<long>")
    above = F.size(F.filter(sent_cuts(ids), lambda c: c > F.col("doc_id")))
    at = F.when(F.col("doc_id").isNull(), len(ids) + 1 + F.size(F.filter(sent_cuts(spreads), lambda c: c <= F.col("spread")))).otherwise(above)
    # One row for each range: its first document is also dealt to the range before, that of the first range to the last.
    firsts = keys.groupBy(at.alias("at")).agg(F.max("doc_id").alias("first"), F.min("spread").alias("spread")).orderBy("at").collect()
    lowest = -(1 << 63)
    mapped = lambda pairs: F.create_map(*[F.lit(x) for pair in [(-1, lowest), *pairs] for x in pair])[F.col("at")]
    first, before = mapped([(r["at"], r["spread"] if r["first"] is None else r["first"]) for r in firsts]), mapped([(r["at"], firsts[i - 1]["at"]) for i, r in enumerate(firsts)])
    host = F.when(F.coalesce("doc_id", "spread") == first, before.cast("int"))
    places = F.array_compact(F.array(F.struct("at", F.lit(False).alias("guest")), F.when(host.isNotNull(), F.struct(host.alias("at"), F.lit(True).alias("guest")))))
    squeezed = base.mapInArrow(squeeze, "doc_id long, spread long, body binary, print binary").withColumn("at", at)
    dealt = squeezed.withColumn("place", F.explode(places)).select("doc_id", "spread", "body", "print", "place.at", "place.guest").repartition(max(1, len(firsts)), "at")
    after = Window.partitionBy("at").orderBy("guest", F.desc_nulls_last("doc_id"), "spread", "print", "body")
    neighbours = dealt.withColumn("next_body", F.lead("body").over(after)).withColumn("next_print", F.lead("print").over(after)).where("not guest")

    def edit(batches):
        import pyarrow as pa

        f, z = Fingerprinter(sent.value), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                rows = []
                for doc_id, body, own, next_body, next_print in zip(*(some.column(x).to_pylist() for x in ("doc_id", "body", "print", "next_body", "next_print")), strict=True):
                    text, other = z.decompress(body).decode(), z.decompress(next_body).decode()
                    cut = len(text) // 2
                    edited = text[: len(text) - cut] + other[:cut]
                    changed = f.digest(edited)
                    rows.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.hex(), changed.hex(), likeness(own, changed), likeness(own, next_print)))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return neighbours.mapInArrow(edit, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edited_fingerprints(docs, lexicon(docs))
