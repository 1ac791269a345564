"""Repeated byte strings of highly repetitive text, by prefix-free parsing.

A rolling hash of GRAM bytes triggers: of all grams of a window (a string of LENGTH bytes) the one with the least hash ends
its phrase, wherever the window lies, so equal windows are parsed alike. A trigger and the windows that chose it are one
entry of the parse: the end of a phrase to its left, the start of the next phrases to its right. Entries with equal
bytes are one entry of the dictionary, which keeps the first place in the corpus only, so copied text is handled once.
Where entries with different bytes share a trigger, the dictionary's suffixes (what stands to the left, read from the
trigger) and the parse's suffixes (what stands to the right) are sorted, and both orders with their common prefixes tell
which windows are equal.

Triggers with many entries are divided by more of their windows' bytes, until few entries or a whole window is left.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import likely, table, written

#: Bytes of a trigger, and of the strings that count as repeats.
GRAM, LENGTH = 24, 100
#: Bytes that are parsed at once, and so many of these stretches whose entries are combined before a shuffle.
STRETCH, STRETCHES = 1 << 20, 8
#: Entries of a trigger that are sorted together.
CROWD = 1000
#: Entries that are sorted at once, of all triggers.
SORTED = 60_000
_ENTRY = "key long, content long, id long, h long, start long, low int, high int, again boolean"


# Parsing


def _cuts(texts: Iterable[tuple[int, bytes]], length: int, stretch: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Stretches of about ``stretch`` bytes: parts of texts as the text's number, the part's offset there, and its bytes.
    Parts of one text overlap, so that each window lies in one part."""
    parts, held = [], 0
    for k, text in texts:
        at = 0
        while len(text) - at >= length:
            part = text[at : at + stretch]
            parts.append((k, at, part))
            held += len(part)
            if held >= stretch:
                yield parts
                parts, held = [], 0
            if at + len(part) >= len(text):
                break
            at += len(part) - length + 1
    if parts:
        yield parts


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters' values, and powers of the rolling hash's base and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    letters = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
    return letters, np.multiply.accumulate(np.full(n, base, np.uint64)), np.multiply.accumulate(np.full(n, pow(base, -1, 1 << 64), np.uint64))


def rolling_hashes(x: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of each run of ``gram`` bytes."""
    letters, up, down = _powers(max(1 << 21, 1 << len(x).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(letters[x] * down[: len(x)], dtype=np.uint64)])
    h = (sums[gram:] - sums[:-gram]) * up[: len(x) - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def least_places(h: np.ndarray, wide: int) -> np.ndarray:
    """Place of the first least hash among each ``wide`` neighbours."""
    value, place, done = h, np.arange(len(h), dtype=np.int32), 1
    while done < wide:
        step = min(done, wide - done)
        later = value[step:] < value[:-step]
        value, place = np.where(later, value[step:], value[:-step]), np.where(later, place[step:], place[:-step])
        done += step
    return place


def _entries(parts, length: int, gram: int, keys_only: bool = False):
    """text, start, low, high, key, content of each parse entry of a stretch: a trigger at ``start``, and the windows that
    begin ``low`` to ``high`` bytes before it."""
    import xxhash

    data = b"".join(p for _, _, p in parts)
    sizes = np.array([len(p) for _, _, p in parts])
    ends = np.cumsum(sizes)
    h = rolling_hashes(np.frombuffer(data, np.uint8), gram)
    least = least_places((h >> np.uint64(32)).astype(np.uint32), length - gram + 1)
    part = np.repeat(np.arange(len(parts)), sizes)[: len(least)]
    windows = np.flatnonzero(np.arange(len(least)) + length <= ends[part])
    chosen, part = least[windows], part[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    at, part = chosen[first], part[first]
    if keys_only:
        return (h[at].view(np.int64),)
    low, high = at - windows[last], at - windows[first]
    content = np.fromiter((xxhash.xxh3_64_intdigest(data[i:j], seed) for i, j, seed in zip((at - high).tolist(), (at + length - low).tolist(), (low * length + high).tolist(), strict=True)), np.uint64, len(at))
    text, offset = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    return text[part], offset[part] + at - (ends - sizes)[part], low, high, h[at].view(np.int64), content.view(np.int64)


def _again(key, content, *place) -> tuple[np.ndarray, np.ndarray]:
    """An order, and for each row in it whether one with the same key and content stands at an earlier place (1), at the
    same place (2), or neither (0)."""
    order = np.lexsort((*reversed(place), content, key))
    same = np.zeros(len(order), bool)
    same[1:] = (key[order][1:] == key[order][:-1]) & (content[order][1:] == content[order][:-1])
    run = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    at_first = np.all([p[order] == p[order][run] for p in place], axis=0)
    return order, np.where(~same, 0, np.where(at_first, 2, 1))


def _runs(id_, h, start, low, high) -> tuple[np.ndarray, ...]:
    """Entries whose windows follow one another in a text as one: id, h, first window, minus how many follow it, and a place
    among the entries."""
    order = np.lexsort((start - high, h, id_))
    id_, h, first, last = id_[order], h[order], (start - high)[order], (start - low)[order]
    new = np.ones(len(order), bool)
    new[1:] = (id_[1:] != id_[:-1]) | (h[1:] != h[:-1]) | (first[1:] != last[:-1] + 1)
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(order)))
    return id_[head], h[head], first[head], first[head] - last[head + size - 1], order[head + first[head] % np.maximum(size, 1)]


def _stretched(batches, length: int, gram: int, keys_only: bool):
    """Entries of STRETCHES stretches at a time, with the columns id and h of their texts."""
    import pyarrow as pa

    for batch in batches:
        ids, hs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "h"))
        held, cuts = [], _cuts(((k, x.as_py() or b"") for k, x in enumerate(batch.column("text").cast(pa.binary()))), length, STRETCH)
        for parts in cuts:
            held.append(_entries(parts, length, gram, keys_only))
            if len(held) == STRETCHES:
                yield ids, hs, tuple(map(np.concatenate, zip(*held, strict=True)))
                held = []
        if held:
            yield ids, hs, tuple(map(np.concatenate, zip(*held, strict=True)))


def _parse(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """All parse entries, those of some stretches combined: of equal ones all but the first are ``again``, and such that
    follow one another are one row, under the key of one of them."""

    def parse(batches):
        import pyarrow as pa

        for ids, hs, (text, start, low, high, key, content) in _stretched(batches, length, gram, False):
            id_, h = ids[text], hs[text]
            order, kind = _again(key, content, id_, h, start)
            one, more = order[kind == 0], order[kind == 1]
            run_id, run_h, first, low_, place = _runs(*(x[more] for x in (id_, h, start, low, high)))
            columns = [(key[one], key[more][place]), (content[one], content[more][place]), (id_[one], run_id), (h[one], run_h), (start[one], first), (low[one], low_), (high[one], np.zeros(len(first), np.int64))]
            arrays = [np.concatenate(x) for x in columns]
            yield pa.RecordBatch.from_arrays([*map(pa.array, arrays[:5]), *(pa.array(x.astype(np.int32)) for x in arrays[5:]), pa.array(np.arange(len(arrays[0])) >= len(one))], ["key", "content", "id", "h", "start", "low", "high", "again"])

    return docs.select("id", "h", "text").mapInArrow(parse, _ENTRY)


def _shared_triggers(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """key of the triggers with more than one entry; those with one have no repeated window."""

    def count(batches):
        import pyarrow as pa

        for _, _, (keys,) in _stretched(batches, length, gram, True):
            key, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.minimum(n, 2).astype(np.int64))], ["key", "n"])

    counts = docs.select("id", "h", "text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return written(counts.where("n > 1").select("key"), "triggers")


# Dictionary and parse


def _combined(entries: DataFrame) -> DataFrame:
    """``entries`` as a written table, of equal ones all but the first ``again``. What a task has found to be a repeat
    already is dealt out by its place."""
    of = F.when(F.col("again"), F.xxhash64("id", "h", "start")).otherwise(F.col("content"))
    alike = Window.partitionBy("key", of, "again").orderBy("id", "h", "start")
    placed = entries.withColumn("_row", F.row_number().over(alike)).withColumn("_rank", F.rank().over(alike))
    kept = placed.where(F.col("again") | (F.col("_row") == 1) | (F.col("_rank") > 1))
    return written(kept.withColumn("again", F.col("again") | (F.col("_rank") > 1)).drop("_row", "_rank"), "entries")


def _crowded(entries: DataFrame) -> DataFrame:
    """First entries whose trigger has others, with their number ``n``."""
    firsts = entries.where(~F.col("again"))
    counts = written(firsts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "crowds")
    return firsts.join(counts, "key")


def _with_bodies(entries: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``entries`` with the bytes of their windows as ``body``."""
    asked = written(entries.groupBy("id", "h").agg(F.collect_list(F.struct("key", "start", "low", "high", "n")).alias("asked")), "asked")

    def take(batches):
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column("text").slice(row, 1).cast(pa.binary())[0].as_py()
                rows = batch.column("asked").slice(row, 1).flatten()
                start, low, high = (rows.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2, 3))
                bodies = [text[i:j] for i, j in zip((start - high).tolist(), (start + length - low).tolist(), strict=True)]
                same = lambda c, n=len(bodies), row=row, batch=batch: pa.array(np.full(n, batch.column(c)[row].as_py()))
                yield pa.RecordBatch.from_arrays([rows.field(0), same("id"), same("h"), rows.field(1), rows.field(2), rows.field(3), rows.field(4), pa.array(bodies, pa.binary())], ["key", "id", "h", "start", "low", "high", "n", "body"])

    found = likely(docs, "h", asked.select("h")).join(asked, ["id", "h"]).select("id", "h", "text", "asked")
    return written(found.mapInArrow(take, "key long, id long, h long, start long, low int, high int, n long, body binary"), "bodies")


def _order(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the rows of a matrix, and how many columns each has in common with the row before it."""
    strings = np.ascontiguousarray(strings.astype(">u2"))
    order = np.argsort(strings.view(f"S{2 * strings.shape[1]}").ravel(), kind="stable")
    differ = strings[order][1:] != strings[order][:-1]
    common = np.where(differ.any(1), differ.argmax(1), strings.shape[1])
    return order, np.append(-1, common)


def repeated_windows(key: np.ndarray, rank: np.ndarray, low: np.ndarray, high: np.ndarray, bodies: list[bytes], length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For each entry and window (by how far before the trigger it begins) whether an entry of lesser rank has the same.

    ``bodies`` hold all windows of an entry. Windows are equal if their triggers are, and what stands to the left, which
    the sorted dictionary tells, and to the right, which the sorted parse tells.
    """
    reach = length - gram
    grams = np.unique(np.array([b[h : h + gram] + b"." for b, h in zip(bodies, high.tolist(), strict=True)]), return_inverse=True)[1]
    trigger = np.unique(np.stack([key, grams], 1), axis=0, return_inverse=True)[1].ravel()
    digits = np.stack([trigger >> 30, trigger >> 15 & 0x7FFF, trigger & 0x7FFF], 1)
    left, right = np.zeros((len(bodies), reach), np.uint16), np.zeros((len(bodies), reach), np.uint16)
    for k, (b, h) in enumerate(zip(bodies, high.tolist(), strict=True)):
        x = np.frombuffer(b, np.uint8).astype(np.uint16) + 1
        left[k, :h], right[k, : len(b) - h - gram] = x[:h][::-1], x[h + gram :]
    suffixes, ahead = _order(np.concatenate([digits, left], 1))
    parse, behind = _order(np.concatenate([digits, right], 1))
    by_rank, out = np.argsort(rank, kind="stable"), np.zeros((len(bodies), reach + 1), bool)
    in_left, in_right = np.empty(len(bodies), np.int64), np.empty(len(bodies), np.int64)
    for t in range(reach + 1):
        rows = by_rank[(low[by_rank] <= t) & (t <= high[by_rank])]
        if len(rows) > 1:
            in_left[suffixes], in_right[parse] = np.cumsum(ahead < 3 + t), np.cumsum(behind < 3 + reach - t)
            _, first, of = np.unique(in_left[rows] * len(bodies) + in_right[rows], return_index=True, return_inverse=True)
            out[rows, t] = rank[rows] > rank[rows[first[of]]]
    return out


def _sorted_repeats(crowds: DataFrame, length: int, gram: int) -> DataFrame:
    """id, h, a, b: stretches of the repeated windows among entries whose triggers have at most CROWD."""

    def search(tables):
        import pyarrow as pa

        for t in tables:
            key, id_, h, start, low, high = (t.column(c).to_numpy().astype(np.int64) for c in ("key", "id", "h", "start", "low", "high"))
            order = np.lexsort((start, h, id_))
            rank = np.empty(len(order), np.int64)
            moved = np.any([x[order][1:] != x[order][:-1] for x in (id_, h, start)], axis=0)
            rank[order] = np.append(0, np.cumsum(moved))
            found = np.pad(repeated_windows(key, rank, low, high, t.column("body").to_pylist(), length, gram), ((0, 0), (1, 1))).astype(np.int8)
            row, first = np.nonzero(np.diff(found, axis=1) == 1)
            last = np.nonzero(np.diff(found, axis=1) == -1)[1] - 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (id_[row], h[row], start[row] - last, start[row] - first + length)], ["id", "h", "a", "b"])

    def whole(batches):
        """Tables of whole triggers."""
        import pyarrow as pa

        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= SORTED:
                t = pa.Table.from_batches(held)
                keys = t.column("key").to_numpy()
                end = int(np.searchsorted(keys, keys[-1]))
                if end:
                    yield t.slice(0, end)
                held = t.slice(end).to_batches()
        if held:
            yield pa.Table.from_batches(held)

    few = crowds.where(F.col("n") <= CROWD).repartition("key").sortWithinPartitions("key")
    return few.mapInArrow(lambda batches: search(whole(batches)), "id long, h long, a long, b long")


def _divided(crowds: DataFrame, wide: int, length: int) -> DataFrame:
    """Entries with larger crowds, divided into cells of ``wide`` windows that begin next to one another; what all windows
    of a cell share is added to the key."""

    def divide(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            out = []
            for key, id_, h, start, low, high, body in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "h", "start", "low", "high", "body")), strict=True):
                for cell in range(low // wide, high // wide + 1):
                    a, b = cell * wide, cell * wide + wide - 1
                    i, j = max(low, a), min(high, b)
                    shared, own = body[high - a : high + length - b], body[high - j : high + length - i]
                    out.append((xxhash.xxh3_64_intdigest(shared, (key + cell) % (1 << 64)), xxhash.xxh3_64_intdigest(own, i * length + j), id_, h, start, i, j, own))
            key, content, id_, h, start, low, high, body = zip(*out, strict=True) if out else ((),) * 8
            columns = [np.array(key, np.uint64).view(np.int64), np.array(content, np.uint64).view(np.int64), *(np.array(x, np.int64) for x in (id_, h, start))]
            order, kind = _again(*columns)
            order, kind = order[kind < 2], kind[kind < 2]
            arrays = [pa.array(x[order]) for x in columns] + [pa.array(np.array(x, np.int32)[order]) for x in (low, high)] + [pa.array(kind == 1), pa.array([body[k] for k in order], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "content", "id", "h", "start", "low", "high", "again", "body"])

    return crowds.where(F.col("n") > CROWD).select("key", "id", "h", "start", "low", "high", "body").mapInArrow(divide, f"{_ENTRY}, body binary")


def _stretches(entries: DataFrame, length: int) -> DataFrame:
    return entries.where("again").select("id", "h", (F.col("start") - F.col("high")).alias("a"), (F.col("start") - F.col("low") + length).alias("b"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """id, h, a, b: stretches of bytes that make up all repeats in ``docs`` (id, h, text), whose rows are told apart by id
    and h and ordered by them. A string of ``length`` bytes is a repeat if it also starts earlier: in an earlier row, or
    in the same row before. Stretches of a row can overlap."""
    shared = _shared_triggers(docs, length, gram)
    entries = _combined(likely(_parse(docs, length, gram), "key", shared).join(shared, "key"))
    found = [_stretches(entries, length)]
    crowds, wide = _with_bodies(_crowded(entries), docs, length), length - gram + 1
    while True:
        found.append(_sorted_repeats(crowds, length, gram))
        if wide == 1 or crowds.where(F.col("n") > CROWD).isEmpty():
            break
        wide = -(-wide // 2)
        entries = _combined(_divided(crowds, wide, length))
        found.append(_stretches(entries, length))
        crowds = written(_crowded(entries).drop("content", "again"), "crowds")
    return written(functools.reduce(DataFrame.unionByName, found), "repeats")


# Documents


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _removed(rows: DataFrame) -> DataFrame:
    """RESULT of ``rows`` (doc_id, text, stretches)."""

    def removed(text: bytes, stretches: list[dict]) -> tuple[int, int, int, bytes]:
        merged: list[list[int]] = []
        for a, b in sorted((x["a"], x["b"]) for x in stretches):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        kept = b"".join(text[i:j] for i, j in zip([0, *(b for _, b in merged)], [*(a for a, _ in merged), len(text)], strict=True))
        return len(text), len(text) - len(kept), len(merged), kept

    def remove(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [removed(text or b"", x or []) for text, x in zip(some.column("text").cast(pa.binary()).to_pylist(), some.column("stretches").to_pylist(), strict=True)]
                n_bytes, n_removed, n_spans, kept = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([some.column("doc_id").cast(pa.int64()), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.select("doc_id", "text", "stretches").mapInArrow(remove, RESULT)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept of each of ``docs`` (doc_id, text): texts as UTF-8 bytes without those that
    a string of ``length`` bytes covers which also starts earlier, in a row of smaller doc_id or in the same one before.

    ``n_spans`` counts maximal runs of removed bytes; kept is what remains, which need not be whole characters. Null texts
    are empty. Rows of one id are ordered by a hash of id and text, null ids first; of equal rows all but one are repeats
    of it. Further columns are ignored; an empty table gives an empty result. Rows of one id are told apart by 64 bits.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("h"))
    copies = written(rows.groupBy("id", "h").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "copies")
    again = None
    if not copies.isEmpty():
        held = likely(rows, "h", copies).join(copies, ["id", "h"])
        one = held.groupBy("id", "h").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("m").alias("m"))
        one = written(one, "copied")
        n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
        gone = n >= length
        again = one.select("doc_id", n.alias("n_bytes"), F.when(gone, n).otherwise(0).cast("long").alias("n_removed"), gone.cast("long").alias("n_spans"), F.when(~gone, F.coalesce("text", F.lit(""))).otherwise("").cast("binary").alias("kept"), F.explode(F.sequence(F.lit(2).cast("long"), "m"))).drop("col")
        rows = written(rows.join(copies, ["id", "h"], "left_anti").unionByName(one.drop("m"), allowMissingColumns=True).select("doc_id", "text", "id", "h"), "distinct")
    spans = repeated_spans(rows, length, gram).groupBy("id", "h").agg(F.collect_list(F.struct("a", "b")).alias("stretches"))
    out = _removed(rows.join(spans, ["id", "h"], "left"))
    return out if again is None else out.unionByName(again)


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
