"""Near-duplicates by SimHash: fingerprints of word shingles, compared exactly in tiles.

Equal fingerprints are grouped first. The distinct ones are ordered by their population count and cut into tiles; two
fingerprints within the radius have population counts within it too, so a fingerprint is sent only to the pairs of
tiles whose population counts are near enough, and all other pairs of tiles are never made. A task has one pair of
tiles, where numpy compares by exclusive-or and bit counts. It hands on a spanning forest of the links it finds, never
all of them, so that a large group of near copies costs as many rows as it has fingerprints.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import likely, table, with_row_id, written
from .components import connected_components

#: Distinct fingerprints in a tile, about.
TILE = 32_768
#: Shingles of the sets on either side of a task that holds texts to a similarity, about.
PART = 1_000_000
SEED = 42
#: Multipliers that make further 64-bit words of a shingle's hash.
_ODD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of a text: A-Z are lowered, words are runs of other than ASCII white space, joined
    by spaces. Fewer words form one shingle; a null text or one without words has none."""
    from xxhash import xxh64_intdigest

    words = text.encode(errors="replace").lower().split() if text else []
    if not words:
        return np.zeros(0, "<u8")
    if len(words) <= size:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], "<u8")
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    return np.array([xxh64_intdigest(line[i:j], SEED) for i, j in zip(starts, ends[size - 1 :].tolist(), strict=True)], "<u8")


def _further(hashes: np.ndarray, word: int) -> np.ndarray:
    """The hashes themselves for word 0, and numbers mixed from them for further words."""
    if not word:
        return hashes
    with np.errstate(over="ignore"):
        x = (hashes ^ np.uint64(word)) * _ODD[0]
        x = (x ^ (x >> np.uint64(32))) * _ODD[1]
        return x ^ (x >> np.uint64(29))


def fingerprint(text: str | None, shingle: int = 3, words: int = 1, repeats: bool = True) -> bytes:
    """The fingerprint of a text, ``words`` 64-bit numbers, the highest byte of each first. A bit is set if it is set in
    over half of the hashes of the shingles, those that recur counted each time or, without ``repeats``, once. Without
    shingles it is zero."""
    hashes, found = shingle_hashes(text, shingle), []
    if not repeats:
        hashes = np.unique(hashes)
    for word in range(words):
        votes = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 65_536):
            some = np.ascontiguousarray(_further(hashes[at : at + 65_536], word)).astype("<u8", copy=False)
            votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        found.append(np.packbits(2 * votes > len(hashes), bitorder="little")[::-1].tobytes())
    return b"".join(found)


def _fingerprints(rows: DataFrame, shingle: int, words: int, repeats: bool) -> DataFrame:
    """key, doc_id, print, ones (its population count) for each of ``rows`` (key, doc_id, text)."""

    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            prints = [fingerprint(x.as_py(), shingle, words, repeats) for x in batch.column("text")]
            ones = np.bitwise_count(np.frombuffer(b"".join(prints), np.uint8)).reshape(len(prints), 8 * words).sum(1, dtype=np.int32)
            columns = [batch.column("key").cast(pa.int64()), batch.column("doc_id").cast(pa.int64()), pa.array(prints, pa.binary()), pa.array(ones)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "print", "ones"])

    return rows.select("key", "doc_id", "text").mapInArrow(hashed, "key long, doc_id long, print binary, ones int")


def tile_plan(counts: dict[int, int], radius: int, size: int = TILE) -> dict[int, tuple[int, int, int, int]]:
    """For each population count of ``counts`` (fingerprints that have it): its first tile, the number of tiles it is
    dealt over, and the first and last tile that can hold a fingerprint within ``radius`` of one of its tiles'.

    Tiles are numbered by rising population count. Neighbouring counts share a tile while it is not full; a count with
    more fingerprints than a tile holds has several of its own.
    """
    spans: list[list[int]] = []  # lowest and highest count, tiles, fingerprints
    for ones, n in sorted(counts.items()):
        if spans and spans[-1][2] == 1 and spans[-1][3] + n <= size:
            spans[-1][1], spans[-1][3] = ones, spans[-1][3] + n
        else:
            spans.append([ones, ones, -(-n // size), n])
    firsts = np.cumsum([0, *(x[2] for x in spans)]).tolist()
    plan = {}
    for k, (low, high, tiles, _) in enumerate(spans):
        near = [i for i, x in enumerate(spans) if x[0] <= high + radius and x[1] >= low - radius]
        for ones in range(low, high + 1):
            plan[ones] = (firsts[k], tiles, firsts[near[0]], firsts[near[-1] + 1] - 1)
    return plan


class _Classes:
    """Classes of places, each with a label that is always up to date; the smaller of two is renamed when they meet."""

    def __init__(self, n: int):
        self.label, self.members = np.arange(n), {}

    def of(self, label: int) -> list[int]:
        return self.members.setdefault(label, [label])

    def join(self, a: int, b: int) -> None:
        a, b = int(self.label[a]), int(self.label[b])
        if a != b:
            if len(self.of(a)) < len(self.of(b)):
                a, b = b, a
            moved = self.members.pop(b)
            self.label[moved] = a
            self.members[a].extend(moved)


def near_places(left: np.ndarray, right: np.ndarray, radius: int, same: bool):
    """For each place of ``left`` that has any: the places of ``right`` whose fingerprints lie within the radius. Both are
    arrays of distinct fingerprints, a row of words each; if they are the ``same``, each pair comes once."""
    ones = lambda x: np.bitwise_count(x).sum(1, dtype=np.int64)
    rows, columns = np.argsort(ones(left), kind="stable"), np.argsort(ones(right), kind="stable")
    weight, weights = ones(left[rows]), ones(right[columns])
    first, last = np.searchsorted(weights, weight - radius), np.searchsorted(weights, weight + radius, "right")
    words = np.ascontiguousarray(right[columns].T)
    share = radius // max(1, len(words))
    for k, i in enumerate(rows):
        lo = k + 1 if same else first[k]  # sorted alike, so what comes before has met this row
        if lo >= last[k]:
            continue
        # What lies within the radius does so by its share of it in one word at least.
        near = [np.flatnonzero(np.bitwise_count(words[w, lo : last[k]] ^ left[i, w]) <= share) for w in range(len(words))]
        near = near[0] if len(near) == 1 else np.unique(np.concatenate(near))
        if len(words) > 1:
            near = near[ones(right[columns[lo + near]] ^ left[i]) <= radius]
        if len(near):
            yield int(i), columns[lo + near]


def tile_links(left: np.ndarray, right: np.ndarray, radius: int, same: bool, alike=None) -> np.ndarray:
    """A spanning forest of the links between two arrays of fingerprints (or within one), as pairs of places, those of
    ``right`` counted on from ``left``. ``alike`` (place, places) tells which of the places that lie near are linked; all
    are without it."""
    shift = 0 if same else len(left)
    classes, found = _Classes(len(left) if same else len(left) + len(right)), []
    for i, near in near_places(left, right, radius, same):
        near = near + shift
        near = near[classes.label[near] != classes.label[i]]
        if alike is not None and len(near):
            near = near[alike(i, near)]
        if len(near):
            for j in near[np.unique(classes.label[near], return_index=True)[1]].tolist():
                found.append((i, j))
                classes.join(i, j)
    return np.array(found, np.int64).reshape(-1, 2)


def _cells(prints: DataFrame, radius: int) -> DataFrame:
    """row, col, own, block: the distinct fingerprints of ``prints`` (print, ones), a written table, as one block of bytes
    for each tile, dealt to pairs of tiles; own is the block's tile. One row for each population count reaches the
    driver."""
    counts = {r["ones"]: r["count"] for r in prints.groupBy("ones").count().collect()}
    plan = tile_plan(counts, radius, TILE) or {0: (0, 1, 0, 0)}
    of = F.create_map(*[x for ones, tiles in sorted(plan.items()) for x in (F.lit(ones), F.array(*map(F.lit, tiles)))])[F.col("ones")]
    own = F.col("of")[0] + F.pmod(F.xxhash64("print", F.lit("tile")), F.col("of")[1]).cast("int")

    def pack(pdf):
        import pandas as pd

        return pd.DataFrame({"own": pdf["own"].iloc[:1], "first": pdf["first"].iloc[:1], "last": pdf["last"].iloc[:1], "block": [b"".join(pdf["print"])]})

    tiles = prints.select("print", of.alias("of")).select("print", own.alias("own"), F.col("of")[2].alias("first"), F.col("of")[3].alias("last"))
    tiles = written(tiles.groupBy("own").applyInPandas(pack, "own int, first int, last int, block binary"), "tiles")
    dealt = tiles.select("own", "block", F.explode(F.sequence("first", "last")).alias("other"))
    return dealt.select(F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col"), "own", "block")


def _sides(pdf, words: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Names of the fingerprints of a cell's two tiles, and whether they are one."""
    block = dict(zip(pdf["own"], pdf["block"], strict=True))
    row, col = pdf["row"].iloc[0], pdf["col"].iloc[0]
    return *(np.frombuffer(block[t], f"V{8 * words}") for t in (row, col)), row == col


def _numbers(names: np.ndarray) -> np.ndarray:
    return np.frombuffer(names.tobytes(), ">u8").astype(np.uint64).reshape(len(names), -1)


def links(prints: DataFrame, radius: int, words: int) -> DataFrame:
    """u, v: links between the distinct fingerprints of ``prints`` (print of ``words`` numbers, ones), a written table,
    that connect all that lie within the radius."""

    def compare(pdf):
        import pandas as pd

        left, right, same = _sides(pdf, words)
        at = tile_links(_numbers(left), _numbers(right), radius, same)
        both = left if same else np.concatenate([left, right])
        return pd.DataFrame({"u": [x.tobytes() for x in both[at[:, 0]]], "v": [x.tobytes() for x in both[at[:, 1]]]})

    return _cells(prints, radius).groupBy("row", "col").applyInPandas(compare, "u binary, v binary")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """print and its set of shingles, sorted, for each of ``texts`` (print, text)."""

    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            some = [np.unique(shingle_hashes(x.as_py(), shingle)).view(np.int64) for x in batch.column("text")]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in some])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *some])))
            yield pa.RecordBatch.from_arrays([batch.column("print").cast(pa.binary()), lists], ["print", "set"])

    return texts.mapInArrow(hashed, "print binary, set array<long>")


def set_similarity(sets: list[np.ndarray], similarity: tuple[int, int]):
    """A function of a place and further places of ``sets`` (distinct values each): which of them are as similar."""
    p, q = similarity
    sizes = np.array([len(x) for x in sets], np.int64)
    ends = np.cumsum(sizes)
    values, dense = np.unique(np.concatenate([np.zeros(0, np.int64), *sets]), return_inverse=True)
    mark = np.zeros(len(values), np.int8)

    def alike(i: int, near: np.ndarray) -> np.ndarray:
        own = dense[ends[i] - sizes[i] : ends[i]]
        mark[own] = 1
        n = sizes[near]
        at = np.cumsum(n)
        within = np.arange(at[-1]) + np.repeat(ends[near] - at, n)  # the places of all their values, one after another
        sums = np.concatenate([[0], np.cumsum(mark[dense[within]], dtype=np.int64)])
        mark[own] = 0
        return (sums[at] - sums[at - n]) * (p + q) >= p * (sizes[i] + n)

    return alike


def similar_links(firsts: DataFrame, rows: DataFrame, radius: int, shingle: int, words: int, similarity: tuple[int, int]) -> DataFrame:
    """u, v: links that connect all fingerprints of ``firsts`` (print, ones, first), a written table, that lie within the
    radius and whose sets of shingles have that Jaccard similarity, and no others. ``first.key`` names a row of ``rows``
    (row_id, row.text).

    The tiles find out which fingerprints have any other near. Only the texts of these are read again, and their sets go
    to the pairs of tiles in which they met, in parts of at most about PART shingles.
    """

    def meet(pdf):
        import pandas as pd

        left, right, same = _sides(pdf, words)
        down, across = np.zeros(len(left), bool), np.zeros(len(right), bool)
        for i, near in near_places(_numbers(left), _numbers(right), radius, same):
            down[i] = True
            across[near] = True
        row, col = pdf["row"].iloc[0], pdf["col"].iloc[0]
        sides = [(row, left[down | across])] if same else [(row, left[down]), (col, right[across])]
        return pd.DataFrame([(x.tobytes(), own, row, col) for own, found in sides for x in found], columns=["print", "own", "row", "col"])

    met = written(_cells(firsts.select("print", "ones"), radius).groupBy("row", "col").applyInPandas(meet, "print binary, own int, row int, col int"), "met")
    needed = written(met.select("print").distinct().join(firsts, "print").select("print", F.col("first.key").alias("row_id")), "met-rows")
    hashed = lambda df: df.withColumn("at", F.xxhash64("row_id"))
    texts = likely(hashed(rows.select("row_id", F.col("row.text").alias("text"))), "at", hashed(needed)).join(needed, "row_id")
    sets = written(_sets(texts.select("print", "text"), shingle), "met-sets")
    sized = written(met.join(sets.select("print", F.size("set").alias("n")), "print"), "met-sizes")
    parts = sized.groupBy("row", "col", "own").agg(F.ceil(F.sum("n") / PART).cast("int").alias("parts"))
    both = parts.groupBy("row", "col").agg(F.max(F.when(F.col("own") == F.col("row"), F.col("parts"))).alias("rows"), F.max(F.when(F.col("own") == F.col("col"), F.col("parts"))).alias("cols"))
    both = written(both.na.fill(1), "met-parts")
    upright, same = F.col("own") == F.col("row"), F.col("row") == F.col("col")
    part = F.pmod(F.xxhash64("print", F.lit("part")), F.when(upright, F.col("rows")).otherwise(F.col("cols"))).cast("int")
    against = F.explode(F.sequence(F.lit(0), F.when(upright, F.col("cols")).otherwise(F.col("rows")) - 1)).alias("against")
    dealt = sized.join(both, ["row", "col"]).select("print", "own", "row", "col", part.alias("part"), against)
    swap = F.when(same, F.col("part") > F.col("against")).otherwise(~upright)
    across, down = F.when(swap, F.col("part")).otherwise(F.col("against")), F.when(swap, F.col("against")).otherwise(F.col("part"))
    dealt = dealt.select("print", "own", "row", "col", "part", down.alias("down"), across.alias("across")).join(sets, "print")

    def compare(pdf):
        import pandas as pd

        names, own, part = pdf["print"].to_numpy(), pdf["own"].to_numpy(), pdf["part"].to_numpy()
        numbers = np.frombuffer(b"".join(names), ">u8").astype(np.uint64).reshape(len(names), -1)
        row, col, down, across = (pdf[c].iloc[0] for c in ("row", "col", "down", "across"))
        left, right = np.flatnonzero((own == row) & (part == down)), np.flatnonzero((own == col) & (part == across))
        one = row == col and down == across
        places = left if one else np.concatenate([left, right])
        alike = set_similarity([pdf["set"].iloc[k] for k in places], similarity)
        at = tile_links(numbers[left], numbers[right], radius, one, alike)
        return pd.DataFrame({"u": names[places[at[:, 0]]], "v": names[places[at[:, 1]]]})

    return dealt.groupBy("row", "col", "down", "across").applyInPandas(compare, "u binary, v binary")


def _classes(prints: DataFrame, edges: DataFrame) -> DataFrame:
    """print, root: the component of each of the distinct ``prints`` under the links ``edges``."""
    roots = connected_components(edges).withColumnRenamed("v", "print")
    return written(prints.join(roots, "print", "left").select("print", F.coalesce("root", "print").alias("root")), "roots")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, words: int = 1, repeats: bool = True) -> DataFrame:
    """doc_id, fingerprint (hex digits), component_id for each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links of at most ``radius`` differing bits reach, the document's own
    included; null only where the component has null ids alone. Null and empty texts have fingerprint zero and link like
    others; repeated rows are kept and belong together; further columns are ignored; an empty table gives an empty result.
    """
    hashed = written(_fingerprints(docs.select(F.col("doc_id").alias("key"), "doc_id", "text"), shingle, words, repeats), "simhash")
    prints = written(hashed.select("print", "ones").distinct(), "prints")
    roots = _classes(prints.select("print"), links(prints, radius, words))
    ids = written(hashed.groupBy("print").agg(F.min("doc_id").alias("least")), "least").join(roots, "print")
    least = written(ids.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    classes = written(roots.join(least, "root").select("print", "component_id"), "classes")
    return hashed.join(classes, "print").select("doc_id", F.lower(F.hex("print")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 30, shingle: int = 5, words: int = 2, similarity: tuple[int, int] | None = (4, 5)) -> DataFrame:
    """One row of ``docs`` for each class of near-duplicates, with all columns: that of the least doc_id (nulls last),
    of equal ids any one.

    Fingerprints are of the distinct shingles. At a Jaccard similarity of 0.8 two of 128 bits differ in 19 bits on
    average, with a deviation of 4, and unrelated ones in 64; so the default radius misses few such pairs, and what
    lies within it is then held to ``similarity`` (a fraction of whole numbers) by the sets of shingles themselves. Texts of equal fingerprints are one class, so are texts without words. Null texts count as empty; repeated
    rows are copies; an empty table gives an empty result.
    """
    rows = with_row_id(docs)
    hashed = written(_fingerprints(rows.select(F.col("row_id").alias("key"), "row.doc_id", "row.text"), shingle, words, False), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    firsts = written(hashed.groupBy("print", "ones").agg(first.alias("first")), "firsts")
    found = links(firsts.select("print", "ones"), radius, words) if similarity is None else similar_links(firsts, rows, radius, shingle, words, similarity)
    roots = _classes(firsts.select("print"), found)
    named = written(firsts.join(roots, "print").select("print", "first", "root"), "named")
    kept = written(named.groupBy("root").agg(F.min("first").alias("first")).select("root", F.col("first.key").alias("kept")), "kept")
    classes = written(named.join(kept, "root").select("print", "kept"), "classes")
    # Rows that go are fewer than rows that stay, so they are what the texts are joined with.
    gone = written(hashed.select("key", "print").join(classes, "print").where("key <> kept").select(F.col("key").alias("row_id")), "gone")
    return rows.join(gone, "row_id", "left_anti").select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
