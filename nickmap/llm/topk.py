"""Exact top-k by inner product with no-random-access aggregation over sorted lists.

Candidates are held in blocks. A block keeps, for each component, its vectors sorted by that component, and the lists are
read step by step: for positive weights of a query from the high end, for negative ones from the low end. What has been
read of a vector is summed; what hasn't lies between the list's last value and the value at which the list stands. So
each vector has a lower and an upper bound, which is held as long as it can still be among the k best. A query stops
reading when no outsider can qualify, and the scores of those that are left are resolved. Numpy does this for many
queries at once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: Vectors in a block of candidates, and queries that a block is sent at once.
BLOCK, TILE = 4096, 8192
#: Steps in which the lists are read, and queries that are read for at the same time.
STEPS, ABREAST = 16, 256
#: What 64 bits hold.
HELD = (-(1 << 63), (1 << 63) - 1)


def nra_block(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The ``k`` best rows of ``vectors`` for each row of ``queries``: (query row, vector row, score), ties to the
    smaller of ``ids``, and how many list entries have been read for all of them. ``own`` is the vector row that is the
    query itself and takes no part, or -1."""
    n, q = len(vectors), len(queries)
    # Whole numbers below 2**24 are exact in single precision, below 2**53 in double; larger ones are Python's, held to 64 bits.
    most = float(np.abs(queries.astype(float)).sum(1).max(initial=0)) * float(np.abs(vectors.astype(float)).max(initial=0))
    kind = np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else object
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    order = np.argsort(vectors, axis=0, kind="stable")
    lists = np.take_along_axis(vectors, order, 0)
    out, entries = [], 0
    for at in range(0, q, ABREAST):
        some = np.arange(at, min(q, at + ABREAST))
        found, read = _read_lists(queries[some], vectors, own[some], ids, min(k, n), order, lists)
        out += [(np.full(len(rows), at + r), rows, scores) for r, rows, scores in found]
        entries += read
    return (*(tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3), entries)


def _read_lists(queries, vectors, own, ids, k, order, lists):
    n, wide = vectors.shape
    # Each component has a list read downwards and one read upwards; a query uses the one that its weight's sign tells.
    weights = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
    worst = np.concatenate([lists[0], lists[-1]])
    used = (queries != 0).sum(1)
    open_, held = np.arange(len(queries)), np.arange(n)  # queries still reading, vectors still held for any of them
    seen = np.zeros((n, 2 * wide), bool)
    sums = np.zeros((len(queries), n), vectors.dtype)
    out, entries, columns = [], 0, np.arange(wide)
    for step in range(STEPS):
        first, last = n * step // STEPS, n * (step + 1) // STEPS
        fresh = np.zeros((n, 2 * wide), vectors.dtype)
        down, up = order[n - last : n - first], order[first:last]
        fresh[down, columns], fresh[up, columns + wide] = lists[n - last : n - first], lists[first:last]
        seen[down, columns], seen[up, columns + wide] = True, True
        entries += int(used[open_].sum()) * (last - first)
        sums[np.ix_(open_, held)] += weights[open_] @ fresh[held].T
        partial, unseen = sums[np.ix_(open_, held)], ~seen[held]
        if last < n:
            stands = np.concatenate([lists[n - last], lists[last - 1]]) if last else np.concatenate([lists[-1], lists[0]])
            lower, upper = partial + weights[open_] @ (unseen * worst).T, partial + weights[open_] @ (unseen * stands).T
        else:
            lower = upper = partial
        if lower.dtype == object:  # scores that saturate are equal
            lower, upper = np.clip(lower, *HELD), np.clip(upper, *HELD)
        mine = own[open_][:, None] == held[None, :]
        lower = np.where(mine, lower.min(initial=0) - 1, lower)
        kth = np.partition(lower, len(held) - k, axis=1)[:, len(held) - k] if len(held) > k else lower.min(1)
        may = (upper >= kth[:, None]) & ~mine
        settled = may.sum(1) <= k if last < n else np.ones(len(open_), bool)
        for r in np.flatnonzero(settled):
            left = held[may[r]]
            scores = vectors[left] @ queries[open_[r]]
            scores = np.clip(scores, *HELD) if scores.dtype == object else scores
            best = np.lexsort((ids[left], -scores))[:k]
            out.append((int(open_[r]), left[best], np.array([int(x) for x in scores[best]], np.int64)))
        open_ = open_[~settled]
        if not len(open_):
            break
        held = held[may[~settled].any(0) | mine[~settled].any(0)]
    return out, entries


def _quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """row (a number of its own), vec_id, x (components as whole numbers) as a written table. What has no id or no finite
    components is left out."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return written(kept.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("x")), "vectors")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best inner products of each query, which is a row of ``vectors`` (vec_id,
    embedding) with a vec_id divisible by ``every``, over all other rows; fewer if there are fewer. Components become
    floor(scale * x); components and scores beyond 64 bits are the nearest number that these hold. Ties go to the smaller vec_id. Rows that share a vec_id are queries and candidates of their own.
    Shorter vectors count as ending in zeros. Null vectors, and those holding a null or non-finite component, take no
    part, nor do null ids; further columns are ignored; an empty table gives an empty result.

    Candidates are dealt into blocks and queries into tiles; a task has one pair of them, and hands on k rows a query.
    A candidate goes to as many tasks as there are tiles: one for each TILE queries.
    """
    whole = _quantised(vectors, scale)
    counts = whole.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("asking")).first()
    blocks, tiles = max(1, -(-counts["n"] // BLOCK)), max(1, -(-counts["asking"] // TILE))
    dealt = lambda m, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(m)).cast("int")
    all_of = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = whole.withColumn("block", dealt(blocks, "block")).withColumn("tile", all_of(tiles)).withColumn("asks", F.lit(False))
    queries = whole.where(F.col("vec_id") % every == 0).withColumn("tile", dealt(tiles, "tile")).withColumn("block", all_of(blocks)).withColumn("asks", F.lit(True))

    def search(pdf):
        import pandas as pd

        wide = max(map(len, pdf["x"]))
        x = np.array([np.pad(np.asarray(v, np.int64), (0, wide - len(v))) for v in pdf["x"]], np.int64).reshape(len(pdf), wide)
        asks, ids, row = pdf["asks"].to_numpy(bool), pdf["vec_id"].to_numpy(np.int64), pdf["row"].to_numpy(np.int64)
        if asks.all() or not asks.any():
            return pd.DataFrame({"asked": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        order = np.argsort(row[~asks])
        c, q = row[~asks][order], row[asks]
        place = np.minimum(np.searchsorted(c, q), len(c) - 1)
        names = ids[~asks][order]
        rows, best, scores, _ = nra_block(x[asks], x[~asks][order], np.where(c[place] == q, place, -1), names, k)
        return pd.DataFrame({"asked": q[rows], "query_id": ids[asks][rows], "vec_id": names[best], "score": scores})

    found = candidates.unionByName(queries).groupBy("block", "tile").applyInPandas(search, "asked long, query_id long, vec_id long, score long")
    by_score = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
with whole as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda v: cast(floor(256 * cast(v as double)) as bigint)) as x
  from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
scored as (
  select q.row as asked, q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.x as double[]), cast(c.x as double[])) as bigint) as score
  from whole q join whole c on q.row <> c.row where q.vec_id % 50 = 0)
select query_id, cast(rank as int) as rank, vec_id, score from (
  select *, row_number() over (partition by asked order by score desc, vec_id) as rank from scored)
where rank <= 5
"""
