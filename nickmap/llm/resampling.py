"""Importance resampling towards a target distribution, with hashed word n-grams.

A 256-byte table lower-cases letters and blanks separators in UTF-8, ``bytes.split`` yields the words, and the checksum of
an n-gram is that of the shorter one before it, run on over a space and the next word. Counters of a fixed number of
buckets are reduced over all tasks; a document's weight is the sum of its features' gains, and documents are drawn by
weight plus Gumbel noise.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: Bytes of a text that are cut into words at once.
STRETCH = 1 << 20
#: ASCII letters in lower case, digits and whatever is not ASCII as they are, a space for all else.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MEASURED = "doc_id long, n_words long, n_features long, weight long"
_LOW = (1 << 33) - 1


def feature_hashes(text: bytes | None, longest: int = 3, stretch: int = STRETCH) -> Iterator[tuple[int, np.ndarray]]:
    """Of each stretch of a text: how many words it has, and the checksums of all runs of 1 to ``longest`` words that end
    in it. The last words of a stretch are carried into the next, so a long text needs no more memory than a stretch."""
    plain = (text or b"").translate(WORD_BYTES)
    start, carried = 0, []
    while start < len(plain):
        end = plain.find(b" ", start + stretch) if start + stretch < len(plain) else -1
        end = len(plain) if end < 0 else end
        words = carried + plain[start:end].split()
        spaced = list(map(b" ".__add__, words))
        sums, found = list(map(crc32, words)), []
        for n in range(1, longest + 1):
            found += sums[max(0, len(carried) - n + 1) :]
            sums = list(map(crc32, spaced[n:], sums))
        yield len(words) - len(carried), np.array(found, np.uint32)
        carried = words[-(longest - 1) :] if longest > 1 else []
        start = end


def bucket_counts(texts: DataFrame, buckets: int, longest: int = 3) -> np.ndarray:
    """How often the features of all ``texts`` (text) fall in each bucket. Tasks count first; what reaches the driver is a
    number for each bucket."""

    def count(batches):
        import pyarrow as pa

        total: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                for _, found in feature_hashes(text, longest):
                    total.update((found % buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log of each bucket's share in the target over that in the source, both with one more feature in
    each bucket, rounded down."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: (t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def in_order(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with their place from 1 in the given order as ``rank``: ranges are sorted each by itself and written, and
    the sizes of the ranges before are added, so no task holds more than a range."""
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "in-order")
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    ahead = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    return placed.withColumn("_part", part).join(F.broadcast(ahead), "_part").select(*rows.columns, (F.col("_ahead") + F.col("_at").bitwiseAND(F.lit(_LOW)) + 1).alias("rank"))


def importance_weights(docs: DataFrame, target: DataFrame, buckets: int = 10_000, longest: int = 3) -> DataFrame:
    """doc_id, n_words, n_features, weight of each of ``docs`` (doc_id, text) for the distribution of ``target`` (text).

    Both tables are counted whole; null and empty texts have no features and weight 0; null ids and repeated rows are kept;
    further columns are ignored; an empty ``target`` counts as one feature in each bucket, as does an empty ``docs``,
    which gives an empty result.
    """
    gains = bucket_gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))

    def weigh(batches):
        import pyarrow as pa

        for batch in batches:
            n_words, n_features, weights = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                parts = [(n, len(found), int(gains[found % buckets].sum())) for n, found in feature_hashes(text, longest)]
                for column, total in zip((n_words, n_features, weights), map(sum, zip(*parts, strict=True)) if parts else (0, 0, 0), strict=True):
                    column.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights))], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(weigh, MEASURED)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, buckets: int = 10_000, longest: int = 3) -> DataFrame:
    """doc_id, n_features, weight, score, rank of each of ``docs``, as ``importance_weights`` takes them: the score is the
    weight plus seeded Gumbel noise of the id, and the ``percent`` of the documents of at least ``min_words`` words with the
    highest scores are drawn, in the order of rank; others have a null rank.

    Ties go to the smaller id; rows of one id and score are ordered by their features, equal ones in any order. A null id
    has the noise of an empty one and comes first among ties.
    """
    weights = written(importance_weights(docs, target, buckets, longest), "weights")  # dealing out by ranges reads them twice
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("long")
    # Those that can be drawn come first, so their places in the order are their ranks.
    scored = weights.withColumn("score", F.col("weight") + noise).withColumn("short", F.col("n_words") < min_words)
    placed = in_order(scored, F.col("short").asc(), F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("n_words"))
    drawn = scored.where(~F.col("short")).count() * percent // 100
    return placed.select("doc_id", "n_features", "weight", "score", F.when(~F.col("short") & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
