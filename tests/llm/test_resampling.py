"""Importance resampling against a version in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from nickmap.llm import resampling
from nickmap.llm.common import table
from tests.llm.test_operators import documents, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def features(text, buckets, longest=3):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, percent=5, min_words=20, buckets=10_000):
    found = [(i, *features(t, buckets)) for i, t in docs]
    s, t = Counter(x for _, _, f in found for x in f), Counter(x for text in target for x in features(text, buckets)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    ranked = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is not None, x[0] or 0, x[2]))
    rank = {id(x): k for k, x in enumerate(ranked[: len(ranked) * percent // 100], 1)}
    return sorted(((x[0], x[2], x[3], x[4], rank.get(id(x))) for x in out), key=str)


def test_query(spark, small):
    got = resampling.op12_resampling(spark, small)
    assert got.dtypes == [("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint")]
    docs = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, [r.text for r in table(spark, small, "benchmark").collect()])
    assert got.where("rank is not null").count() == len([1 for _, t in docs if features(t, 9)[0] >= 20]) // 20


def test_odd_rows(spark):
    docs = documents(spark)
    target = spark.createDataFrame([("The QUICK fox",), (None,), ("",)], "text string")
    got = resampling.resample(docs, target, percent=50, min_words=3, buckets=64)
    want = plain([(r.doc_id, r.text) for r in docs.collect()], ["The QUICK fox"], 50, 3, 64)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_tables(spark):
    one, none = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "text string")
    assert resampling.resample(empty(spark), one).count() == 0
    assert [tuple(r) for r in resampling.resample(one, none, percent=100, min_words=1, buckets=8).collect()] == plain([(1, "a b c")], [], 100, 1, 8)


@pytest.mark.parametrize("stretch", [1, 3, 7, 1 << 20])
@pytest.mark.parametrize("longest", [1, 2, 3, 4])
def test_stretches(stretch, longest):
    """Cutting a long text changes no feature."""
    text = "Ein Wörter-Buch  mit 日本 und\x1c0 9Zeichen, 🙂 a" * 3
    parts = list(resampling.feature_hashes(text.encode(), longest, stretch))
    n, want = features(text, 1 << 32, longest)
    assert sum(p[0] for p in parts) == n and sorted(np.concatenate([p[1] for p in parts]).tolist()) == sorted(want)


def test_order_over_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 977).alias("x"), "id").repartition(7)
    got = [tuple(r) for r in resampling.in_order(rows, F.desc("x"), F.asc("id")).orderBy("rank").collect()]
    assert [g[2] for g in got] == list(range(1, 5001)) and [g[:2] for g in got] == sorted(((i * 7919 % 977, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
