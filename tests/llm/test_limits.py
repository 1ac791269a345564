"""Values of any size, very long texts, and ids that a large part of the rows share."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from nickmap.llm import quality, secrets, topk
from nickmap.llm.common import held_out


@pytest.mark.parametrize("text", ["a:" * 40_000, "-----BEGIN RSA PRIVATE KEY-----\n" * 5_000, 'token="' * 20_000, "://a:b" * 20_000, "token" * 20_000, "a1:" * 40_000, "x=1," * 30_000])
def test_candidates_of_long_texts_in_one_pass(text):
    began = time.perf_counter()
    secrets.candidates(text)
    assert time.perf_counter() - began < 1


@pytest.mark.parametrize("n", [5, 120, 140, 5_000])
def test_values_of_any_length(n):
    rng = random.Random(n)
    word = "A1b" + "".join(rng.choices("abcdefgXYZ123", k=n - 3))
    key = f"-----BEGIN PRIVATE KEY-----\n{'QUJD' * n * 8}\n-----END PRIVATE KEY-----"
    text = f"see amqp://user{'x' * n}:{word}@host/x and {key} then password={word}"
    found = [text[i:j] for i, j in secrets.candidates(text)]
    assert key in found and found.count(word) == 2
    assert secrets.finding_features(key, 0, len(key), None, frozenset())[secrets.FEATURES.index("prefixed")] == 1.0


def test_key_blocks():
    begin, end = "-----BEGIN EC PRIVATE KEY-----", "-----END EC PRIVATE KEY-----"
    for text, want in ((f"{begin}\nAB\n{end}", 1), (f"{begin}\n{begin}\nAB\n{end}", 1), (f"{begin}\n(not a key)\n{end}", 0), (f"{end} {begin}", 0), (f"{begin}A{end} x {begin}B{end}", 2)):
        assert len(secrets._key_blocks(text)) == want, text


def old_candidates(text):
    """Runs as the former pattern found them, which took the square of a run's length."""
    import re

    pattern = re.compile(r"(?<![A-Za-z0-9+/_\-.@])(?=[A-Za-z+/_\-.@:]*\d|gh[pousr]_|glpat-|[srp]k_(?:live|test)_|xox[abeoprs]-|npm_|hf_)[A-Za-z0-9+/_\-.@:]{12,}(?:={1,2}(?![A-Za-z0-9+/_\-.@:=\"'`]))?")
    return [m.span() for m in pattern.finditer(text)]


def test_runs_are_those_of_the_pattern():
    rng = random.Random(9)
    for _ in range(3_000):
        text = "".join(rng.choices(["a", "b1", ":", "=", " ", "ghp_", "glpat-", "abcdefghijkl", "/", '"', "é", "@", "sk_live_"], k=rng.randint(1, 25)))
        assert list(secrets._runs(text)) == old_candidates(text), text


def test_planted_passages_are_few(spark):
    """A row that fills a third of the table gives one passage; no more than asked for are taken."""
    docs = spark.createDataFrame([(i, f"text {i} " * 40, "s") for i in range(300)] + [(7, "same " * 30, "s")] * 150, "doc_id long, text string, path string")
    found = secrets.planted_findings(docs, frozenset(), passages=20).collect()
    assert 0 < len({r.doc_id for r in found}) <= 20 and len(found) <= 20 * secrets.PLANTS


def test_components_of_any_size(spark):
    """Scores and components beyond 64 bits are held at the bounds; those below are exact."""
    data = [(0, [1e10, 1e10]), (1, [1e10, -1e10]), (2, [3e9, 2e9]), (3, [1e300, 1.0]), (4, [-1e300, 1.0]), (5, [0.5, 0.25]), (6, None), (7, [1e10, 1e10])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, 5, 1).collect())
    low, high = -(1 << 63), (1 << 63) - 1
    hold = lambda v: max(low, min(high, v))
    whole = {i: [hold(int(np.floor(np.float64(256) * v))) for v in x] for i, x in data if x}
    want = []
    for q, x in whole.items():
        scored = sorted((-hold(sum(a * b for a, b in zip(x, y, strict=True))), i) for i, y in whole.items() if i != q)
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scored[:5], 1)]
    assert got == sorted(want)


def test_labels_of_a_shared_id(spark):
    """Rows of one labelled id are bounded as the labels are, and small tables are used whole."""
    free = [i for i in range(40) if not spark.range(1).select(held_out(F.lit(i)).alias("x")).first().x]
    good, bad = "The report describes how the method was applied and what it found in each case. " * 5, "buy now!!! $$$ click >>> " * 20
    docs = spark.createDataFrame([(i, good if i % 2 else bad) for i in free] + [(free[0], bad)] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in free], "doc_id long, quality int")
    seen = []
    fit, quality.fit_additive = quality.fit_additive, lambda x, y, *a, **k: seen.append((len(x), y.sum())) or fit(x, y, *a, **k)
    try:
        quality.fit_quality(docs, labels)
        quality.fit_quality(docs, labels, max_rows=50)
    finally:
        quality.fit_additive = fit
    assert seen[0] == (len(free) + 500, sum(i % 2 for i in free)) and seen[1][0] <= 50
