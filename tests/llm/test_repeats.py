"""Removal of repeated byte strings against a scan that remembers every string."""

import hashlib
import random

import numpy as np
import pytest

from nickmap.llm import repeats
from nickmap.llm.common import table
from tests.llm.test_operators import CLASHING, documents, empty


def plain(docs, length=100):
    """doc_id, n_bytes, n_removed, n_spans, kept of texts in their order."""
    seen, out = set(), []
    for i, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(b[p : p + length])
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


def frame(spark, docs, parts=3):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)


def test_query(spark, small):
    docs = sorted((r.doc_id, r.text) for r in table(spark, small, "documents").collect())
    want = [(i, n, removed, spans, hashlib.sha256(kept).hexdigest()) for i, n, removed, spans, kept in plain(docs)]
    found = repeats.op13_repeats(spark, small)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == want


@pytest.mark.parametrize(("seed", "crowd"), [(0, 1), (1, 3), (2, 1000), (3, 1)])
def test_small_alphabets(spark, monkeypatch, seed, crowd):
    """Short strings over few letters: periodic texts, ties of hashes, and crowds that are divided down to windows."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(seed)
    passages = ["".join(rng.choices("ab", k=30)) for _ in range(3)]
    docs = [(i, "".join(rng.choice([*passages, "".join(rng.choices("abc\x00é", k=rng.randint(0, 9))), "aaaaaaaaaaaaaaaaa", "xyxyxyxyxyxy"]) for _ in range(rng.randint(0, 8)))) for i in range(40)]
    assert got(repeats.remove_repeats(frame(spark, docs), 12, 4)) == plain(docs, 12)


def test_odd_rows(spark):
    """Nulls, empty texts, equal rows and columns with clashing names."""
    long = " ".join(f"w{i % 997}" for i in range(9_000))
    texts = {None: [long[:300]], 1: ["short"], 2: ["short", "short"], 3: [None], 4: [""], 5: [long], 6: [long + " more"], 7: [long[50:500]] * 4}
    data = [(i, t, "s") for i, some in texts.items() for t in some]
    df = documents(spark, data).withColumnsRenamed({"key": "id", "line": "h", "body": "m"})
    assert set(CLASHING) - set(df.columns) == {"key", "line", "body"}
    assert got(repeats.remove_repeats(df)) == plain([(i, t) for i, t, _ in data])


def test_rows_of_one_id(spark):
    """Rows of one id come one after the other, in whatever order; equal ones are repeats of one."""
    rng = random.Random(5)
    x, y = ("".join(rng.choices("abcdefgh ", k=400)) for _ in range(2))
    found = got(repeats.remove_repeats(frame(spark, [(1, x + y), (1, x), (1, x), (1, y[:99]), (1, y[:99])])))
    either = [plain([(1, t) for t in order]) for order in ([x + y, x, x, y[:99], y[:99]], [x, x + y, x, y[:99], y[:99]])]
    assert found in either


def test_empty(spark):
    assert repeats.remove_repeats(empty(spark)).count() == 0
    assert got(repeats.remove_repeats(frame(spark, [(1, ""), (2, None), (3, "x" * 99)]))) == plain([(1, ""), (2, None), (3, "x" * 99)])


@pytest.mark.parametrize("stretch", [100, 150, 1000, 1 << 20])
def test_stretches(monkeypatch, stretch):
    """However texts are cut, each window belongs to one entry, whose trigger lies in it."""
    rng = random.Random(stretch)
    texts = [bytes(rng.choices(b"abcdefgh", k=n)) for n in (0, 99, 100, 101, 350, 2000)] + [b"z" * 500]
    seen = []
    for parts in repeats._cuts(enumerate(texts), 100, stretch):
        for k, start, low, high in zip(*repeats._entries(parts, 100, 24)[:4], strict=True):
            assert 0 <= low <= high <= 76
            seen += [(k, start - t) for t in range(low, high + 1)]
    assert sorted(seen) == [(k, p) for k, t in enumerate(texts) for p in range(len(t) - 99)]


def test_least_places():
    rng = np.random.default_rng(0)
    for wide in (1, 2, 5, 77):
        h = rng.integers(0, 9, 300).astype(np.uint64)
        assert repeats.least_places(h, wide).tolist() == [p + int(h[p : p + wide].argmin()) for p in range(len(h) - wide + 1)]


def test_rolling_hashes():
    x = np.frombuffer(b"abcabcabcabc" * 4, np.uint8)
    h = repeats.rolling_hashes(x, 6)
    assert len(h) == len(x) - 5 and all((h[i] == h[j]) == (x[i : i + 6].tolist() == x[j : j + 6].tolist()) for i in range(12) for j in range(12))
