"""Each operator against a brute-force version, over tables with nulls, repeated rows, odd texts and clashing columns."""

import hashlib
import math
import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from nickmap.llm import arrow_output, components, imatch, line_dedup, mixing, packing, quality, secrets, simhash, token_counts, tokens, topk
from nickmap.llm.common import held_out, shared_dir, table
from tests.conftest import rows
from tests.llm.plain import plain_kept

WORD = tokens.tokenizer_path("word_bpe_49k.json")
BYTE = tokens.tokenizer_path("byte_bpe_50k.json")
#: Columns that an operator might use within.
CLASHING = ["key", "line", "body", "part", "ids", "print", "bucket", "row", "row_id", "size", "n", "at", "first", "flags", "score", "start", "place", "of", "target"]


def documents(spark, data=None):
    """doc_id, text, source and columns with clashing names; nulls in each, repeated rows and ids, empty and long texts."""
    if data is None:
        long = " ".join(f"w{i % 997}" for i in range(30_000))
        data = [(1, "the quick brown fox jumps over the lazy dog", "a"), (2, "the quick brown fox jumps over the lazy dog", "b"), (2, "the quick brown fox jumps over the lazy dog", "b"), (3, "", "a"), (4, None, None), (None, "no id at all here", "a"), (5, long, "b"), (6, long + " more", "c"), (7, "   \n\t ", None), (7, "same id, another text", "c"), (8, "ÀÉ ß 日本 🙂", "é")]
    extra = "".join(f", {c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in data], f"doc_id long, text string, source string{extra}")


def empty(spark):
    return documents(spark, [])


def collected(df):
    return [tuple(r) for r in df.collect()]


# Line dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_bounded_distance(spark, threshold):
    rng, pairs = random.Random(threshold), [("", ""), ("", "a"), ("abc", ""), ("日本", "日x本"), ("a" * 70, "a" * 71)]
    for _ in range(150):
        a = "".join(rng.choices("abé", k=rng.randint(0, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choices("abé", k=rng.randint(0, 1))
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = collected(df.select("a", "b", line_dedup.bounded_distance(F.col("a"), F.col("b"), threshold)))
    for a, b, d in got:
        assert d == (distance(a, b) if distance(a, b) <= threshold else None), (a, b)


def plain_classes(docs, threshold, min_chars=20):
    """Class of each line by all pairs."""
    normal = lambda s: s.strip(" \t\r\x0b\x0c").lower()
    lines = [(i, k, normal(x)) for i, text in docs if text is not None for k, x in enumerate(text.split("\n"))]
    heads, distinct = {}, sorted({n for _, _, n in lines if n})
    group = {n: n for n in distinct}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for x, a in enumerate(distinct):
        for b in distinct[:x]:
            if min(len(a), len(b)) >= min_chars and abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold:
                group[root(a)] = root(b)
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    for i, k, n in lines:
        if n in group:
            heads[root(n)] = min(heads.get(root(n), (i, k)), (i, k), key=order)
    return {(i, k): (heads[root(n)] if n in group else (i, k)) for i, k, n in lines}


def line_documents(seed, n=30):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcde ", k=rng.randint(18, 40))) for _ in range(12)]
    out = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(1, 5)):
            x = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                at = rng.randint(0, len(x) - 1)
                x[at : at + rng.randint(0, 1)] = rng.choices("abcde", k=rng.randint(0, 1))
            lines.append("".join(x).upper() if rng.random() < 0.2 else "".join(x))
        out.append((i, "\n".join(lines)))
    return [*out, (n, None), (n + 1, ""), (n + 2, "\n\n"), (0, out[0][1]), (None, out[3][1])]


@pytest.mark.parametrize(("threshold", "bucket"), [(1, 2), (2, 32)])
def test_line_classes(spark, monkeypatch, threshold, bucket):
    monkeypatch.setattr(line_dedup, "BUCKET", bucket)
    data = line_documents(threshold * 10 + bucket)
    got = line_dedup.line_classes(documents(spark, [(i, t, "s") for i, t in data]), threshold).collect()
    want = plain_classes(data, threshold)
    assert {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no) for r in got} == want
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.class_doc_id, r.class_line_no)) for r in got)
    assert len(got) == sum(len(t.split("\n")) for _, t in data if t is not None)


def test_crowd_of_near_lines(spark):
    """Hundreds of variants of a line, each with a word of its own, cost no pairs; those one letter apart are linked."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(30)]
    data = []
    for i in range(300):
        x = list(words)
        x[rng.randrange(30)] = "".join(rng.choices("ijklmnop", k=6))
        data.append((i, " ".join(x), "s"))
    data += [(1000, data[5][1][:-1] + "z", "s"), (1001, data[7][1] + "y", "s")]
    got = {r.doc_id: r.class_doc_id for r in line_dedup.line_classes(documents(spark, data)).collect()}
    want = plain_classes_fast([(i, t) for i, t, _ in data])
    assert got == {i: v[0] for (i, _), v in want.items()} and got[1000] == 5 and got[1001] == 7


@pytest.mark.parametrize("n", [400, 1600])
def test_hot_template(spark, n):
    """Many lines of one template with a short code of letters, some of them one edit apart, of either length."""
    rng = random.Random(n)
    codes = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(n)]
    codes += [c[:3] + "z" + c[4:] for c in codes[:20]] + [c[:5] + c[6:] for c in codes[20:40]] + [c + "q" for c in codes[40:60]] + ["", "a", "ab", "b"]
    texts = [f"the quick brown fox {c} over" for c in dict.fromkeys(codes)]
    got = {r.doc_id: r.class_doc_id for r in line_dedup.line_classes(documents(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    want = plain_classes_fast(list(enumerate(texts)))
    assert got == {i: v[0] for (i, _), v in want.items()} and len(set(got.values())) <= len(texts) - 60


def test_rests_of_few_characters(spark):
    """Lines that differ in none to three characters at the end, all of them in one bucket."""
    import itertools

    texts = ["a common beginning of it" + "".join(x) for k in range(4) for x in itertools.product("xyz", repeat=k)]
    sig = spark.createDataFrame([(7, i, t[24:]) for i, t in enumerate(texts)], "sig long, key long, rest string")
    got = {frozenset((r.u, r.v)) for r in line_dedup._keyed(sig).collect()}
    assert all(distance(texts[a], texts[b]) <= 1 for a, b in map(tuple, got))
    root = {r.v: r.root for r in components.connected_components(spark.createDataFrame([tuple(x) for x in got], "u long, v long")).collect()}
    assert set(root.values()) == {0} and len(root) == len(texts)


def test_outer_white_space(spark):
    data = [(1, "a line of some length here", "s"), (2, "\t\ta line of some length here\r", "s"), (3, " \t\r\n \t\r", "s")]
    got = {(r.doc_id, r.line_no): r.class_doc_id for r in line_dedup.line_classes(documents(spark, data)).collect()}
    assert got == {(1, 0): 1, (2, 0): 1, (3, 0): 3, (3, 1): 3}


def test_dedup_lines_keeps_rows_and_columns(spark):
    data = [(i, t, "s") for i, t in line_documents(9)]
    docs = documents(spark, data)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == docs.columns
    want, classes = [], plain_classes([(i, t) for i, t, _ in data], 1)
    for i, t, _ in data:
        want.append((i, t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if classes[i, k] == (i, k))))
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(want, key=key)
    assert {r.key for r in got.collect()} == {"x"}
    assert line_dedup.dedup_lines(empty(spark)).count() == 0 and line_dedup.line_classes(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(6)
    for n, m in ((0, 0), (200, 160)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(1000, 1000 + n)]
        group = {v: v for e in edges for v in e}

        def root(v, group=group):
            while group[v] != v:
                v = group[v]
            return v

        for a, b in edges:
            group[max(root(a), root(b))] = min(root(a), root(b))
        got = {r.v: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
        alone = {v for v in group if all(a == b for a, b in edges if v in (a, b))}
        assert got == {v: root(v) for v in group if v not in alone}


# Quality


def test_quality_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels))
    judged = scored.join(labels, "doc_id").where("held_out").toPandas()
    assert len(judged) > 50 and (judged.predicted == judged.quality).mean() > 0.95
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0
    # Labels of held-out rows change nothing.
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score_quality(docs, quality.fit_quality(docs, flipped))
    assert rows(again) == rows(scored)


def test_quality_edges(spark):
    docs, labels = documents(spark), spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (99, 0), (5, 7)], "doc_id long, quality int")
    got = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    none = quality.fit_quality(empty(spark), labels)
    assert quality.score_quality(empty(spark), none).count() == 0
    assert quality.keep_quality(docs, none).columns == docs.columns
    assert quality.features(None) == quality.features("") == [0.0] * len(quality.FEATURES)


def test_additive_model_learns_pairs():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


# Fingerprints


def test_fingerprints(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    data = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40))), "s") for i in range(40)] + [(50, None, "s"), (51, "", "s"), (52, "日本 🙂 x", "s")]
    data += [(53, data[3][1], "s")]
    docs = documents(spark, data)
    known = imatch.lexicon(docs, 0.05, 0.6)
    df = {w: sum(w in (t or "").split() for _, t, _ in data) for w in words}
    from xxhash import xxh64_intdigest

    assert known == {xxh64_intdigest(w.encode()) for w, n in df.items() if max(2, 0.05 * len(data)) <= n <= 0.6 * len(data)}
    got = {r.doc_id: r for r in imatch.edited_fingerprints(docs, known).collect()}
    f, order = imatch.Fingerprinter(known), sorted(data, key=lambda r: -r[0])
    assert len(got) == len(data)
    for k, (i, text, _) in enumerate(order):
        text, other = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 2
        edited = text[: len(text) - cut] + other[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (f.digest(text).hex(), f.digest(edited).hex())
        assert r.near_next == imatch.likeness(f.digest(text), f.digest(other)) and 0 <= r.near_edited <= 1
    assert got[3].fingerprint == got[53].fingerprint
    assert rows(imatch.fingerprints(docs, known)) == sorted((str(r.doc_id), r.fingerprint) for r in got.values())


def plain_digest(text, known):
    """The definition in whole numbers: each subset's terms by their own numbers, sorted, and hashed."""
    import re

    from xxhash import xxh32_intdigest, xxh64_intdigest

    most = (1 << 64) - 1

    def mixed(h, salt):
        x = (h ^ (salt + 1)) * 0x9E3779B97F4A7C15 & most
        x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & most
        return x ^ x >> 29

    found = set(re.findall(r"\w+", (text or "").lower()))
    inside, out = sorted({xxh64_intdigest(t.encode()) for t in found} & set(known)), []
    for s in range(96):
        some = [h for h in inside if mixed(h, s) < 1 << 63 - s // 8]
        out.append(xxh32_intdigest(b"".join(h.to_bytes(8, "little") for h in some)) % 65535 + 1 if some else 0)
    if found and not inside:
        out[0] = xxh32_intdigest(" ".join(sorted(found)).encode()) % 65535 + 1
    return out


def test_fingerprints_by_definition(spark):
    """Fingerprints and likenesses against the definition, and texts of which half is kept against others."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(3000)]
    data = [(i, " ".join(rng.choices(words, k=rng.choice([3, 40, 300, 1500]))), "s") for i in range(60)] + [(70, None, "s"), (71, "only other terms", "s")]
    docs = documents(spark, data)
    known = imatch.lexicon(docs, 0.02, 0.9)
    got = {r.doc_id: r for r in imatch.edited_fingerprints(docs, known).collect()}
    order, above = sorted(data, key=lambda r: -r[0]), 0
    for k, (i, text, _) in enumerate(order):
        text, other = text or "", order[(k + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        a, b, c = (plain_digest(t, known) for t in (text, edited, other))
        share = lambda x, y: sum(p == q for p, q in zip(x, y) if p or q) / max(1, sum(bool(p or q) for p, q in zip(x, y))) if any(x) or any(y) else 1.0
        r = got[i]
        assert r.fingerprint == "".join(f"{v:04x}" for v in a) and r.edited_fingerprint == "".join(f"{v:04x}" for v in b)
        assert abs(r.near_edited - share(a, b)) < 1e-9 and abs(r.near_next - share(a, c)) < 1e-9
        above += r.near_edited > r.near_next
    assert above >= 0.9 * len(data)


def test_neighbours_without_ids(spark, monkeypatch):
    """Many rows without an id, and ranges smaller than they are: each still has one next document, in one ring."""
    monkeypatch.setattr(imatch, "RANGE", 200)
    data = [(i if i % 3 else None, f"text number {i}", "s") for i in range(150)] + [(None, None, "s"), (None, "", "s")]
    got = imatch.edited_fingerprints(documents(spark, data), frozenset()).collect()
    assert len(got) == len(data) and sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t, _ in data)
    order = [t for i, t, _ in sorted((x for x in data if x[0] is not None), key=lambda x: -x[0])]
    want = {t: hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for t, n in zip(order, order[1:])}
    assert all(r.edited_sha256 == want[f"text number {r.doc_id}"] for r in got if r.doc_id is not None and f"text number {r.doc_id}" in want)


def test_fingerprint_edges(spark):
    docs = documents(spark)
    got = imatch.edited_fingerprints(docs, imatch.lexicon(docs))
    assert got.count() == docs.count()
    assert imatch.edited_fingerprints(empty(spark), imatch.lexicon(empty(spark))).count() == 0
    one = documents(spark, [(9, "abcdef", "s")])
    assert one.count() == 1 and imatch.edited_fingerprints(one, frozenset()).first().edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


# Top-k


def plain_top(vectors, k, every):
    """Sorted (query_id, rank, vec_id, score) over rows (vec_id, numbers), each row a query or a candidate of its own."""
    best = []
    for a, (i, x) in enumerate(vectors):
        if i % every == 0:
            scores = sorted((-sum(p * q for p, q in zip(x, y)), j) for b, (j, y) in enumerate(vectors) if a != b)[:k]
            best += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(best)


@pytest.mark.parametrize(("n", "wide", "block"), [(0, 3, 4096), (1, 3, 4096), (4, 3, 4096), (120, 8, 16), (300, 5, 64)])
def test_top_k(spark, monkeypatch, n, wide, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "TILE", 3)
    rng = random.Random(n)
    data = [(i, [rng.choice([rng.gauss(0, 1), 0.5, -0.25]) for _ in range(wide)], "x") for i in range(n)]
    data += data[:1] + [(i, [0.75] * wide, "x") for i in (0, 1, 7) if i < n]  # repeated ids, of an equal and of another vector
    bad = [(1000, None, "x"), (1050, [1.0, None, 0.0], "x"), (1100, [math.nan] * 3, "x"), (1150, [math.inf, 0.0, 0.0], "x"), (None, [1.0] * 3, "x")]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<float>, row string")
    whole = [(i, [math.floor(256 * float(np.float32(v))) for v in x]) for i, x, _ in data]
    assert sorted(tuple(r) for r in topk.top_k(df, 5, 10).collect()) == plain_top(whole, 5, 10)


def test_top_k_agrees_with_its_sql_on_repeated_ids(spark, tmp_path):
    import duckdb

    rng = random.Random(1)
    data = [(i % 120, [rng.gauss(0, 1) for _ in range(6)]) for i in range(200)]
    spark.createDataFrame(data, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(topk.OP4_SQL).fetchall()
    assert sorted(tuple(r) for r in topk.op4_top_k(spark, str(tmp_path)).collect()) == sorted(want)


def test_nra_with_large_numbers_and_ties():
    rng = np.random.default_rng(3)
    for scale in (3, 1 << 20, 1 << 29):
        x = rng.integers(-scale, scale, (200, 6))
        q = rng.integers(-scale, scale, (20, 6))
        got: dict = {}
        for i, j, s in zip(*topk.nra_block(q, x, np.full(20, -1), np.arange(200), 7)[:3], strict=True):
            got.setdefault(int(i), []).append((-int(s), int(j)))
        exact = x.astype(object) @ q.astype(object).T
        assert got == {i: sorted((-int(s), j) for j, s in enumerate(exact[:, i]))[:7] for i in range(20)}


def test_nra_stops_reading_where_scores_are_skewed():
    """Few vectors with large components are found in the first part of the lists, and zero weights need no list."""
    rng = np.random.default_rng(5)
    x = np.abs(rng.normal(0, 8, (4000, 8))).astype(np.int64)
    x[:20] += rng.integers(200, 400, (20, 8))
    q = rng.integers(1, 50, (30, 8))
    q[:, 6:] = 0
    rows, best, scores, entries = topk.nra_block(q, x, np.full(30, -1), np.arange(4000), 5)
    exact = q @ x.T
    for i in range(30):
        assert sorted(scores[rows == i]) == sorted(exact[i])[-5:]
    assert entries <= 30 * 6 * len(x) / 4


# Secrets


def test_secrets(spark):
    """Trained on findings planted into some documents, the forest parts those planted into others, and what the others hold."""
    rng, data = random.Random(8), []
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    words = ["some", "words", "and", "more", "here", "there"]
    for i in range(300):
        data.append((i, f'{" ".join(rng.choices(words, k=60))} token = "{hexes(40)}" and more\ncard {rng.randint(10**15, 10**16)} at 10.{i % 200}.33.{rng.randint(100, 200)} here', "src"))
    docs = documents(spark, data).withColumnRenamed("source", "path")
    common = secrets.common_words(docs, 50)
    assert len(common) <= 50 and "words" in common
    forest = secrets.train(secrets.planted_findings(docs.where("doc_id % 2 = 0"), common))
    held = secrets.planted_findings(docs.where("doc_id % 2 = 1"), common, seed=8).collect()
    says, is_secret = forest.score(np.array([r.x for r in held])) >= 0.5, np.array([r.is_secret for r in held])
    assert len(held) > 1000 and (says & is_secret).sum() >= 0.95 * max(says.sum(), is_secret.sum())
    text = {i: t for i, t, _ in data}
    found = secrets.scan(docs.where("doc_id % 2 = 1"), forest, common).collect()
    assert len(found) >= 300
    for r in found:
        word = text[r.doc_id][r.start : r.start + r.length]
        assert r.sha256 == hashlib.sha256(word.encode()).hexdigest() and r.is_secret == (len(word) == 40)


def test_secret_edges(spark, tmp_path):
    docs = documents(spark).withColumnRenamed("source", "path")
    forest = secrets.train(secrets.planted_findings(docs, frozenset()))
    assert secrets.scan(empty(spark).withColumnRenamed("source", "path"), forest, frozenset()).count() == 0
    assert {r.score for r in secrets.scan(docs, secrets.Forest([np.zeros(0)] * len(secrets.FEATURES), [0.25]), frozenset()).collect()} <= {0.25}
    assert secrets.fit_forest(np.zeros((0, len(secrets.FEATURES))), np.zeros(0)).score(np.zeros((2, len(secrets.FEATURES)))).tolist() == [0.5, 0.5]
    # The query on a table that has columns of the names used within.
    clash = docs.select("doc_id", "text", F.lit("src").alias("source"), "path", F.lit(1).alias("x"), F.lit("z").alias("h"), F.lit(0).alias("start"))
    clash.write.parquet(str(tmp_path / "documents.parquet"))
    assert secrets.op5_secrets(spark, str(tmp_path)).columns == ["doc_id", "start", "length", "sha256", "score", "is_secret"]
    clash.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert secrets.op5_secrets(spark, str(tmp_path / "none")).count() == 0


# Tokens


def test_token_counts_and_cache(spark):
    cache, docs = shared_dir(spark, "test-cache"), documents(spark)
    e = tokens.encoder(BYTE)
    want = sorted((str(r.doc_id) if r.doc_id is not None else "null", str(len((r.text or "").encode())), str(len(e.whole(r.text or "")) // 2 if r.text else 0), str((len(e.whole(r.text)) // 2 if r.text else 0) > 9)) for r in docs.collect())
    got = token_counts.count_tokens(docs, BYTE, cache, 9).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert sorted(tuple("null" if v is None else str(v) for v in r) for r in got.collect()) == want
    known = spark.read.parquet(cache)
    assert known.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    # Nothing is encoded again: a count changed in the cache is what the next call returns. A new text is added.
    n = known.count()
    again = token_counts.count_tokens(docs.unionByName(documents(spark, [(77, "brand new words", "a")])), BYTE, cache, 9)
    assert again.count() == docs.count() + 1 and spark.read.parquet(cache).count() == n + 1
    token_counts.count_tokens(docs, WORD, cache, 9).count()
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2
    # The query with that cache: what it lacks is appended, and a second call appends nothing.
    token_counts.op6_token_counts(spark, "/root/testdata/sf0.001", cache).count()
    n = spark.read.parquet(cache).count()
    assert token_counts.op6_token_counts(spark, "/root/testdata/sf0.001", cache).count() == table(spark, "/root/testdata/sf0.001", "documents").count()
    assert spark.read.parquet(cache).count() == n
    assert token_counts.count_tokens(empty(spark), BYTE, shared_dir(spark, "test-cache")).count() == 0


def encoded(docs):
    e = tokens.encoder(WORD)
    return [(r.doc_id, np.concatenate([np.frombuffer(e.whole(r.text or ""), "<u2") if r.text else np.zeros(0, "<u2"), [2]]).astype("<u4")) for r in docs.collect()]


@pytest.mark.parametrize("length", [4, 2048])
def test_arrow_round_trip(spark, length):
    docs, folder = documents(spark), shared_dir(spark, "test-arrow")
    shards = arrow_output.write_sequences(docs, WORD, folder, 2, length, 8)
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    stream = np.concatenate([x for _, x in encoded(spark.createDataFrame(order, docs.schema).coalesce(1))])
    found = shards.orderBy("start").collect()
    assert sum(r.ids for r in found) == len(stream) and sum(r.documents for r in found) == docs.count()
    for r in found:
        shard, mine = arrow_output.Shard(folder, r.shard), stream[r.start : r.start + r.ids]
        for i in range(-(-r.ids // length)):
            ids, mask = shard.sequence(i)
            want = mine[i * length : (i + 1) * length]
            assert len(ids) == len(mask) == length and (ids[mask] == want).all() and mask.sum() == len(want) and not ids[~mask].any()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in arrow_output.read_documents(shards, folder).collect())
    assert got == sorted((i is not None, i or 0, len(x), zlib.crc32(x.tobytes())) for i, x in encoded(docs))
    assert arrow_output.write_sequences(empty(spark), WORD, shared_dir(spark, "test-arrow"), 2).count() == 0


def test_packing(spark):
    docs = documents(spark)
    got = packing.pack_documents(docs, WORD, 2, 64).toPandas()
    want: dict = {}
    for i, x in encoded(docs):
        want.setdefault(i, []).append(x.tolist())
    for n, pieces in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert (pieces.offset.to_numpy() == np.cumsum(pieces.length) - pieces.length).all()
        assert pieces.length.sum() == 64 or n == got.sequence_id.max()
    for r in got.itertuples():
        known = want[None if r.doc_id != r.doc_id else int(r.doc_id)]
        assert any(len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in known)
    assert got.length.sum() == sum(len(x) for v in want.values() for x in v)
    assert packing.pack_documents(empty(spark), WORD, 2).count() == 0


# Mixing


def plain_targets(sizes, weights, total, most):
    """Targets by clamping and resharing until none is above its cap."""
    target, capped = {}, {}
    while True:
        open_ = {s: w for s, w in weights.items() if s not in capped}
        left = total - sum(capped.values())
        target = capped | {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = {s: most * sizes[s] for s in open_ if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing(spark):
    rng = random.Random(3)
    data = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a", "é", "b", "Z", None] + ["hot"] * 5)) for i in range(400)]
    docs = documents(spark, data + data[:3])
    got = mixing.mix_sources(docs).toPandas()
    of = {i: s for i, _, s in data}
    names = sorted({s for s in of.values() if s is not None}) + [None]
    sizes = {s: 0 for s in names}
    for _, text, s in data + data[:3]:
        sizes[s] += len(text.split())
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    want = plain_targets(sizes, weights, 1.5 * sum(sizes.values()), 2.0)
    got["of"] = [of[i] for i in got.doc_id]
    for s in names:
        mine = got[got["of"].isna()] if s is None else got[got["of"] == s]
        assert (mine.source_size == sizes[s]).all() and np.allclose(mine.target, want[s]) and abs(mine.taken.sum() - want[s]) <= 1
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    assert rows(mixing.mix_sources(docs)) == rows(mixing.mix_sources(docs.repartition(7)))
    # The mix itself has the words that the digest tells.
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.select(F.sum(mixing.words(F.col("text")))).first()[0] == got.taken.sum()


def test_mixing_edges(spark):
    docs = documents(spark)
    # Rows without ids, each with a text of its own, are drawn one by one and alike in a rerun.
    nameless = documents(spark, [(None, " ".join(["w"] * (i % 7 + 1)) + f" {i}", "a") for i in range(300)] + [(1, "w " * 300, "b")])
    got = mixing.mix_sources(nameless)
    assert rows(got) == rows(mixing.mix_sources(nameless.repartition(5))) and {r.taken - r.size for r in got.where("doc_id is null").collect()} >= {0}
    assert mixing.mix_sources(docs).count() == docs.count()
    assert mixing.mix_sources(empty(spark)).count() == 0 and mixing.mix_documents(empty(spark)).count() == 0
    blank = documents(spark, [(1, "", "a"), (2, None, None)])
    assert {r.taken for r in mixing.mix_sources(blank).collect()} == {0} and mixing.mix_documents(blank).count() == 0


# SimHash


def plain_fingerprint(text, repeats=True):
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in (shingles if repeats else set(shingles))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(prints, radius):
    group = list(range(len(prints)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                group[root(a)] = root(b)
    return [root(k) for k in range(len(prints))]


@pytest.mark.parametrize("tile", [16, 10_000])
def test_simhash(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(5)
    base = [" ".join(rng.choices(["a", "b", "c", "d", "e", "f", "g"], k=rng.randint(1, 60))) for _ in range(30)]
    data = []
    for i in range(150):
        words = rng.choice(base).split()
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = "x"
        data.append((i, " ".join(words), "s"))
    data += [(200, None, "s"), (201, "", "s"), (202, " \n", "s"), (None, base[0], "s"), (5, data[5][1], "s")]
    docs = documents(spark, data)

    def least(prints):
        roots, found = plain_components(prints, 3), {}
        for k, (i, _, _) in enumerate(data):
            if i is not None:
                found[roots[k]] = min(found.get(roots[k], i), i)
        return [found.get(r) for r in roots]

    prints = [plain_fingerprint(t) for _, t, _ in data]
    want = sorted((str(i), f"{p:016x}", str(c)) for (i, _, _), p, c in zip(data, prints, least(prints)))
    assert sorted(tuple(map(str, r)) for r in collected(simhash.near_duplicates(docs))) == want
    once = least([plain_fingerprint(t, repeats=False) for _, t, _ in data])
    kept = simhash.keep_one(docs, radius=3, shingle=3, words=1, similarity=None)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in once if c is not None})
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0
    assert simhash.near_duplicates(documents(spark)).count() == documents(spark).count()


def test_tiles_are_skipped_by_population_count():
    """Pairs of tiles that hold no two fingerprints near enough are not planned, and no other is left out."""
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    ones = np.bitwise_count(prints).astype(int)
    plan = simhash.tile_plan({int(c): int(n) for c, n in zip(*np.unique(ones, return_counts=True))}, 3, 256)
    tiles = {t for first, n, _, _ in plan.values() for t in range(first, first + n)}
    made = {(min(t, u), max(t, u)) for first, n, a, b in plan.values() for t in range(first, first + n) for u in range(a, b + 1)}
    assert tiles == set(range(len(tiles))) and len(tiles) >= len(prints) / 256
    assert len(made) < 0.75 * len(tiles) * (len(tiles) + 1) / 2
    for x, (first, n, _, _) in plan.items():
        for y, (other, m, _, _) in plan.items():
            if abs(x - y) <= 3:
                assert all((min(t, u), max(t, u)) in made for t in range(first, first + n) for u in range(other, other + m))
    assert simhash.tile_plan({}, 3) == {}


def test_dense_ball_costs_its_size():
    """Thousands of fingerprints that all lie within the radius give one link less than there are, and soon."""
    import time

    rng = np.random.default_rng(4)
    ball = np.unique(np.uint64(0x0123456789ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, (8000, 3), dtype=np.uint64)).sum(1, dtype=np.uint64))[:, None]
    began = time.monotonic()
    assert len(simhash.tile_links(ball, ball, 12, True)) == len(ball) - 1
    assert len(simhash.tile_links(ball[:4000], ball[4000:], 12, False)) == len(ball) - 1
    assert time.monotonic() - began < 30


# Pipeline


def test_pipeline_stages(spark, tmp_path):
    """Each stage, and run(), against plain versions on small tables."""
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = [i for i in sorted(texts) if model.score(np.array([quality.features(texts[i])]))[0] >= 0.7]
    at, stages = docs, dict(corpus_pipeline.STAGES)
    at = stages["quality"](spark, docs, sf_dir)
    assert sorted(r.doc_id for r in at.collect()) == good and at.columns == docs.columns
    classes = plain_classes_fast([(i, texts[i]) for i in good])
    lines = {i: "\n".join(x for k, x in enumerate(texts[i].split("\n")) if classes[i, k] == (i, k)) for i in good}
    at = stages["line_dedup"](spark, at, sf_dir)
    assert {r.doc_id: r.text for r in at.collect()} == lines and at.columns == docs.columns
    at = stages["near_dedup"](spark, at, sf_dir)
    assert sorted(r.doc_id for r in at.collect()) == plain_kept([(i, lines[i], None) for i in good]) and at.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(at).collect()}
    at = stages["mixing"](spark, at, sf_dir)
    mixed = at.groupBy("doc_id").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()
    assert {r.doc_id: r.n for r in mixed if r.n} == {i: n for i, n in taken.items() if n} and at.columns == docs.columns
    pieces = stages["packing"](spark, at, sf_dir)
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(x) for _, x in encoded(at))
    whole = corpus_pipeline.run(spark, sf_dir)
    key = lambda df: sorted(collected(df.groupBy("doc_id", "start", "length", "ids_crc32", "doc_tokens").count().groupBy("doc_id", "doc_tokens").agg(F.sum(F.col("count") * F.col("length")))))
    assert key(whole) == key(pieces)


def plain_classes_fast(docs):
    """Classes for threshold 1 by shared deletions."""
    lines = [(i, k, x.strip(" \t\r\x0b\x0c").lower()) for i, text in docs for k, x in enumerate(text.split("\n"))]
    group, meet = {n: n for _, _, n in lines if n}, {}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for n in sorted(n for n in group if len(n) >= 20):
        for v in {n} | {n[:p] + n[p + 1 :] for p in range(len(n))}:
            for m in meet.setdefault(hash(v), []):
                if m != n and distance(m, n) <= 1:
                    group[root(n)] = root(m)
            meet[hash(v)].append(n)
    heads: dict = {}
    for i, k, n in lines:
        if n:
            heads[root(n)] = min(heads.get(root(n), (i, k)), (i, k))
    return {(i, k): heads[root(n)] if n else (i, k) for i, k, n in lines}


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (documents(spark), empty(spark)):
        at, n = docs, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns
                out.write.mode("overwrite").parquet(str(tmp_path / f"{name}-{n}"))
                at = spark.read.parquet(str(tmp_path / f"{name}-{n}"))
            else:
                out.count()


def test_registry_without_this_subpackage(tmp_path):
    """The other queries stand without this subpackage and the pipeline."""
    import shutil
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "nickmap", tmp_path / "nickmap", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and set(e.oracle_sql()) <= set(e.queries()); assert not any(k.startswith('op') for k in e.queries())"
    env = {"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env).returncode == 0
