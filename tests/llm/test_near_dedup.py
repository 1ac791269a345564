"""Near-dedup by similarity against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from nickmap.llm import simhash
from tests.llm.plain import plain_kept
from tests.llm.test_operators import documents, empty


@pytest.mark.parametrize(("tile", "part"), [(10_000, 10_000_000), (40, 3_000)])
def test_keep_one_holds_links_to_similarity(spark, monkeypatch, tile, part):
    """Texts that share at least four fifths go with each other, and none that share less, in one tile and in many."""
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(16)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocabulary, k=40)
    base = [passage * (i % 2) + rng.choices(vocabulary, k=rng.randint(20, 150)) for i in range(25)]
    data = []
    for i in range(200):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        data.append((i, " ".join(words), "s"))
    data += [(300, None, "s"), (301, "", "s"), (302, " \n", "s"), (None, data[3][1], "s"), (3, data[3][1], "s"), (303, data[3][1].upper(), "s")]
    docs = documents(spark, data)
    want = plain_kept(data)
    assert 30 < len(want) < 150
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.collect())
    # The radius may miss a pair right at the bound, but no text goes that is not that similar to another.
    assert set(want) <= set(got) and len(got) <= len(want) * 1.02
    assert simhash.keep_one(empty(spark)).count() == 0


def test_near_dedup_stage_links_at_four_fifths(spark):
    """The stage drops a text with a few words changed, which lies beyond the three bits of op9."""
    import corpus_pipeline

    rng = random.Random(3)
    words = [f"w{rng.randrange(5000)}" for _ in range(200)]
    other = list(words)
    for at in (20, 90, 160):
        other[at] = "changed"
    data = [(1, " ".join(words), "s"), (2, " ".join(other), "s"), (3, " ".join(reversed(words)), "s")]
    bits = [int.from_bytes(simhash.fingerprint(t)) for _, t, _ in data]
    assert (bits[0] ^ bits[1]).bit_count() > 3
    out = corpus_pipeline.near_dedup(spark, documents(spark, data), "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 3] and out.where(F.col("text").isNull()).count() == 0
