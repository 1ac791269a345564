"""Steps that several queries share: what they shuffle, and that they give what the plainer forms give."""

from pyspark.sql import functions as F

from nickmap.operators import evidence, mapops, stitch
from nickmap.plans import inputs, queries
from nickmap.sources.shared import written
from tests.conftest import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(df):
    return _plan(df).count("Exchange hashpartitioning")


def test_labels_are_sent_to_their_maps_once(spark, small):
    """F6 to F8: nothing is joined to find the labels of maps."""
    refs = written(inputs.ref_labels(spark, small), "refs")
    pairs = inputs.map_pairs(spark, small, refs)
    assert _shuffles(pairs) == 1 and "Join" not in _plan(pairs)
    assert _shuffles(inputs.alignments(spark, small, refs)) == 1


def test_labels_of_maps_with_gaps_and_nulls(spark):
    """A block that lacks labels, one whose map starts in the block before, and labels of no reference."""
    table = [(1, s, 100 * s, 1.0) for s in (*range(1, 9), 11, 12, *range(17, 25), *range(25, 33))] + [(None, 1, 5, 1.0)]
    refs = spark.createDataFrame(table, "ref_id long, site_id long, pos long, coverage double")
    maps = inputs.blocks(spark, "", refs).where("ref_id is not null").withColumn("ref_site", F.explode(F.sequence("s0", "s1")))
    want = maps.join(refs.withColumnRenamed("site_id", "ref_site"), ["ref_id", "ref_site"]).select("ref_id", "ref_site", "map_id", (F.col("s1") - F.col("s0") + 1).alias("num_sites"), "orientation", "confidence")
    got = inputs.aligned_labels(spark, "", refs)
    assert rows(got.select(*want.columns)) == rows(want) and {r.map_id for r in want.collect()} == {1000, 1001, 1002, 1003}
    assert {(r.map_id, r.num_sites) for r in got.collect()} >= {(1001, 2), (1003, 11)}


def test_covering_maps_bring_positions(spark):
    """F6 to F8: the places that map_positions finds come with the labels, and the pairs are read once."""
    sites = spark.createDataFrame([("a", 1, 1, 2), ("b", 1, 2, 3), ("c", 1, 0, 1), ("d", 2, 5, 6)], "site_key string, ref_id long, start_label long, end_label long")
    pairs = spark.createDataFrame([(1, 1, 7, 3, 10, 0), (1, 2, 7, 2, 20, 0), (1, 2, 8, 1, 20, 1), (1, 3, 8, 2, 45, 1)], "ref_id long, ref_site long, map_id long, map_site long, map_pos long, entry long")
    plain = evidence.map_positions(evidence.covering_maps(sites, pairs.drop("map_pos")), pairs.select("map_id", F.col("map_site").alias("site_id"), F.col("map_pos").alias("pos")))
    got = evidence.covering_maps(sites, pairs)
    assert rows(got) == rows(plain)
    assert sorted(r[:1] + r[4:] for r in map(tuple, got.collect())) == [("a", 7, 3, 2, 10, 20), ("b", 8, 1, 2, 20, 45), ("c", 7, 0, 3, 0, 10), ("d", 0, 0, 0, 0, 0)]
    path = written(pairs, "pairs")
    assert _plan(evidence.covering_maps(sites, path)).split("Initial Plan")[0].count("FileScan") == 1


def test_molecules_of_the_runs_asked_for(spark, small):
    """F9 to F12: molecules of runs that support no site aren't told apart, the others are all counted."""
    every = queries._counted_runs(spark, small)
    some = every.select(*inputs.RUN).where("lab1 - lab0 > 6")
    got = queries._counted_runs(spark, small, some)
    assert rows(got) == rows(every.where("lab1 - lab0 > 6")) and got.count() < every.count()
    named = inputs.molecules(spark, small, by_run=True, among=some)
    assert rows(named) == rows(inputs.molecules(spark, small).where("lab1 - lab0 > 6"))
    assert "LeftSemi, BuildRight" in _plan(got) and "SortMergeJoin" not in _plan(got)


def test_lift_of_a_map_that_is_trimmed_whole(spark):
    """its labels are on no map any more; maps that aren't merged stay."""
    pairs = spark.createDataFrame([(1, 1, 7, 1), (1, 2, 7, 2), (1, 3, 8, 1), (1, 4, 9, 1)], "ref_id long, ref_site long, map_id long, map_site long")
    members = spark.createDataFrame([(7,), (8,)], "map_id long")
    merged = spark.createDataFrame([(90, 1, 7, 1), (90, 2, 7, 2), (90, 3, None, None)], "map_id long, site_id long, old_id long, old_site long")
    assert sorted(map(tuple, mapops.lift_merged(pairs, members, merged).collect())) == [(1, 1, 90, 1), (1, 2, 90, 2), (1, 4, 9, 1)]


def test_pairs_meet_the_reference_in_one_join(spark):
    """labels are looked up for both ends at once; where several lie at a place, each gives a row."""
    pairs = spark.createDataFrame([(1, 1, 10, 20), (1, 2, 20, 99), (2, 1, None, 10)], "ref_id long, pair_no int, first_ref_end long, second_ref_start long")
    labels = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (1, 3, 20), (2, 1, 10)], "ref_id long, site_id long, pos long")
    got = stitch.with_reference_labels(pairs, labels)
    assert sorted((r.ref_id, r.pair_no, r.end_label, r.start_label, r.label_distance) for r in got.collect()) == [(1, 1, 1, 2, 0), (1, 1, 1, 3, 1), (1, 2, 2, 0, -3), (1, 2, 3, 0, -4), (2, 1, 0, 1, 0)]
    path = written(labels, "labels")
    assert _plan(stitch.with_reference_labels(pairs, path)).split("Initial Plan")[0].count("FileScan") == 1


def test_scores_write_reference_labels_once(spark, small, monkeypatch):
    """one table of them for a query, without the coverage that no score has; the sites aren't joined to themselves."""
    tables = {}
    monkeypatch.setattr(queries, "written", lambda df, purpose: (tables.setdefault(purpose, []).append(df.columns), written(df, purpose))[1])
    plan = _plan(queries.scored_sites(spark, small)).split("Initial Plan")[0]
    assert [columns for purpose, found in tables.items() if purpose.startswith("ref-") for columns in found] == [["ref_id", "site_id", "pos"]]
    assert sum("/flanked-" in line and "site_key#" in line for line in plan.splitlines()) == 2  # the sites themselves, and their days


def test_scored_sites_of_rows_that_share_a_key(spark):
    """what the join of the sites to their scores gives, without it."""
    sites = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 1, 6), ("c", 3, 7)], "site_key string, ref_id long, score int")
    support = spark.createDataFrame([("a", 4, 3), ("c", 2, 1)], "site_key string, confidence int, molecules long")
    reads = spark.createDataFrame([("a", 2)], "site_key string, reads long")
    want = sites.drop("score").join(evidence.site_scores(sites, support, reads).select("site_key", "score"), "site_key")
    assert rows(evidence.scored_sites(sites, support, reads)) == rows(want) and want.count() == 6


def test_sites_on_references_without_molecules(spark, small, monkeypatch):
    """they are left out before they are sent to the labels' numbers, and lose no support."""
    refs = written(inputs.ref_labels(spark, small), "refs")
    flanked = written(queries._flanked(spark, small, refs), "flanked")
    want = rows(queries._support(spark, small, flanked, refs).select("site_key", "mol_id.*", "confidence"))
    seen = []
    support = evidence.molecule_support
    monkeypatch.setattr(evidence, "molecule_support", lambda covered, aligned: (seen.append(covered), support(covered, aligned))[1])
    monkeypatch.setattr(inputs, "molecule_runs", lambda spark, sf_dir, runs=inputs.molecule_runs: runs(spark, sf_dir).where("map_id < 3"))
    got = rows(queries._support(spark, small, flanked, refs).select("site_key", "mol_id.*", "confidence"))
    assert got and got == [r for r in want if int(r[3]) < 3] and len(got) < len(want)
    assert {r.map_id for r in seen[0].collect()} <= {0, 1, 2}


def test_labels_of_sites_that_share_a_key(spark, small, monkeypatch):
    """sites of one start but different ends have labels of their own."""
    sites = spark.createDataFrame([("1/100", 1, 100, 100), ("1/100", 1, 100, 300)], "site_key string, ref_id long, start_pos long, end_pos long")
    refs = spark.createDataFrame([(1, 1, 100), (1, 2, 200), (1, 3, 300)], "ref_id long, site_id long, pos long")
    monkeypatch.setattr(queries, "_keyed", lambda spark, sf_dir: sites)
    assert sorted((r.site_key, r.end_pos, r.start_label, r.end_label) for r in queries._flanked(spark, small, refs).collect()) == [("1/100", 100, 1, 1), ("1/100", 300, 1, 3)]
