"""The whole repair on the derived tables."""

from pyspark.sql import functions as F

from nickmap.operators import sequence, stitch
from nickmap.plans import inputs, queries
from nickmap.plans.repair import repair, repair_sequences


def _run(spark, small, limits):
    labels = queries._molecule_pairs(spark, small).groupBy("mol_id", F.col("map_id").alias("ref_id")).agg(F.array_sort(F.collect_list(F.col("map_site").cast("int"))).alias("labels")).withColumn("entry", F.col("mol_id"))
    return repair(inputs.alignments(spark, small), inputs.map_labels(spark, small), inputs.ref_labels(spark, small), inputs.nicks(spark, small), labels, inputs.reads(spark, small), limits, inputs.end_ratios(spark, small), gaps=(queries.WIDTH // 2, inputs.HOUR), threshold=1.0, min_piece=inputs.HOUR, width=queries.WIDTH)


def test_repair(spark, small):
    done = _run(spark, small, queries.LIMITS)
    assert done.maps.count() and done.stitches.count() == done.stitches.select("site_key").distinct().count()
    assert done.stitches.where("broken and evidence is not null").count() == 0
    assert done.statistics.agg(F.sum("sites").alias("n")).first().n == done.stitches.count()
    before = inputs.alignments(spark, small).count()
    assert done.alignments.count() == before - done.stitches.count()


def test_nothing_to_merge(spark, small):
    done = _run(spark, small, stitch.Limits(max_fill=-1, max_overlap=0))
    assert done.stitches.count() == 0
    assert done.maps.count() == inputs.map_labels(spark, small).count()


def _planted(spark):
    """One reference with 17 labels and two fragile sites, at which three maps end; only the first site has molecules."""
    forward = {at: "GCTCTTC" for at in [*range(10_000, 160_000, 10_000)]}
    text = list("AT" * 80_000)
    for at, motif in (forward | {50_200: "GAAGAGC", 100_300: "GAAGAGC"}).items():
        text[at : at + 7] = motif
    places = sorted([*forward, 50_200, 100_300])
    chunks = sequence.chunked(spark.createDataFrame([(1, "".join(text))], "seq_id long, bases string"), 10_000)
    blocks = {11: (1, 5), 12: (6, 11), 13: (12, 17)}
    maps, aligned = [], []
    for m, (a, z) in blocks.items():
        own = [places[k - 1] + 1 for k in range(a, z + 1)]
        maps += [(m, len(own), k, p - own[0] + 20, own[-1] - own[0] + 40) for k, p in enumerate(own, 1)]
        aligned.append((1, m, "+", 20.0, own[0], own[-1], 20, own[-1] - own[0] + 20))
    maps = spark.createDataFrame(maps, "map_id long, num_sites long, site_id long, pos long, map_length long")
    aligned = spark.createDataFrame(aligned, "ref_id long, qry_id long, orientation string, confidence double, ref_start long, ref_end long, qry_start long, qry_end long")
    molecules = spark.createDataFrame([(1, f"m{i}", f"m{i}", list(range(2, 10))) for i in range(20)], "ref_id long, mol_id string, entry string, labels array<int>")
    reads = spark.createDataFrame([(1, "r", 48_000, 53_000, 60)], "ref_id long, read_id string, read_start long, read_end long, mapq int")
    return chunks, aligned, maps, molecules, reads


def test_from_sequences(spark):
    chunks, aligned, maps, molecules, reads = _planted(spark)
    done = repair_sequences(chunks, ["GCTCTTC"], ["GAAGAGC"], aligned, maps, molecules, reads, stitch.Limits())
    found = {r.start_pos // 10_000: r for r in done.stitches.collect()}
    assert {k: (r.site_type, r.broken, r.evidence is not None) for k, r in found.items()} == {5: ("TypeI", False, True), 10: ("TypeI", True, False)}
    # The first two maps stay one, the third is cut off again; no label is lost.
    sizes = sorted(r["count"] for r in done.maps.groupBy("map_id").count().collect())
    assert sizes == [6, 11] and done.alignments.count() == 1


def test_from_sequences_query(spark, small):
    done = queries.text_repair(spark, small)
    stitches = done.stitches.toPandas()
    assert len(stitches) and stitches.site_key.is_unique
    assert not stitches[stitches.broken].evidence.notna().any()
    assert stitches.site_type.isin(["TypeI", "TypeII", "TypeV", "Observed"]).all()


def test_scores_on_merged_maps(spark):
    """Molecules that align to two maps, on either side of a site, say nothing of the reference but span the merged map."""
    chunks, aligned, maps, molecules, reads = _planted(spark)
    elsewhere = molecules.withColumn("labels", F.array(*[F.lit(x) for x in (1, 2, 3)]).cast("array<int>"))
    pairs = [(f"m{i}", m, s, k, 8) for i in range(20) for k, (m, s) in enumerate([(11, s) for s in (2, 3, 4, 5)] + [(12, s) for s in (1, 2, 3, 4)], 1)]
    pairs = spark.createDataFrame(pairs, "mol_id string, map_id long, map_site int, mol_site int, mol_sites int")
    plain = repair_sequences(chunks, ["GCTCTTC"], ["GAAGAGC"], aligned, maps, elsewhere, reads.where("1 = 0"), stitch.Limits())
    merged = repair_sequences(chunks, ["GCTCTTC"], ["GAAGAGC"], aligned, maps, elsewhere, reads.where("1 = 0"), stitch.Limits(), pairs)
    by_place = lambda done: {r.start_pos // 10_000: (r.molecules, r.total, r.broken) for r in done.stitches.collect()}
    assert by_place(plain) == {5: (0, 0, True), 10: (0, 0, True)}
    # Labels 2 to 5 and 6 to 9 of the merged map: four on the lesser side.
    assert by_place(merged) == {5: (20, 80, False), 10: (0, 0, True)}
    assert sorted(r["count"] for r in merged.maps.groupBy("map_id").count().collect()) == [6, 11]
    known = {r.map_id: (r.left_label, r.right_label) for r in merged.stitches.where("not broken").collect()}
    assert list(known.values()) == [(5, 6)]
    rounds = {(r.generation, r.map_id) for r in merged.lineage.collect()}
    assert rounds == {(1, 11), (1, 12), (2, 13), (2, 14)} or len(rounds) == 4
    ids = [r.map_id for r in merged.maps.select("map_id").distinct().collect()]
    assert len(ids) == 2 and not set(ids) & {11, 12}


def test_ids_stay_apart_over_rounds(spark):
    """At sf0.01 the rounds' new ids are above all before them, and no id has labels of two maps."""
    sf = "/root/testdata/sf0.01"
    refs = queries._refs(spark, sf)
    _, labels, aligned = queries._planned(spark, sf, refs)
    from nickmap.plans.repair import stitch_rounds

    done = stitch_rounds(aligned, labels, refs, queries.LIMITS, queries._sites(spark, sf), None, rounds=3, width=queries.WIDTH)
    lineage = done.lineage.toPandas()
    assert lineage.generation.max() > 1
    assert lineage.groupby("new_id")[["generation", "ref_id"]].nunique().max().max() == 1
    assert lineage.new_id.min() > labels.agg(F.max("map_id")).first()[0]
    per_map = done.maps.groupBy("map_id").agg(F.countDistinct("num_sites", "map_length").alias("kinds"), F.count(F.lit(1)).alias("n"), F.max("num_sites").alias("num_sites"), F.countDistinct("site_id").alias("sites"))
    assert per_map.where("kinds <> 1 or n <> num_sites or n <> sites").isEmpty()
    assert done.lift.groupBy("new_id", "new_site").count().where("count > 1").isEmpty()
    stitches = done.stitches.toPandas()
    assert len(stitches) and (stitches.right_label > stitches.left_label).all()
