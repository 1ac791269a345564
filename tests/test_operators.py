"""Operators on hand-made rows: each class of site, each orientation of a merge, each filter."""

import math
import random

import pytest
from pyspark.sql import functions as F

from nickmap.functions import scalars
from nickmap.operators import evidence, intervals, mapops, sequence, sites, stitch


def test_site_classes(spark):
    arms = {(1, -1): "TypeI", (-1, 1): "TypeII", (1, 2): "TypeIII", (-2, -1): "TypeIII", (2, 1): "TypeIV", (-1, -2): "TypeIV", (1, 1): "TypeV", (3, 1): "TypeVI", (-1, 3): "TypeVI"}
    data = [(i, p, s) for i, pair in enumerate(arms) for p, s in zip((0, 100), pair)]
    got = {r.ref_id: r.site_type for r in sites.classify_sites(spark.createDataFrame(data, "ref_id int, pos long, strand int"), aggressive=True).collect()}
    assert got == dict(enumerate(arms.values()))
    far = spark.createDataFrame([(1, 0, 1), (1, 1001, -1), (2, 0, 1), (2, 101, 1)], "ref_id int, pos long, strand int")
    assert sites.classify_sites(far, aggressive=True).count() == 0
    assert sites.classify_sites(far, aggressive=True, compat=True).where("site_type is null").count() == 2


def test_motifs_of_the_fixture(spark):
    seq = sequence.chunked(spark.createDataFrame([(1, "AAGCTCTTCAAAAGAAGAGCTT")], "seq_id long, bases string"), size=8, overlap=8)
    nicks = sequence.nick_sites(seq, ["GCTCTTC"], ["GAAGAGC"])
    assert sorted(map(tuple, nicks.select("pos", "strand").collect())) == [(2, 1), (20, -1)]
    found = sites.classify_sites(nicks.withColumnRenamed("seq_id", "ref_id"))
    assert [tuple(r) for r in found.collect()] == [(1, 2, 20, "TypeI")]
    labels = sequence.digest(seq, [["GCTCTTC", "GAAGAGC"]])
    assert sorted(map(tuple, labels.select("site_id", "position", "num_sites").collect())) == [(1, 3, 2), (2, 14, 2)]


def test_overlapping_occurrences_and_ends(spark):
    df = spark.createDataFrame([(1, "ATATATA"), (2, ""), (3, None), (4, "TAT"), (5, "tat")], "seq_id long, bases string")
    got = {r.seq_id: r.at for r in df.select("seq_id", sequence.occurrences(F.col("bases"), "ATA").alias("at")).collect()}
    assert got[1] == [0, 2, 4] and got[2] == [] and got[4] == []
    # A motif that touches the end counts for a digest, not for nicks.
    chunks = sequence.chunked(df.where("seq_id = 1"), 3, 3)
    assert sorted(r.pos for r in sequence.nick_sites(chunks, ["ATA"], ["###"]).collect()) == [0, 2]
    assert sorted(r.position for r in sequence.digest(chunks, [["ATA"]]).collect()) == [1, 3, 5]


def test_scalars(spark):
    one = spark.createDataFrame([("ACGTNRYacgt", "(1,10)(2,11)(2,12)")], "s string, a string")
    r = one.select(scalars.reverse_complement(F.col("s")).alias("rc"), scalars.alignment_pairs(F.col("a")).alias("p")).first()
    assert r.rc == "acgtRYNACGT" and [(x.ref, x.qry) for x in r.p] == [(1, 10), (2, 11), (2, 12)]
    assert one.select(scalars.query_label_of(scalars.alignment_pairs(F.col("a")), F.lit(2)).alias("q")).first().q == 12
    assert scalars.motif_of("bspqi") == "GCTCTTC" and scalars.motif_of("acgt") == "ACGT"
    with pytest.raises(ValueError):
        scalars.motif_of("xyz")
    assert scalars.random_motif(7, 1) == scalars.random_motif(7, 1) and len(scalars.random_motif()) == 7
    nums = spark.createDataFrame([(100, 150), (150, 100)], "e long, s long")
    got = [tuple(r) for r in nums.select(*[c for c in scalars.stitch_interval(F.col("e"), F.col("s"))]).collect()]
    assert got == [(99, 151), (99, 151)]


def _scan(pairs):
    taken, out = set(), []
    for no, a, b in pairs:
        if a not in taken and b not in taken:
            taken |= {a, b}
            out.append(no)
    return out


def test_disjoint_pairs_is_the_scan(spark):
    rng, data, want = random.Random(3), [], {}
    for ref in range(60):
        n, again = rng.randint(2, 12), ref % 3 == 0
        maps = [rng.randint(1, 6) if again else 100 * ref + k for k in range(n)]
        pairs = [(k + 1, maps[k], maps[k + 1]) for k in range(n - 1) if rng.random() < 0.7]
        data += [(ref, *p) for p in pairs]
        want[ref] = _scan(pairs)
    got: dict = {r: [] for r in want}
    for r in stitch.disjoint_pairs(spark.createDataFrame(data, "ref_id int, pair_no int, first_id long, second_id long")).collect():
        got[r.ref_id].append(r.pair_no)
    assert {k: sorted(v) for k, v in got.items()} == want


def _merged_plainly(a, b, pad, ld, oa, ob, conf_a, conf_b, offset):
    """Two maps (length, positions) joined, by the rule for each orientation."""
    turn = lambda m, o: (m[0], list(m[1])) if o == "+" else (m[0], [m[0] - p for p in reversed(m[1])])
    (la, pa), (lb, pb) = turn(a, oa), turn(b, ob)
    if ld <= -2 and pad < 0:
        pa, pb = (pa[: len(pa) + ld], pb) if conf_a >= conf_b else (pa, pb[-ld:])
    missed = [max(turn(a, oa)[1]) + offset + 1] if ld == 1 else []
    return la + lb + pad, pa + missed + [la + pad + p for p in pb]


def test_merging_in_all_orientations(spark):
    rng, labels, plan, want = random.Random(5), [], [], {}
    for k in range(80):
        maps = []
        for m in (2 * k + 1, 2 * k + 2):
            n = rng.randint(4, 8)
            pos = sorted(rng.sample(range(20, 980), n))
            maps.append((1000, pos))
            labels += [(m, n, i + 1, p, 1000) for i, p in enumerate(pos)]
        ld = rng.choice([-3, -2, -1, 0, 1])
        end1, start2 = (5000, 5000 + rng.randint(1, 50)) if ld >= 0 else (5000, 5000 - rng.randint(2, 50))
        oa, ob, ca, cb, miss = rng.choice("+-"), rng.choice("+-"), rng.randint(1, 3), rng.randint(1, 3), end1 + 7
        plan.append((k, 1, 2 * k + 1, 2 * k + 2, oa, ob, float(ca), float(cb), end1, start2, ld, miss if ld == 1 else 0))
        want[160 + k + 1] = _merged_plainly(*maps, start2 - end1 + 1, ld, oa, ob, ca, cb, 8)
    pairs = spark.createDataFrame(plan, "ref_id int, pair_no int, first_id long, second_id long, first_orientation string, second_orientation string, first_confidence double, second_confidence double, first_ref_end long, second_ref_start long, label_distance int, missed_label long")
    table = spark.createDataFrame(labels, "map_id long, num_sites int, site_id int, pos long, map_length long")
    got: dict = {}
    for r in mapops.merge_maps(mapops.lineage(mapops.pairwise_groups(pairs), table), table).orderBy("map_id", "site_id").collect():
        got.setdefault(r.map_id, (r.map_length, []))[1].append(r.pos)
    assert got == want


def test_chains_are_cut_into_groups(spark):
    n = 130
    pairs = spark.createDataFrame([(1, k, k, k + 1, "+", "+", 1.0, 1.0, 10 * k, 10 * k + 5, 0, 0) for k in range(1, n)], "ref_id int, pair_no int, first_id long, second_id long, first_orientation string, second_orientation string, first_confidence double, second_confidence double, first_ref_end long, second_ref_start long, label_distance int, missed_label long")
    table = spark.createDataFrame([(k, 1, 1, 5, 10) for k in range(1, n + 1)], "map_id long, num_sites int, site_id int, pos long, map_length long")
    members = mapops.lineage(mapops.chained_groups(pairs), table)
    found = mapops.merge_maps(members, table).groupBy("map_id").count().collect()
    assert {r["map_id"]: r["count"] for r in found} == {131: 64, 132: 64, 133: 2}
    assert {(r.new_id, r.name) for r in members.select("new_id", "name").distinct().collect()} == {(131, 600_001), (132, 600_065), (133, 100_129)}


_PAIR = "ref_id int, pair_no int, first_id long, second_id long, first_orientation string, second_orientation string, first_confidence double, second_confidence double, first_ref_end long, second_ref_start long, label_distance int, missed_label long"


def test_a_map_on_two_references(spark):
    """Map 10 is joined to 11 on one reference and to 12 on another: two maps, with ids of their own."""
    pairs = spark.createDataFrame([(1, 1, 10, 11, "+", "+", 1.0, 1.0, 100, 105, 0, 0), (2, 1, 10, 12, "+", "-", 1.0, 1.0, 100, 109, 0, 0)], _PAIR)
    table = spark.createDataFrame([(m, 2, i, 10 * i, 40) for m in (10, 11, 12) for i in (1, 2)], "map_id long, num_sites int, site_id int, pos long, map_length long")
    for junctions in (mapops.pairwise_groups(pairs), mapops.chained_groups(pairs)):
        got: dict = {}
        members = mapops.lineage(junctions, table)
        for r in mapops.merge_maps(members, table).orderBy("map_id", "site_id").collect():
            got.setdefault(r.map_id, []).append((r.site_id, r.pos, r.old_id))
        assert got == {13: [(1, 10, 10), (2, 20, 10), (3, 56, 11), (4, 66, 11)], 14: [(1, 10, 10), (2, 20, 10), (3, 70, 12), (4, 80, 12)]}
    ratios = spark.createDataFrame([(10, 0.1, 0.2), (11, 0.3, 0.4), (12, 0.5, 0.6)], "map_id long, start_ratio double, end_ratio double")
    assert sorted(map(tuple, mapops.merged_ratios(members, ratios).collect())) == [(13, 0.1, 0.4), (14, 0.1, 0.5)]
    aligned = spark.createDataFrame([(10, 1, "+", 1.0, 10, 100, 10, 20), (11, 1, "+", 1.0, 105, 120, 10, 20), (10, 2, "+", 1.0, 10, 100, 10, 20), (12, 2, "-", 1.0, 109, 120, 20, 10)], "qry_id long, ref_id int, orientation string, confidence double, ref_start long, ref_end long, qry_start long, qry_end long")
    lifted = {r.qry_id: (r.ref_id, r.confidence) for r in mapops.lift_alignments(aligned, members).collect()}
    assert lifted == {13: (1, 2.0), 14: (2, 2.0)}


def test_a_map_that_recurs_in_a_chain(spark):
    """Maps 1-2-3-1-4: the pairs that need map 1 again are left out."""
    ids = [1, 2, 3, 1, 4]
    pairs = spark.createDataFrame([(1, k + 1, ids[k], ids[k + 1], "+", "+", 1.0, 1.0, 10 * k, 10 * k + 5, 0, 0) for k in range(4)], _PAIR)
    table = spark.createDataFrame([(k, 1, 1, 5, 10) for k in range(1, 5)], "map_id long, num_sites int, site_id int, pos long, map_length long")
    got = mapops.merge_maps(mapops.lineage(mapops.chained_groups(pairs), table), table).collect()
    assert sorted((r.map_id, r.old_id) for r in got) == [(5, 1), (5, 2), (5, 3)]


def test_stretches_over_chunk_ends(spark):
    """Stretches of any length, cut from chunks far smaller than they are, with the library's overlap."""
    rng = random.Random(6)
    text = "".join(rng.choices("ACGT", k=3000))
    chunks = sequence.chunked(spark.createDataFrame([(1, text)], "seq_id long, bases string"), 100)
    data = [(1, a, a + rng.randint(1, 1200)) for a in rng.sample(range(1, 2900), 60)]
    data = [(r, a, min(b, 3000)) for r, a, b in data] + [(1, 5, 9), (1, 5, 9)]
    got = sites.site_sequences(spark.createDataFrame(data, "ref_id long, start_pos long, end_pos long"), chunks, 50, 100).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.sequence == text[r.flank_start - 1 : r.flank_end] and r.flank_start == max(1, r.start_pos - 50)


def test_stretches_within_chunks(spark):
    """With the chunks' overlap known, stretches that one chunk holds are cut from it, others are still put together."""
    rng = random.Random(7)
    text = "".join(rng.choices("ACGT", k=1000))
    chunks = sequence.chunked(spark.createDataFrame([(1, text)], "seq_id long, bases string"), 100, 130)
    data = [(1, a, min(a + n, 1000)) for a in range(1, 990, 7) for n in (3, 60, 79, 80, 400)] + [(1, 20, None), (1, 999, 1000)]
    got = sites.site_sequences(spark.createDataFrame(data, "ref_id long, start_pos long, end_pos long"), chunks, 50, 100, overlap=130).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.sequence == ("" if r.flank_end is None else text[r.flank_start - 1 : r.flank_end])


def test_digest_searches_once(spark):
    """What follows a digest doesn't search the bases again."""
    chunks = sequence.chunked(spark.createDataFrame([(1, "xxreixxarexx"), (2, "")], "seq_id long, bases string"), 100)
    rows = sequence.with_terminal_rows(sequence.digest(chunks, [["rei"], ["are"]]), chunks.select(F.col("seq_id").alias("cmap_id"), F.col("length").alias("contig_length")))
    assert "split(" not in rows._jdf.queryExecution().toString()
    assert sorted((r.cmap_id, r.num_sites, r.site_id, r.channel, r.position) for r in rows.collect()) == [(1, 2, 1, 1, 3), (1, 2, 2, 2, 8), (1, 2, 3, 0, 12), (2, 0, 1, 0, 0)]


def test_null_model_takes_words(spark):
    """Short runs are counted by words of several places, so a text has a quarter of its places in rows, long runs by place."""
    text = "ACGTTGCAAC" * 30 + "N" + "CCGTA" * 9
    chunks = sequence.chunked(spark.createDataFrame([(1, text), (2, "ACGTAC"), (3, "AC")], "seq_id long, bases string"), 70, 16)
    motifs = ["ACGTAC", "TGC", "GTTGCAAC", "CGTACCGTACC", "TTTTTT", "AAAAAAAAA"]
    model = sequence.motif_null_model(chunks, spark.createDataFrame(list(enumerate(motifs)), "motif_id long, motif string"))
    got = {r.motif: r.observed for r in model.collect()}
    for m in motifs:
        both = {m, m.translate(str.maketrans("ACGT", "TGCA"))[::-1]}
        assert got[m] == sum(t[i : i + len(m)] in both for t in (text, "ACGTAC", "AC") for i in range(len(t))), m
    assert "AS word" in model._jdf.queryExecution().toString()


def test_interval_joins(spark):
    rng = random.Random(1)
    make = lambda n, most: [(rng.randint(0, 2), i, (s := rng.randint(-50, 500)), s + rng.randint(0, most)) for i in range(n)]
    a, b = make(80, 90), make(80, 40)
    left, right = spark.createDataFrame(a, "g int, i int, a0 long, a1 long"), spark.createDataFrame(b, "g int, j int, b0 long, b1 long")
    pairs = sorted((r.i, r.j) for r in intervals.overlap_join(left, right, ["g"], ("a0", "a1"), ("b0", "b1"), 30).collect())
    assert pairs == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3])
    inside = sorted((r.i, r.j) for r in intervals.containment_join(left, right, ["g"], ("a0", "a1"), ("b0", "b1"), 30).collect())
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[2] and x[3] > y[3])
    assert inside == want
    anti = {r.j for r in intervals.containment_join(left, right, ["g"], ("a0", "a1"), ("b0", "b1"), 30, "left_anti").collect()}
    assert anti == {y[1] for y in b} - {j for _, j in want}


def test_breaking(spark):
    table = spark.createDataFrame([(1, 5, i + 1, p, 100) for i, p in enumerate((10, 20, 50, 60, 90))] + [(2, 1, 1, 5, 10)], "map_id long, num_sites int, site_id int, pos long, map_length long")
    cuts = spark.createDataFrame([(1, 50), (1, 50), (1, 80)], "map_id long, breakpoint long")
    got = sorted(map(tuple, mapops.break_maps(table, cuts, 10).collect()))
    # The label at a break stays with the piece before it; a last piece of one label is dropped, as is map 2.
    assert got == [(1, 3, 1, 10, 50, 1, 0), (1, 3, 2, 20, 50, 1, 0), (1, 3, 3, 50, 50, 1, 0)]
    assert mapops.break_maps(table, cuts, 10, min_labels=1).count() == 6
    # A further piece's id is none that another map has.
    pieces = mapops.break_maps(table, cuts.where("breakpoint = 50"), 10).select("map_id", "of_map", "piece").distinct().collect()
    assert sorted(map(tuple, pieces)) == [(1, 1, 0), (3, 1, 1)]


def test_breakpoints_of_known_labels(spark):
    df = spark.createDataFrame([(1, 10, 20), (2, 10, 10), (3, 0, 20), (4, 10, 0), (0, 5, 6)], "map_id long, map_start_pos long, map_end_pos long")
    got = sorted(map(tuple, evidence.breakpoints(df).collect()))
    assert got == [(1, 10), (1, 20), (2, 10), (3, 20), (4, 10)]


def test_empty_tables(spark):
    nicks = spark.createDataFrame([], "ref_id long, pos long, strand int")
    found = sites.classify_sites(nicks, aggressive=True)
    assert found.count() == 0
    assert sites.site_statistics(found.withColumn("score", F.lit(1.0))).count() == 0
    assert mapops.map_summary(spark.createDataFrame([], "map_id long, pos long, map_length long")).first().maps == 0


def test_names_that_collide(spark):
    """Groups whose names by offsets would be equal, and equal another map's, stay apart under ids of their own."""
    pairs = spark.createDataFrame([(1, 1, 5, 6, "+", "+", 1.0, 1.0, 10, 15, 0, 0), (1, 2, 6, 7, "+", "+", 1.0, 1.0, 20, 25, 0, 0), (2, 1, 100_005, 100_006, "+", "+", 1.0, 1.0, 10, 15, 0, 0)], _PAIR)
    ids = [5, 6, 7, 100_005, 100_006, 200_005]
    table = spark.createDataFrame([(m, 1, 1, 5, 10) for m in ids], "map_id long, num_sites int, site_id int, pos long, map_length long")
    members = mapops.lineage(mapops.chained_groups(pairs), table)
    assert {(r.name, r.new_id) for r in members.collect()} == {(200_005, 200_006), (200_005, 200_007)}
    merged = mapops.merge_maps(members, table)
    assert sorted((r.map_id, r.old_id) for r in merged.collect()) == [(200_006, 5), (200_006, 6), (200_006, 7), (200_007, 100_005), (200_007, 100_006)]
    assert mapops.apply_merges(members, table).groupBy("map_id").count().count() == 3


def test_lifts_chain(spark):
    """Labels lifted over two rounds one after the other, and by the chained lift; a turned map's labels run backwards."""
    table = spark.createDataFrame([(m, 3, i, 10 * i, 40) for m in (1, 2, 3, 4) for i in (1, 2, 3)], "map_id long, num_sites int, site_id int, pos long, map_length long")
    one = spark.createDataFrame([(1, 1, 1, 2, "+", "-", 1.0, 1.0, 100, 105, 0, 0)], _PAIR)
    first = mapops.lineage(mapops.pairwise_groups(one), table)
    merged = mapops.merge_maps(first, table)
    maps = mapops.apply_merges(first, table, merged)
    lift = mapops.label_lift(merged, table)
    two = spark.createDataFrame([(1, 1, 5, 3, "+", "+", 2.0, 1.0, 200, 198, -3, 0)], _PAIR)
    second = mapops.lineage(mapops.pairwise_groups(two), maps)
    again = mapops.merge_maps(second, maps)
    chained = mapops.chain_lifts(lift, mapops.label_lift(again, maps))
    pairs = spark.createDataFrame([("m", m, i) for m in (1, 2, 3, 4) for i in (1, 2, 3)], "mol_id string, map_id long, map_site int")
    got = sorted((r.old_id, r.old_site, r.new_id, r.new_site) for r in chained.collect())
    # The second map's labels are the ones that the second round trims.
    assert got == [(1, 1, 6, 1), (1, 2, 6, 2), (1, 3, 6, 3), (3, 1, 6, 4), (3, 2, 6, 5), (3, 3, 6, 6), (4, 1, 4, 1), (4, 2, 4, 2), (4, 3, 4, 3)]
    steps = mapops.lift_pairs(mapops.lift_pairs(pairs, lift), mapops.label_lift(again, maps))
    assert sorted(map(tuple, steps.collect())) == sorted(map(tuple, mapops.lift_pairs(pairs, chained).collect()))
    assert sorted((r.old_id, r.old_site, r.new_site) for r in lift.where("new_id = 5").collect()) == [(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 6), (2, 2, 5), (2, 3, 4)]
    joined = {r.map_id: r.labels for r in mapops.joined_molecules(pairs, lift).collect()}
    assert joined == {5: [1, 2, 3, 4, 5, 6], 3: [1, 2, 3], 4: [1, 2, 3]}


def test_intervals_of_any_length(spark):
    """Lengths from nothing to a thousand bins: copies stay few, pairs are those of all rows compared."""
    rng = random.Random(2)
    make = lambda n: [(rng.randint(0, 1), i, (s := rng.randint(-5_000, 60_000)), s + int(10 ** rng.uniform(-1, 4.7))) for i in range(n)]
    a, b = make(120), make(150)
    left, right = spark.createDataFrame(a, "g int, i int, a0 long, a1 long"), spark.createDataFrame(b, "g int, j int, b0 long, b1 long")
    pairs = sorted((r.i, r.j) for r in intervals.overlap_join(left, right, ["g"], ("a0", "a1"), ("b0", "b1"), 50).collect())
    assert pairs == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3])
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[2] and x[3] > y[3])
    for how, expected in (("inner", want), ("left_semi", sorted({j for _, j in want})), ("left_anti", sorted({y[1] for y in b} - {j for _, j in want}))):
        found = intervals.containment_join(left, right, ["g"], ("a0", "a1"), ("b0", "b1"), 50, how).collect()
        assert sorted((r.i, r.j) if how == "inner" else r.j for r in found) == expected
    assert sorted(r.j for r in intervals.contained(left, right, ["g"], ("a0", "a1"), ("b0", "b1"), 50, "j").collect()) == sorted({j for _, j in want})


def test_scans_by_segments(spark):
    """Whatever the segments' width, scans give what one window over each reference gives; most segments are empty."""
    from pyspark.sql import Window

    from nickmap.operators import ranges

    rng = random.Random(3)
    rows = spark.createDataFrame([(r, p, k, rng.randint(-9, 9)) for r in (1, 2, 3) for k, p in enumerate(sorted(rng.choices(range(-200, 3_000), k=80)))], "ref long, pos long, site_id long, v long")
    along = Window.partitionBy("ref").orderBy("pos", "site_id")
    upto, before = along.rowsBetween(Window.unboundedPreceding, 0), along.rowsBetween(Window.unboundedPreceding, -1)
    order = ["pos", "site_id"]
    plain = lambda df: sorted(map(str, df.collect()))
    for width in (1, 7, 100, 10_000):
        assert plain(ranges.with_next(rows, "ref", order, {"p2": "pos", "v2": "v"}, width)) == plain(rows.select("*", F.lead("pos").over(along).alias("p2"), F.lead("v").over(along).alias("v2")))
        assert plain(ranges.with_place(rows, "ref", order, width, "at", "n")) == plain(rows.select("*", F.row_number().over(along).cast("long").alias("at"), F.count(F.lit(1)).over(Window.partitionBy("ref")).alias("n")))
        for kind, f in (("sum", F.sum), ("max", F.max), ("min", F.min)):
            assert plain(ranges.with_running(rows, "ref", order, "v", width, "x", kind)) == plain(rows.withColumn("x", f("v").over(upto)))
            assert plain(ranges.with_running(rows, "ref", order, "v", width, "x", kind, own=False)) == plain(rows.withColumn("x", f("v").over(before)))
        probes = spark.createDataFrame([(r, p, i) for r in (1, 2, 4) for i, p in enumerate(range(-250, 3_100, 37))], "ref long, at long, key int")
        labels = {r: [(x.pos, x.site_id) for x in rows.where(F.col("ref") == r).collect()] for r in (1, 2, 3)}
        for r in ranges.around(probes, rows, "ref", "at", width, "b", "a").collect():
            own = labels.get(r.ref, [])
            assert r.b == max((s for p, s in own if p <= r.at), default=None) and r.a == min((s for p, s in own if p >= r.at), default=None)
    got = [tuple(x) for x in ranges.numbered(rows.select("v", "ref", "site_id"), "v", "ref", "site_id").orderBy("number").collect()]
    assert [g[3] for g in got] == list(range(1, len(got) + 1)) and [g[:3] for g in got] == sorted(g[:3] for g in got)


def test_weighted_median(spark):
    rng = random.Random(4)
    for values in ([5], [1, 1, 1], [rng.randint(1, 10**9) for _ in range(400)], [3, 10**12, 4], list(range(1, 3000))):
        running, want = 0, None
        for v in sorted(values, reverse=True):
            running += v
            if want is None and 2 * running >= sum(values):
                want = v
        assert mapops.weighted_median(spark.createDataFrame([(v,) for v in values], "v long"), "v", 16).first().v == want
    assert mapops.weighted_median(spark.createDataFrame([], "v long"), "v").first().v is None


def test_pairs_by_entry(spark):
    """Alignments that start at one place follow one another by their entries."""
    rows = spark.createDataFrame([(1, q, "+", 1.0, s, s + 9, 1, 9, e) for q, s, e in ((7, 10, 1), (3, 10, 2), (5, 10, 0), (9, 4, 9))], "ref_id long, qry_id long, orientation string, confidence double, ref_start long, ref_end long, qry_start long, qry_end long, entry long")
    follow = lambda df: [(r.pair_no, r.first_id, r.second_id) for r in stitch.adjacent_pairs(df, 5).orderBy("pair_no").collect()]
    assert follow(rows) == [(1, 9, 5), (2, 5, 7), (3, 7, 3)]
    assert follow(rows.drop("entry")) == [(1, 9, 3), (2, 3, 5), (3, 5, 7)]


def test_null_model(spark):
    """Observed sites of both strands by a plain search, expected ones by the letters' frequencies."""
    rng = random.Random(12)
    texts = {1: "".join(rng.choices("ACGT", [4, 3, 2, 1], k=900)), 2: "ACG", 3: "", 4: "NNNN" + "ACGTTGCA" * 20}
    chunks = sequence.chunked(spark.createDataFrame(list(texts.items()), "seq_id long, bases string"), 100, 16)
    motifs = ["ACGT", "AAC", "GTT", "TGCA", "CCCCC", "A"]
    got = {r.motif: r for r in sequence.motif_null_model(chunks, spark.createDataFrame(list(enumerate(motifs)), "motif_id long, motif string")).collect()}
    whole = "".join(texts.values())
    share = {x: whole.count(x) / sum(whole.count(y) for y in "ACGT") for x in "ACGT"}
    for m in motifs:
        both = {m, m.translate(str.maketrans("ACGT", "TGCA"))[::-1]}
        chance = sum(math.prod(share[x] for x in b) for b in both)
        assert got[m].observed == sum(t[i : i + len(m)] in both for t in texts.values() for i in range(len(t))), m
        assert abs(got[m].expected - chance * sum(max(0, len(t) - len(m) + 1) for t in texts.values())) < 0.01
    seeded = [r.motif for r in sequence.seeded_motifs(spark, 50, 7, 1).collect()]
    assert len(set(seeded)) > 45 and {len(m) for m in seeded} == {7} and set("".join(seeded)) == set("ACGT")
    assert seeded == [r.motif for r in sequence.seeded_motifs(spark, 50, 7, 1).orderBy("motif_id").collect()]


def test_disjoint_pairs_are_those_of_a_scan(spark):
    """Runs with gaps, references where maps recur within a run, in another one, or not at all, and segments of any size."""
    rng, rows = random.Random(13), []
    for ref in range(12):
        fresh, at = iter(range(1000)), 0
        before = next(fresh)
        for _ in range(rng.randint(1, 40)):
            at += 1
            after = rng.randint(0, 20) if ref % 3 and rng.random() < 0.2 * (ref % 3) else next(fresh)
            if rng.random() < 0.8 and after != before:
                rows.append((ref, at, before, after))
            before = after
    pairs = spark.createDataFrame(rows, "ref_id int, pair_no int, first_id long, second_id long")
    want, taken = [], {}
    for ref, at, a, b in sorted(rows):
        own = taken.setdefault(ref, set())
        if a not in own and b not in own:
            own |= {a, b}
            want.append((ref, at, a, b))
    for segment in (1, 7, 100_000):
        assert sorted(map(tuple, stitch.disjoint_pairs(pairs, segment).collect())) == want
    once = pairs.where("ref_id % 3 = 0")
    assert sorted(map(tuple, stitch.disjoint_pairs(once).collect())) == [w for w in want if w[0] % 3 == 0]
    assert stitch.disjoint_pairs(pairs.where("ref_id < 0")).count() == 0


def test_alike_molecules_come_once(spark):
    """Rows that stand for several molecules give what the molecules one by one give."""
    rng = random.Random(12)
    kinds = "map_id long, map_site int, mol_site int, mol_sites int, molecules long"
    rows = [(rng.randint(1, 2), rng.randint(1, 4), (k := rng.randint(1, 3)), rng.randint(k, 3), rng.randint(1, 9)) for _ in range(40)]
    table = spark.createDataFrame([(m, i, 4) for m in (1, 2, 3) for i in range(1, 5)], "map_id long, site_id int, num_sites int")
    alike = spark.createDataFrame(rows, kinds)
    each = alike.withColumn("x", F.explode(F.sequence(F.lit(1).cast("long"), "molecules"))).drop("molecules", "x")
    got = sorted(map(tuple, evidence.molecule_end_ratios(alike, table, 5).collect()))
    assert got == sorted(map(tuple, evidence.molecule_end_ratios(each, table, 5).collect())) and got[2] == (3, 0.0, 0.0)
    for m, start, end in got[:2]:
        for site, ratio in ((1, start), (4, end)):
            held = [r for r in rows if r[:2] == (m, site)]
            assert ratio == pytest.approx(sum(r[4] for r in held if r[2] in (1, r[3])) / sum(r[4] for r in held))
    keys, reads = spark.createDataFrame([("a",), ("b",)], "site_key string"), spark.createDataFrame([("a", 2)], "site_key string, reads long")
    support = spark.createDataFrame([("a", 3, 2), ("a", 10, 1)], "site_key string, confidence int, molecules long")
    ones = spark.createDataFrame([("a", 3), ("a", 3), ("a", 10)], "site_key string, confidence int")
    assert sorted(map(tuple, evidence.site_scores(keys, support, reads).collect())) == sorted(map(tuple, evidence.site_scores(keys, ones, reads).collect()))
