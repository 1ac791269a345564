"""Readers and writers on the hand-made rows, and round trips."""

import random

from pyspark.sql import functions as F

from nickmap.operators import sequence
from nickmap.sources import readers, writers

MAPS = """# CMAP File Version:\t0.1
#h CMapId\tContigLength\tNumSites\tSiteID\tLabelChannel\tPosition\tStdDev\tCoverage\tOccurrence
#f int\tfloat\tint\tint\tint\tfloat\tfloat\tint\tint
1\t1000.0\t2\t1\t1\t20.0\t81.9\t14.0\t14.0\t12.4650\t0.4814\t0
1\t1000.0\t2\t2\t1\t 500.5 \t81.9\t14.0\t14.0\t12.4650\t0.4814\t0
1\t1000.0\t2\t3\t0\t1000.0\t0.0\t1\t0
"""


def test_maps_round_trip(spark, tmp_path):
    (tmp_path / "a.cmap").write_text(MAPS)
    maps = readers.read_maps(spark, str(tmp_path / "a.cmap"))
    got = maps.orderBy("site_id").collect()
    assert [str(r.position) for r in got] == ["20.0", "500.5", "1000.0"] and got[0].rest == ["12.4650", "0.4814", "0"] and got[2].rest == []
    writers.write_maps(maps, str(tmp_path / "out"))
    again = readers.read_maps(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, maps.collect()))
    parts = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert parts.startswith("# CMAP") and parts.count("#") == 3


def test_alignments(spark, tmp_path):
    (tmp_path / "a.xmap").write_text("# x\n1\t11\t1\t20.0\t500.5\t100.0\t580.5\t+\t12.5\t2M\t1000.0\t9000.0\t1\t(1,1)(2,2)\n2\t12\t1\t500.5\t20.0\t700.0\t1180.5\t-\t11.0\t2M\t1000.0\t9000.0\t1\t(4,2)(5,1)\n")
    got = readers.read_alignments(spark, str(tmp_path / "a.xmap")).orderBy("entry_id").collect()
    assert [(r.qry_id, r.orientation, [tuple(p) for p in r.pairs]) for r in got] == [(11, "+", [(1, 1), (2, 2)]), (12, "-", [(4, 2), (5, 1)])]


def test_sites_of_nine_and_ten_columns(spark, tmp_path):
    line = "1\t590\t690\tTypeI\t0\t0\t590\t690\t255,0,0,255"
    (tmp_path / "a.bed").write_text(f"#CMapId\n{line}\tACGTACGT\n")
    (tmp_path / "b.bed").write_text(f"{line}\n\n")
    sites = readers.read_sites(spark, str(tmp_path / "*.bed"))
    assert sorted(str(r.sequence) for r in sites.collect()) == ["ACGTACGT", "None"]
    writers.write_sites(sites, str(tmp_path / "out"))
    assert sorted(map(str, readers.read_sites(spark, str(tmp_path / "out")).collect())) == sorted(map(str, sites.collect()))
    writers.write_site_sequences(sites, str(tmp_path / "fasta"))
    assert "".join(p.read_text() for p in (tmp_path / "fasta").glob("part-*")) == ">1_590_690_TypeI\nACGTACGT\n"


def test_keys_ratios_scores_noise(spark, tmp_path):
    (tmp_path / "key.txt").write_text("# c\nCompntId\tCompntName\tCompntLength\n1\tchr1\t9000\n2\tchr10\t500\n")
    keys = readers.read_keys(spark, str(tmp_path / "key.txt"))
    assert sorted(map(tuple, keys.collect())) == [(1, "chr1", 9000), (2, "chr10", 500)]
    names = spark.createDataFrame([("CHR10",), ("chr1",), ("x",)], "seq_name string")
    assert sorted(map(tuple, readers.named_references(names, keys).collect())) == [("CHR10", 2), ("chr1", 2)]
    (tmp_path / "r.txt").write_text("11\t0.10\t0.85\n")
    assert [tuple(r) for r in readers.read_ratios(spark, str(tmp_path / "r.txt")).collect()] == [(11, 0.1, 0.85)]
    (tmp_path / "s.csv").write_text("#BedLine,Type\n1,TypeI,100,1,1-2,3-4,17,20.5-90.0,1-2,9.1,3,3,2,40,5,5,4.0,40,a;b,c\n")
    r = readers.read_scores(spark, str(tmp_path / "s.csv")).first()
    assert (r.map_id, r.map_start_pos, r.map_end_pos, r.molecules, r.reads, r.score) == (17, 20.5, 90.0, 3, 2, 4.0)
    (tmp_path / "n.err").write_text("Iteration\tFNrate\tSiteSD\n0\t0.1\t0.2\n1\t0.3\t0.4\n")
    noise = readers.read_noise(spark, str(tmp_path / "n.err")).first()
    assert noise["FN(rate)"] == 0.3 and noise["sf"] == 0.4


def test_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tx\nr1\t0\tchr1\t100\t60\t5S10M2D3I20M\t*\t0\t0\tA\tI\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    assert [tuple(r) for r in readers.read_sam(spark, str(tmp_path / "a.sam")).collect()] == [("chr1", 100, 131, "r1", 60)]


def test_sequences_by_lines(spark, tmp_path):
    rng, want = random.Random(2), []
    with open(tmp_path / "a.fa", "w") as file:
        for k in range(5):
            bases = "".join(rng.choices("ACGTacgtn", k=rng.choice([0, 7, 60, 333, 1000])))
            want.append((k + 1, f"s{k} x", len(bases), bases.upper()))
            file.write(f">s{k} x\r\n" + "".join(f"{bases[i:i + 60]}\r\n" for i in range(0, len(bases), 60)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")  # so that sequences are split over blocks
    try:
        names, chunks = readers.read_sequences(spark, str(tmp_path / "a.fa"), 100, 10)
        assert sorted(tuple(r) for r in names.collect()) == [x[:3] for x in want]
        got = {(r.seq_id, r.chunk_start): r.bases for r in chunks.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = spark.createDataFrame([(x[0], x[3]) for x in want if x[3]], "seq_id long, bases string")
    assert got == {(r.seq_id, r.chunk_start): r.bases for r in sequence.chunked(whole, 100, 10).collect()}


def test_chunks_with_names(spark, tmp_path):
    """Chunks know their sequences' names over blocks; a sequence of one line is not gathered, so lines are shuffled once."""
    rng, want = random.Random(5), {}
    with open(tmp_path / "b.fa", "w") as file:
        for k in range(12):
            bases, width = "".join(rng.choices("ACGT", k=rng.choice([0, 7, 90, 700]))), rng.choice([60, 1000])
            want |= {(k + 1, f"n{k}", at): bases[at : at + 110] for at in range(0, len(bases), 100)}
            file.write(f">n{k}\n" + "".join(f"{bases[i:i + width]}\n" for i in range(0, len(bases), width)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        chunks = readers.read_sequences(spark, str(tmp_path / "b.fa"), 100, 10, names=True)[1]
        assert {(r.seq_id, r.name, r.chunk_start): r.bases for r in chunks.collect()} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_write_by_reference(spark, tmp_path):
    df = spark.range(6).select((F.col("id") % 2).alias("ref_id"), "id")
    writers.write_by(df, str(tmp_path / "out"), "ref_id")
    assert sorted(p.name for p in (tmp_path / "out").glob("ref_id=*")) == ["ref_id=0", "ref_id=1"]


def test_keys_and_ratios_written(spark, tmp_path):
    keys = spark.createDataFrame([(2, "b", 5), (1, "a", 9)], "ref_id long, name string, length long")
    writers.write_keys(keys, str(tmp_path / "k"))
    assert sorted(map(tuple, readers.read_keys(spark, str(tmp_path / "k")).collect())) == [(1, "a", 9), (2, "b", 5)]
    writers.write_ratios(spark.createDataFrame([(1, 0.5, 0.25)], "map_id long, start_ratio double, end_ratio double"), str(tmp_path / "r"))
    assert [tuple(r) for r in readers.read_ratios(spark, str(tmp_path / "r")).collect()] == [(1, 0.5, 0.25)]


def test_score_statistics_round_trip(spark, tmp_path):
    """Twenty columns by line, which read_scores reads back."""
    row = (2, "TypeI", 10, 1, 100, 110, 3, 4, 17, 20, 90, 2, 5, 1.5, 5, 3, 2, 40, 8.0, 8.0, 4.0, 40, ["a", "b"], [])
    kinds = "line long, site_type string, size long, ref_id long, start_pos long, end_pos long, start_label int, end_label int, map_id long, map_start_pos long, map_end_pos long, map_start int, map_end int, mean_coverage double, hits long, molecules long, reads long, total long, mean_per_hit double, mean_per_molecule double, score double, alt_score long, molecule_ids array<string>, read_ids array<string>"
    writers.write_score_statistics(spark.createDataFrame([row, (1, *row[1:])], kinds), str(tmp_path / "stats"))
    lines = [line for part in sorted((tmp_path / "stats").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines[0] == writers.SCORE_HEADER and [len(x.split(",")) for x in lines] == [20] * 3 and lines[1].startswith("1,TypeI,10,1,100-110,3-4,17,20-90,2-5,1.5,5,3,2,40,8.0,8.0,4.0,40,a b,")
    back = readers.read_scores(spark, str(tmp_path / "stats")).orderBy("line").collect()
    assert [tuple(r) for r in back] == [(k, "TypeI", 17, 20.0, 90.0, 3, 2, 4.0) for k in (1, 2)]


def test_alignments_round_trip(spark, tmp_path):
    row = (1, 10, 2, 20.0, 90.5, 100.0, 170.5, "-", 12.25, 110.0, 1000.0, [(3, 4), (4, 3), (6, 1)])
    df = spark.createDataFrame([row, (2, *row[1:-1], [])], "entry_id long, qry_id long, ref_id long, qry_start double, qry_end double, ref_start double, ref_end double, orientation string, confidence double, qry_len double, ref_len double, pairs array<struct<ref:int,qry:int>>")
    writers.write_alignments(df, str(tmp_path / "a"))
    lines = [x for p in sorted((tmp_path / "a").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines[:2] == writers.ALIGNMENT_HEADER and all(len(x.split("\t")) == 14 for x in lines[1:])
    back = readers.read_alignments(spark, str(tmp_path / "a")).orderBy("entry_id").collect()
    assert [tuple(p) for p in back[0].pairs] == row[-1] and back[1].pairs is None
    assert (back[0].entry_id, back[0].qry_id, float(back[0].qry_end), back[0].orientation, back[0].confidence, float(back[0].ref_len)) == (1, 10, 90.5, "-", 12.25, 1000.0)


def test_reads_by_region(spark, tmp_path):
    """A fetch gives each read that reaches a region once, and reads only the folders that regions touch."""
    rng = random.Random(8)
    rows = [(f"chr{rng.randint(1, 3)}", (a := rng.randint(0, 5_000)), a + rng.choice([5, 90, 900]), f"r{i}", rng.randint(0, 60)) for i in range(300)]
    path = str(tmp_path / "reads")
    writers.write_reads(spark.createDataFrame(rows, "seq_name string, read_start long, read_end long, read_id string, mapq int"), path, 100)
    wanted = [("a", "chr1", 150, 420), ("b", "chr2", 3_000, 3_000), ("c", "chr9", 1, 9), ("d", "chr1", 400, 410)]
    asked = spark.createDataFrame(wanted, "key string, seq_name string, w0 long, w1 long")
    found = readers.fetch_reads(spark, path, asked, 100)
    assert sorted((r.key, r.read_id) for r in found.collect()) == sorted((k, i) for k, n, w0, w1 in wanted for m, a, b, i, _ in rows if m == n and a <= w1 and b >= w0)
    few = readers.fetch_reads(spark, path, spark.read.schema(asked.schema).json(spark.sparkContext.parallelize(['{"key":"a","seq_name":"chr1","w0":150,"w1":420}'])), 100)
    assert "dynamicpruning" in few._jdf.queryExecution().toString()
    flat = str(tmp_path / "flat")
    spark.createDataFrame(rows, "seq_name string, read_start long, read_end long, read_id string, mapq int").withColumn("more", F.lit(1)).write.parquet(flat)
    assert sorted(map(tuple, readers.read_alignment_table(spark, flat).collect())) == sorted(rows)


def test_tables_by_key_have_few_folders(spark, tmp_path):
    """Folders follow the rows and not the keys, and a fetch of some keys reads their folders alone."""
    path = str(tmp_path / "keyed")
    writers.write_by_key(spark.range(1000).select((F.col("id") % 500).alias("map_id"), "id"), path, "map_id", 100)
    assert 5 <= len(list((tmp_path / "keyed").glob("buckets=10/bucket=*"))) <= 10
    assert sorted(map(tuple, spark.read.parquet(path).select("map_id", "id").collect())) == sorted((i % 500, i) for i in range(1000))
    some = readers.fetch_by_key(spark, path, "map_id", [3, 77])
    assert sorted(map(tuple, some.collect())) == [(3, 3), (3, 503), (77, 77), (77, 577)]
    assert len({f for f in some.inputFiles()}) and some.select(F.input_file_name()).distinct().count() <= 2
    assert readers.fetch_by_key(spark, path, "map_id", []).count() == 0


def test_score_statistics_are_cut_by_what_lines_hold(spark, tmp_path):
    """Lines of many ids fall into parts of their own; all lines stay in order over the parts."""
    base = ("TypeI", 10, 1, 100, 110, 3, 4, 17, 20, 90, 2, 5, 1.5)
    rows = [(n, *base, hits, hits, 0, 0, 8.0, 8.0, 4.0, 40, [f"m{i}" for i in range(hits)], []) for n in range(1, 61) for hits in [50 if n <= 6 else 0]]
    kinds = "line long, site_type string, size long, ref_id long, start_pos long, end_pos long, start_label int, end_label int, map_id long, map_start_pos long, map_end_pos long, map_start int, map_end int, mean_coverage double, hits long, molecules long, reads long, total long, mean_per_hit double, mean_per_molecule double, score double, alt_score long, molecule_ids array<string>, read_ids array<string>"
    writers.write_score_statistics(spark.createDataFrame(rows, kinds).repartition(3), str(tmp_path / "s"), part=100, segment=7)
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "s").glob("part-*"))]
    assert [x.split(",")[0] for part in parts for x in part] == ["#BedLine", *map(str, range(1, 61))]
    assert max(sum(x.startswith(tuple(f"{n}," for n in range(1, 7))) for x in part) for part in parts) <= 2


def test_parts_of_score_statistics_are_not_kept_by_line(spark, tmp_path, monkeypatch):
    """What is kept beside the statistics, and sent to all tasks, has a row for each part and segment and none for each
    line; a line that comes twice is written twice."""
    kept, kinds = {}, "line long, site_type string, size long, ref_id long, start_pos long, end_pos long, start_label int, end_label int, map_id long, map_start_pos long, map_end_pos long, map_start int, map_end int, mean_coverage double, hits long, molecules long, reads long, total long, mean_per_hit double, mean_per_molecule double, score double, alt_score long, molecule_ids array<string>, read_ids array<string>"
    keep = writers.written
    monkeypatch.setattr(writers, "written", lambda df, purpose: kept.setdefault(purpose, keep(df, purpose)))
    row = ("TypeI", 10, 1, 100, 110, 3, 4, 17, 20, 90, 2, 5, 1.5, 0, 0, 0, 0, 8.0, 8.0, 4.0, 40, [], [])
    lines = [*range(1, 2001), 500]
    writers.write_score_statistics(spark.createDataFrame([(n, *row) for n in lines], kinds).repartition(3), str(tmp_path / "s"), part=300, segment=100)
    assert sum(df.count() for purpose, df in kept.items() if purpose != "statistics") <= 2001 // 300 + 1 + 2000 // 100 + 1
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "s").glob("part-*"))]
    assert [x.split(",")[0] for p in parts for x in p] == ["#BedLine", *map(str, sorted(lines))]
    assert [len(p) for p in parts] == [300] * 6 + [202]
