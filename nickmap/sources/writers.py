"""Writers of the text formats. Each writes a folder of part files; those with an order are sorted over all parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nickmap.functions.scalars import site_colour
from nickmap.operators.ranges import in_segments, with_running
from nickmap.sources.shared import written

# The headers of the formats.
MAP_HEADER = ["# CMAP File Version:\t0.1", "#h CMapId\tContigLength\tNumSites\tSiteID\tLabelChannel\tPosition\tStdDev\tCoverage\tOccurrence", "#f int\tfloat\tint\tint\tint\tfloat\tfloat\tint\tint"]
ALIGNMENT_HEADER = ["# XMAP File Version:\t0.2", "#h XmapEntryID\tQryContigID\tRefContigID\tQryStartPos\tQryEndPos\tRefStartPos\tRefEndPos\tOrientation\tConfidence\tHitEnum\tQryLen\tRefLen\tLabelChannel\tAlignment"]
KEY_HEADER = "CompntId\tCompntName\tCompntLength"
SCORE_HEADER = "#BedLine,Type,FsiteSize,RefId,RefStart-End,RefLabelStart-End,MapId,MapStart-End,MapLabelStart-End,AvgMapCov,TotalHits,UniqueMolecules,TotalNGSHits,TotalConf,AvgConfPerHit,AvgConfPerMol,Score,AltScore,MoleculeMatches,NGSMatches"


def _one(places: int, column: str) -> Column:
    return F.col(column).cast(f"decimal(18,{places})").cast("string")


def _lines(df: DataFrame, *columns: Column, separator: str = "\t") -> DataFrame:
    return df.select(F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]).alias("value"))


def _with_header(rows: DataFrame, header: list[str], order: list[str], *columns: Column) -> DataFrame:
    """Lines in ``order``, the header before them."""
    spark = rows.sparkSession
    body = rows.select(F.lit(1).alias("_part"), *order, _lines_column(*columns))
    head = spark.createDataFrame([(0, i, x) for i, x in enumerate(header)], "_part int, _i int, value string")
    blank = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order]
    both = body.withColumn("_i", F.lit(0)).unionByName(head.select("_part", *blank, "value", "_i"))
    return both.orderBy("_part", "_i", *order).select("value")


def _lines_column(*columns: Column) -> Column:
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]).alias("value")


def write_maps(maps: DataFrame, path: str) -> None:
    """Label maps with their end rows, by map and label, one decimal for positions; ``rest``, if there, at the end."""
    columns = [F.col("cmap_id"), _one(1, "contig_length"), F.col("num_sites"), F.col("site_id"), F.col("channel"), _one(1, "position"), _one(1, "stddev"), _one(1, "coverage"), _one(1, "occurrence")]
    if "rest" in maps.columns:
        columns.append(F.when(F.size("rest") > 0, F.array_join("rest", "\t")))
    line = F.concat_ws("\t", *[c.cast("string") for c in columns]).alias("value")
    spark = maps.sparkSession
    head = spark.createDataFrame([(-1, i, x) for i, x in enumerate(MAP_HEADER)], "cmap_id long, site_id int, value string")
    body = maps.select(F.col("cmap_id").cast("long").alias("cmap_id"), F.col("site_id").cast("int").alias("site_id"), line)
    head.unionByName(body).orderBy("cmap_id", "site_id").select("value").write.mode("overwrite").text(path)


def write_sites(sites: DataFrame, path: str) -> None:
    """Sites by reference, start and end, in nine columns, ten if there is a sequence. Score, strand, thick positions and
    colour have defaults."""
    have = lambda c, default: F.col(c) if c in sites.columns else default
    columns = [F.col("ref_id"), F.col("start_pos"), F.col("end_pos"), F.col("site_type"), have("score", F.lit("0")), have("strand", F.lit("0")), have("thick_start", F.col("start_pos")), have("thick_end", F.col("end_pos")), have("item_rgba", site_colour(F.col("site_type")))]
    columns += [F.col("sequence")] if "sequence" in sites.columns else []
    header = "#CMapId\tStart\tEnd\tType\tScore\tStrand\tThickStart\tThickEnd\tItemRgba" + "\tSequence" * ("sequence" in sites.columns)
    _with_header(sites, [header], ["ref_id", "start_pos", "end_pos"], *columns).write.mode("overwrite").text(path)


def write_keys(keys: DataFrame, path: str) -> None:
    _with_header(keys, [KEY_HEADER], ["ref_id"], F.col("ref_id"), F.col("name"), F.col("length")).write.mode("overwrite").text(path)


def write_ratios(ratios: DataFrame, path: str) -> None:
    _lines(ratios, F.col("map_id"), F.col("start_ratio"), F.col("end_ratio")).write.mode("overwrite").text(path)


def write_alignments(alignments: DataFrame, path: str) -> None:
    """Alignments by entry, in fourteen columns, from entry_id, qry_id, ref_id, places, orientation, confidence, qry_len,
    ref_len and pairs: array of aligned (ref, qry) labels."""
    text = F.concat(F.lit(""), F.array_join(F.transform("pairs", lambda p: F.format_string("(%d,%d)", p["ref"], p["qry"])), ""))
    columns = [F.col("entry_id"), F.col("qry_id"), F.col("ref_id"), *[_one(1, c) for c in ("qry_start", "qry_end", "ref_start", "ref_end")], F.col("orientation"), F.col("confidence"), F.lit(""), _one(1, "qry_len"), _one(1, "ref_len"), F.lit(1), text]
    _with_header(alignments, ALIGNMENT_HEADER, ["entry_id"], *columns).write.mode("overwrite").text(path)


def write_reads(reads: DataFrame, path: str, width: int = 1 << 20) -> None:
    """Aligned reads (seq_name, read_start, read_end, read_id, mapq) as Parquet in a folder for each sequence and bin of
    ``width`` positions that a read touches, for ``readers.fetch_reads``. Names are kept by their hash's buckets, so that
    many short sequences share folders."""
    first, last = F.floor(F.col("read_start") / width), F.floor(F.greatest("read_start", "read_end") / width)
    binned = reads.select("seq_name", *[F.col(c).cast(kind) for c, kind in (("read_start", "long"), ("read_end", "long"), ("read_id", "string"), ("mapq", "int"))], F.explode(F.sequence(first, last)).alias("bin"))
    write_by(binned.withColumn("bucket", name_bucket(F.col("seq_name"))), path, "bucket", "bin")


def write_score_statistics(scores: DataFrame, path: str, part: int = 1_000_000, segment: int = 100_000) -> None:
    """Score statistics, as ``evidence.score_statistics`` gives them, in 20 columns divided by commas, by line; pairs are
    joined by hyphens and lists by spaces.

    Parts are cut by what lines hold and not by their number, as some have many ids and most have none: a part ends once
    it has ``part`` ids and lines. A line's part is found by where parts begin within its ``segment`` of lines, so what is
    sent to all tasks is one entry for each part and segment, not one for each line.
    """
    scores = written(scores, "statistics")
    pair = lambda a, b: F.concat_ws("-", a, b)
    listed = lambda c: F.array_join(c, " ")
    columns = [F.col("line"), F.col("site_type"), F.col("size"), F.col("ref_id"), pair("start_pos", "end_pos"), pair("start_label", "end_label"), F.col("map_id"), pair("map_start_pos", "map_end_pos"), pair("map_start", "map_end"), F.col("mean_coverage"), F.col("hits")]
    columns += [F.col(c) for c in ("molecules", "reads", "total", "mean_per_hit", "mean_per_molecule", "score", "alt_score")] + [listed("molecule_ids"), listed("read_ids")]
    body = scores.select(F.col("line").cast("long").alias("line"), F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]).alias("value"))
    sizes = scores.select(F.col("line").cast("long").alias("line"), (F.lit(1) + F.coalesce("molecules", F.lit(0)) + F.coalesce("reads", F.lit(0))).cast("long").alias("_size"))
    dealt = with_running(sizes, [], ["line"], "_size", segment, "_upto").withColumn("_part", F.floor(F.col("_upto") / part).cast("int"))
    parts = written(in_segments(dealt, "line", segment).groupBy("_seg", "_part").agg(F.min("line").alias("first")), "parts")
    n = (parts.agg(F.max("_part")).first()[0] or 0) + 1
    begun = F.broadcast(parts.groupBy("_seg").agg(F.collect_list(F.struct("first", "_part")).alias("_parts")))
    own = F.array_max(F.transform(F.filter("_parts", lambda x: x["first"] <= F.col("line")), lambda x: x["_part"]))
    head = scores.sparkSession.createDataFrame([(0, SCORE_HEADER, 0)], "line long, value string, _part int")
    both = head.unionByName(in_segments(body, "line", segment).join(begun, "_seg").select("line", "value", own.alias("_part")))
    both.repartitionById(n, F.col("_part")).sortWithinPartitions("line").select("value").write.mode("overwrite").text(path)


def write_site_sequences(sites: DataFrame, path: str) -> None:
    """FASTA of sites with a sequence; a record is named by reference, start, end and type."""
    name = F.concat_ws("_", "ref_id", "start_pos", "end_pos", "site_type")
    sites.where("sequence is not null").select(F.concat(F.lit(">"), name, F.lit("\n"), F.col("sequence")).alias("value")).write.mode("overwrite").text(path)


def name_bucket(name: Column, buckets: int = 64) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def key_bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets).cast("int")


def write_by_key(df: DataFrame, path: str, key: str, rows: int = 1_000_000) -> None:
    """Parquet by a ``key`` of many values, such as a map: in a folder for each bucket of the values' hash, sorted by key
    within, for ``readers.fetch_by_key``. There are as many buckets as the table has times ``rows`` rows, so folders follow
    the rows and not the values. Values of one key lie in one folder."""
    table = written(df, "by-key")
    n = -(-table.count() // rows) or 1
    dealt = table.withColumns({"buckets": F.lit(n), "bucket": key_bucket(F.col(key), F.lit(n))}).repartitionById(n, F.col("bucket"))
    dealt.sortWithinPartitions("buckets", "bucket", key).write.mode("overwrite").partitionBy("buckets", "bucket").parquet(path)


def write_by(df: DataFrame, path: str, *columns: str) -> None:
    """Parquet in one folder for each value of ``columns``, such as a reference or a map; the rows of a value are
    gathered first, so it has few files."""
    df.repartition(*columns).write.mode("overwrite").partitionBy(*columns).parquet(path)
