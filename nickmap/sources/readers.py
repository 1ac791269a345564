"""Readers of the text formats: label maps, alignments, sites, sequences, keys, ratios, scores, reads and noise tables.

All parse with DataFrame functions, so a file is split over tasks like any other. Comment lines start with ``#``; fields
are trimmed; a field that is missing or no number is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nickmap.functions.scalars import alignment_pairs
from nickmap.sources.shared import written
from nickmap.sources.writers import key_bucket, name_bucket

POSITION = "decimal(18,1)"
#: Lines of FASTA that one task puts in order at once.
LINES = 1 << 17
_MAP = {"cmap_id": "long", "contig_length": POSITION, "num_sites": "int", "site_id": "int", "channel": "int", "position": POSITION, "stddev": "double", "coverage": "double", "occurrence": "double"}
_ALIGNMENT = {"entry_id": "long", "qry_id": "long", "ref_id": "long", "qry_start": POSITION, "qry_end": POSITION, "ref_start": POSITION, "ref_end": POSITION, "orientation": "string", "confidence": "double", "hit_enum": "string", "qry_len": POSITION, "ref_len": POSITION, "channel": "int", "alignment": "string"}
_SITE = {"ref_id": "long", "start_pos": "long", "end_pos": "long", "site_type": "string", "score": "double", "strand": "string", "thick_start": "long", "thick_end": "long", "item_rgba": "string", "sequence": "string"}
_KEY = {"ref_id": "long", "name": "string", "length": "long"}
_RATIO = {"map_id": "long", "start_ratio": "double", "end_ratio": "double"}
_READ = {"seq_name": "string", "read_start": "long", "read_end": "long", "read_id": "string", "mapq": "int"}

# Older names of the noise table's columns.
NOISE_NAMES = {"FNrate": "FN(rate)", "SiteSD": "sf", "ScalingSD": "sd", "RelativeSD": "sr"}


def _fields(spark: SparkSession, path: str | list[str], separator: str = "\t") -> DataFrame:
    """fields (trimmed), file: one row for each line that is no comment."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("file"))
    lines = lines.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return lines.select(F.transform(F.split("value", separator), lambda x: F.trim(x)).alias("fields"), "file")


def _typed(rows: DataFrame, schema: dict[str, str], *more: Column) -> DataFrame:
    field = lambda i: F.nullif(F.get("fields", F.lit(i)), F.lit(""))
    return rows.select(*[field(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(schema.items())], *more)


def read_maps(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Label maps, a row for each label and one of channel 0 at each map's end; columns after the ninth are kept in
    ``rest``."""
    return _typed(_fields(spark, path), _MAP, F.expr("slice(fields, 10, greatest(size(fields) - 9, 0))").alias("rest"))


def read_alignments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignments of maps to maps, with ``pairs``: array of aligned (ref, qry) label ids."""
    return _typed(_fields(spark, path), _ALIGNMENT).withColumn("pairs", alignment_pairs(F.col("alignment")))


def read_sites(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sites of nine or ten columns, in any number of files; the sequence is null in files of nine."""
    return _typed(_fields(spark, path), _SITE)


def read_keys(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Names and lengths of references; the line of column names is left out."""
    return _typed(_fields(spark, path).where(~F.get("fields", F.lit(0)).startswith("CompntId")), _KEY)


def read_ratios(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _typed(_fields(spark, path), _RATIO)


def read_scores(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What breaking needs of score statistics: line, type, map, the two map positions, molecules, reads, score."""
    at = lambda i: F.get("fields", F.lit(i))
    rows = _fields(spark, path, ",")
    ends = F.split(at(7), "-")
    return rows.select(at(0).try_cast("long").alias("line"), at(1).alias("site_type"), at(6).try_cast("long").alias("map_id"), F.get(ends, F.lit(0)).try_cast("double").alias("map_start_pos"), F.get(ends, F.lit(1)).try_cast("double").alias("map_end_pos"), at(11).try_cast("long").alias("molecules"), at(12).try_cast("long").alias("reads"), at(16).try_cast("double").alias("score"))


def read_noise(spark: SparkSession, path: str) -> DataFrame:
    """The last row of a noise table, under today's column names."""
    table = spark.read.option("header", True).option("sep", "\t").option("inferSchema", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    table = table.withColumnsRenamed({c: NOISE_NAMES.get(c.lstrip("#"), c.lstrip("#")) for c in table.columns})
    order = F.col(f"`{table.columns[0]}`")
    return table.orderBy(order.desc()).limit(1)


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Aligned reads of SAM text: seq_name, read_start, read_end, read_id, mapq. A read ends after the bases of the
    reference that its CIGAR consumes; unmapped reads are left out."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@")).select(F.split("value", "\t").alias("f"))
    steps = F.regexp_extract_all(F.get("f", F.lit(5)), F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    size = F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    start = F.get("f", F.lit(3)).try_cast("long")
    rows = lines.select(F.get("f", F.lit(2)).alias("seq_name"), start.alias("read_start"), (start + size - 1).alias("read_end"), F.get("f", F.lit(0)).alias("read_id"), F.get("f", F.lit(4)).try_cast("int").alias("mapq"))
    return rows.where((F.col("seq_name") != "*") & (F.col("read_end") >= F.col("read_start")))


def read_alignment_table(spark: SparkSession, path: str) -> DataFrame:
    """Aligned reads kept as Parquet with the columns of ``read_sam``."""
    return spark.read.parquet(path).select(*[F.col(c).cast(kind).alias(c) for c, kind in _READ.items()])


def fetch_reads(spark: SparkSession, path: str, regions: DataFrame, width: int = 1 << 20) -> DataFrame:
    """``regions`` (seq_name, w0, w1 and others) with the reads of ``writers.write_reads`` that reach them, once each.

    Reads are looked up by the folders' columns, so Spark prunes those that no region touches when it runs; ``width`` is
    that of the write.
    """
    first, last = F.floor(F.col("w0") / width), F.floor(F.greatest("w0", "w1") / width)
    asked = regions.withColumn("bucket", name_bucket(F.col("seq_name"))).withColumn("_first", first).withColumn("bin", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    asked = asked.where(F.col("bin") >= F.col("_first"))  # always so; a side with a condition is one that Spark prunes by
    reads = spark.read.parquet(path)
    found = reads.join(asked, ["bucket", "bin", "seq_name"]).where((F.col("read_start") <= F.greatest("w0", "w1")) & (F.col("read_end") >= F.col("w0")))
    once = F.col("bin") == F.greatest(F.floor(F.col("read_start") / width), F.col("_first"))
    return found.where(once).select(*regions.columns, "read_start", "read_end", "read_id", "mapq")


def fetch_by_key(spark: SparkSession, path: str, key: str, values: list) -> DataFrame:
    """Rows of a table of ``writers.write_by_key`` with these ``values`` of ``key``; only their buckets' folders are read."""
    table = spark.read.parquet(path)
    kind = table.schema[key].dataType
    held = F.lit(False)
    for value in values:
        held = held | ((F.col("bucket") == key_bucket(F.lit(value).cast(kind), F.col("buckets"))) & (F.col(key) == F.lit(value)))
    return table.where(held).drop("buckets", "bucket")


def named_references(names: DataFrame, keys: DataFrame) -> DataFrame:
    """seq_name, ref_id for each sequence name that contains a key's name or lies in it, whatever the case; the longest
    such key counts, then the least id. Null and empty names match nothing.

    Both ways are equality joins: of the parts of one side's names that are as long as some name of the other.
    """
    keys = keys.where("name <> ''").groupBy(F.lower("name").alias("key")).agg(F.min("ref_id").alias("ref_id"))
    names = names.where("seq_name <> ''").select("seq_name", F.lower("seq_name").alias("text")).distinct()

    def parts(texts: DataFrame, text: str, others: DataFrame, other: str) -> DataFrame:
        sizes = others.agg(F.collect_set(F.length(other)).alias("sizes"))  # one row, no more entries than a name is long
        of = lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda at: F.substring(F.col(text), at, n))
        fitting = F.filter("sizes", lambda n: n <= F.length(text))
        return texts.join(F.broadcast(sizes)).withColumn("part", F.explode(F.array_distinct(F.flatten(F.transform(fitting, of))))).drop("sizes")

    inside = parts(names, "text", keys, "key").drop("text").join(keys, F.col("part") == F.col("key")).select("seq_name", "key", "ref_id")
    around = parts(keys, "key", names, "text").join(names, F.col("part") == F.col("text")).select("seq_name", "key", "ref_id")
    return inside.unionByName(around).groupBy("seq_name").agg(F.min_by("ref_id", F.struct(-F.length("key"), "ref_id")).alias("ref_id"))


def read_sequences(spark: SparkSession, path: str | list[str], size: int = 65_536, overlap: int = 64, names: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sequences of FASTA text as (seq_id, name, length), numbered from 1 in the order of the files, and as chunks like
    those of ``operators.sequence.chunked``, in upper case, with ``names`` those of their sequences too.

    A file is read by lines, so a chromosome is split over tasks and never is one value. Lines get their places by
    running sums in two levels: within a stretch of at most LINES lines of a file's block, and over the stretches; by the
    same, where their sequence starts, ends and what it is called. So lines are shuffled once, and once more only where a
    chunk has several.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", "\\s+$", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    head = F.col("value").startswith(">")
    lines = lines.select("file", "block", F.floor(F.col("n") / LINES).alias("stretch"), "n", head.cast("long").alias("head"), F.when(head, 0).otherwise(F.length("value")).cast("long").alias("bases"), F.when(head, F.substring("value", 2, 1 << 30)).alias("name"), F.when(~head, F.col("value")).alias("value"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    stretch = ["file", "block", "stretch"]
    within = Window.partitionBy(*stretch).orderBy("n")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = before(Window.partitionBy(*stretch).orderBy(F.desc("n")))
    placed = lines.withColumn("h", F.sum("head").over(upto)).withColumn("b", F.coalesce(F.sum("bases").over(before(within)), F.lit(0)))
    mark = F.when(F.col("head") == 1, F.col("b"))
    placed = placed.withColumn("start", F.max(mark).over(upto)).withColumn("called", F.last("name", ignorenulls=True).over(upto)).withColumn("end", F.min(mark).over(behind)).drop("n")
    placed = written(placed, "fasta-places")
    # One row for each stretch, from here to the join.
    totals = placed.groupBy(*stretch).agg(F.sum("head").alias("heads"), F.sum("bases").alias("total"), F.min(mark).alias("first"), F.max(mark).alias("last"), F.max_by("name", F.when(F.col("head") == 1, F.col("h"))).alias("name"))
    ahead, later = before(Window.orderBy(*stretch)), before(Window.orderBy(*[F.desc(c) for c in stretch]))
    totals = totals.withColumns({"heads_ahead": F.coalesce(F.sum("heads").over(ahead), F.lit(0)), "bases_ahead": F.coalesce(F.sum("total").over(ahead), F.lit(0)), "name_ahead": F.last("name", ignorenulls=True).over(ahead)})
    all_bases = F.sum("total").over(Window.partitionBy())
    totals = totals.withColumns({"opened": F.max(F.col("bases_ahead") + F.col("last")).over(ahead), "closed": F.coalesce(F.min(F.col("bases_ahead") + F.col("first")).over(later), all_bases)})
    totals = written(totals.select(*stretch, "heads_ahead", "bases_ahead", "name_ahead", "opened", "closed"), "fasta-blocks")
    start, end = F.coalesce(F.col("bases_ahead") + F.col("start"), F.col("opened")), F.coalesce(F.col("bases_ahead") + F.col("end"), F.col("closed"))
    rows = placed.join(F.broadcast(totals), stretch).select("value", "head", "bases", (F.col("h") + F.col("heads_ahead")).alias("seq_id"), (end - start).alias("length"), (F.col("b") + F.col("bases_ahead") - start).alias("at"), F.coalesce("called", "name_ahead").alias("name")).where("seq_id > 0")
    lengths = rows.where("head = 1").select("seq_id", "name", "length")
    # Chunk k holds [k * size, (k + 1) * size + overlap): a line goes to each chunk that it touches.
    first, last = F.greatest(F.floor((F.col("at") - overlap) / size), F.lit(0)), F.floor((F.col("at") + F.col("bases") - 1) / size)
    touched = rows.where("head = 0 and bases > 0").withColumn("k", F.explode(F.sequence(first, last))).withColumn("c0", F.col("k") * size).withColumn("c1", F.least((F.col("k") + 1) * size + overlap, "length"))
    skip = F.greatest(F.col("c0") - F.col("at"), F.lit(0))
    part = F.substring(F.upper("value"), (skip + 1).cast("int"), (F.least(F.col("c1"), F.col("at") + F.col("bases")) - F.col("at") - skip).cast("int"))
    key = ["seq_id", "length", "k", *(["name"] if names else [])]
    alone = (F.col("at") <= F.col("c0")) & (F.col("at") + F.col("bases") >= F.col("c1"))
    single = touched.where(alone).select(*key, part.alias("bases"))
    parts = touched.where(~alone).withColumn("part", part).where(F.length("part") > 0)
    several = parts.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]), "").alias("bases"))
    chunks = single.unionByName(several)
    chunks = chunks.select("seq_id", "length", (F.col("k") * size).alias("chunk_start"), F.least((F.col("k") + 1) * size, F.col("length")).alias("chunk_end"), "bases", *(["name"] if names else [])).where("chunk_start < chunk_end")
    return lengths, chunks
