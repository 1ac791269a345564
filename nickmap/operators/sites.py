"""Fragile sites: neighbouring nicks classified by their strands, and statistics of sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nickmap.functions.scalars import flank
from nickmap.operators.ranges import with_next
from nickmap.sources.shared import written


def classify_sites(nicks: DataFrame, max_gap: int = 1000, short_gap: int = 100, aggressive: bool = False, compat: bool = False, segment: int | None = None) -> DataFrame:
    """ref_id, start_pos, end_pos, site_type for neighbouring nicks (ref_id, pos, strand) of a known kind.

    Strands are 1 and -1, for four-way scans also 2 (reverse) and -2 (complement), and 3 for a position hit twice. Types I
    and II are opposite strands that face each other or not, III and IV mixed orientations, V equal strands within
    ``short_gap``, VI a pair with a position hit twice; V and VI are for ``aggressive`` scans. ``compat`` also gives pairs
    of no type, with a null, at any distance. A task has a ``segment`` of a reference, 1000 times ``max_gap`` if not given.
    """
    pairs = with_next(nicks.select("ref_id", "pos", "strand"), "ref_id", ["pos"], {"end_pos": "pos", "strand2": "strand"}, segment or 1000 * max_gap)
    pairs = pairs.withColumnRenamed("pos", "start_pos").where("end_pos is not null")
    gap, a, b = F.col("end_pos") - F.col("start_pos"), F.col("strand"), F.col("strand2")
    near = gap <= max_gap
    kind = F.when(near & (a == 1) & (b == -1), "TypeI").when(near & (a == -1) & (b == 1), "TypeII")
    kind = kind.when(near & (((a == 1) & (b == 2)) | ((a == -2) & (b == -1))), "TypeIII")
    kind = kind.when(near & (((a == 2) & (b == 1)) | ((a == -1) & (b == -2))), "TypeIV")
    if aggressive:
        kind = kind.when((a == b) & (a != 3) & (gap <= short_gap), "TypeV").when(near & ((a == 3) | (b == 3)), "TypeVI")
    typed = pairs.select("ref_id", "start_pos", "end_pos", kind.alias("site_type"))
    return typed if aggressive and compat else typed.where("site_type is not null")


def site_type_counts(sites: DataFrame) -> DataFrame:
    """ref_id, site_type, sites: counts for each reference and type, each reference, and in all (nulls mark totals)."""
    return sites.rollup("ref_id", "site_type").agg(F.count(F.lit(1)).alias("sites"))


def site_statistics(sites: DataFrame) -> DataFrame:
    """site_type, sites, mean_score, sd_score (0 for a single site) of ``sites`` (site_type, score)."""
    sd = F.coalesce(F.stddev_samp("score"), F.lit(0.0))
    return sites.groupBy("site_type").agg(F.count(F.lit(1)).alias("sites"), F.round(F.avg("score"), 2).alias("mean_score"), F.round(sd, 2).alias("sd_score"))


def site_sequences(sites: DataFrame, sequences: DataFrame, buffer: int = 50, size: int = 65_536, overlap: int = 0) -> DataFrame:
    """Adds flank_start, flank_end and sequence to ``sites`` (ref_id, start_pos, end_pos): the site's bases with
    ``buffer`` more on either side, from chunks (seq_id, length, chunk_start, bases) of ``size`` that run on into the next
    for ``overlap`` at least.

    A stretch that the chunk of its first base holds whole is cut from it as the two meet. Longer ones are put together from
    all chunks that they touch, of each the bases before the next chunk starts; only those are shuffled.
    """
    start, end = flank(F.col("start_pos"), F.col("end_pos"), F.col("length"), buffer)
    lengths = sequences.where("chunk_start = 0").select(F.col("seq_id").alias("ref_id"), "length")
    placed = sites.join(lengths, "ref_id").withColumn("flank_start", start).withColumn("flank_end", end).drop("length")
    first, last = F.floor((F.col("flank_start") - 1) / size), F.floor((F.col("flank_end") - 1) / size)
    whole = F.col("flank_end") <= (F.col("_k") + 1) * size + overlap
    # No place is left out: where an end is not known, the stretch is empty, as it is where it ends before it starts.
    placed = placed.withColumn("_k", first).withColumn("_whole", F.coalesce(whole, F.lit(True)))
    placed = written(placed, "stretches")
    chunks = sequences.select(F.col("seq_id").alias("ref_id"), F.floor(F.col("chunk_start") / size).alias("_k"), F.col("chunk_start").alias("_c"), "bases")
    own = F.substring(F.col("bases"), (F.col("flank_start") - F.col("_c")).cast("int"), (F.col("flank_end") - F.col("flank_start") + 1).cast("int"))
    cut = placed.where("_whole").join(chunks, ["ref_id", "_k"], "left").withColumn("sequence", F.when(F.col("flank_end") >= F.col("flank_start"), own))
    stretch = ["ref_id", "flank_start", "flank_end"]
    far = placed.where("not _whole")
    touched = far.select(*stretch).distinct().select(*stretch, F.explode(F.sequence(first, last)).alias("_k"))
    begin = F.greatest(F.col("flank_start") - 1, F.col("_c"))
    part = F.substring(F.col("bases"), (begin - F.col("_c") + 1).cast("int"), (F.least(F.col("flank_end"), F.col("_c") + size) - begin).cast("int"))
    parts = touched.join(chunks, ["ref_id", "_k"]).groupBy(*stretch).agg(F.array_sort(F.collect_list(F.struct("_k", part.alias("part")))).alias("_parts"))
    gathered = parts.select(*stretch, F.array_join(F.transform("_parts", lambda x: x["part"]), "").alias("sequence"))
    columns = [*sites.columns, "flank_start", "flank_end", F.coalesce("sequence", F.lit("")).alias("sequence")]
    return cut.select(*columns).unionByName(far.join(gathered, stretch, "left").select(*columns))
