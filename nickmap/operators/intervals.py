"""Joins on intervals, by equality of bins that have levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nickmap.sources.shared import written


#: Levels of bins: each is of twice the width of the one below.
LEVELS = 40


def _bin(position: Column, width: Column) -> Column:
    return F.floor(position / width).cast("long")


def _level(start: Column, end: Column, width: int) -> Column:
    """The lowest level whose bins are no narrower than the interval, which thus touches two of them at most."""
    size = F.greatest((end - start).cast("double"), F.lit(1.0)) / float(width)
    return F.least(F.greatest(F.ceil(F.log2(size)), F.lit(0)), F.lit(LEVELS)).cast("int")


def _width(level: Column, width: int) -> Column:
    return F.pow(F.lit(2.0), level) * float(width)


def _levels(df: DataFrame, of: tuple[str, str], width: int, name: str) -> DataFrame:
    """The levels that intervals of ``df`` have: one row, of LEVELS + 1 entries at most."""
    return df.agg(F.collect_set(_level(F.col(of[0]), F.col(of[1]), width)).alias(name))


def overlap_join(left: DataFrame, right: DataFrame, on: list[str], a: tuple[str, str], b: tuple[str, str], width: int) -> DataFrame:
    """Rows of ``left`` and ``right`` with equal ``on`` whose closed intervals ``a`` and ``b`` overlap.

    Bins have levels. An interval is entered at the level of its own length, and at those higher ones that the other side
    has, in at most two bins each; so its copies are bounded whatever its length. A pair is made at the level of the longer
    one, in the first bin that both touch. ``width`` is that of the lowest level. Column names of the two sides must
    differ but for ``on``.
    """

    def entered(df, of, other, of_other, own):
        start, end = F.col(of[0]), F.greatest(of[0], of[1])
        levels = df.withColumn(own, _level(start, end, width)).join(F.broadcast(_levels(other, of_other, width, "_levels")))
        spread = levels.withColumn("_level", F.explode(F.array_union(F.array(own), F.filter("_levels", lambda x: x > F.col(own))))).drop("_levels")
        first, last = _bin(start, _width(F.col("_level"), width)), _bin(end, _width(F.col("_level"), width))
        return spread.withColumn(f"{own}_first", first).withColumn("_bin", F.explode(F.sequence(first, last)))

    pairs = entered(left, a, right, b, "_a").join(entered(right, b, left, a, "_b"), [*on, "_level", "_bin"])
    overlap = (F.col(a[0]) <= F.col(b[1])) & (F.col(b[0]) <= F.col(a[1]))
    once = (F.col("_level") == F.greatest("_a", "_b")) & (F.col("_bin") == F.greatest("_a_first", "_b_first"))
    return pairs.where(overlap & once).drop("_level", "_bin", "_a", "_b", "_a_first", "_b_first")


def _looked_up(outer: DataFrame, inner: DataFrame, on: list[str], a: tuple[str, str], b: tuple[str, str], width: int, how: str) -> DataFrame:
    """``inner`` looked up by where it starts at each level that ``outer`` has, where each of ``outer`` is entered at the
    level of its length, in at most two bins. ``how`` is inner, or left_semi, which gives a row for each level that matches."""
    end = F.greatest(a[0], a[1])
    span = lambda c: _bin(c, _width(F.col("_level"), width))
    held = outer.withColumn("_level", _level(F.col(a[0]), end, width)).withColumn("_bin", F.explode(F.sequence(span(F.col(a[0])), span(end))))
    at = F.transform("_levels", lambda x: F.struct(x.alias("_level"), _bin(F.col(b[0]), _width(x, width)).alias("_bin")))
    asked = inner.join(F.broadcast(_levels(outer, a, width, "_levels"))).withColumn("_at", F.explode(at)).select(*inner.columns, "_at._level", "_at._bin")
    x, y = asked.alias("x"), held.alias("y")
    inside = (F.col(f"y.{a[0]}") < F.col(f"x.{b[0]}")) & (F.col(f"y.{a[1]}") > F.col(f"x.{b[1]}"))
    joined = x.join(y, [*[F.col(f"x.{c}") == F.col(f"y.{c}") for c in [*on, "_level", "_bin"]], inside], how)
    return joined.select(*[F.col(f"x.{c}") for c in inner.columns], *([F.col(f"y.{c}") for c in outer.columns if c not in on] if how == "inner" else []))


def containment_join(outer: DataFrame, inner: DataFrame, on: list[str], a: tuple[str, str], b: tuple[str, str], width: int, how: str = "inner") -> DataFrame:
    """Rows of ``inner`` whose interval ``b`` lies strictly inside the interval ``a`` of a row of ``outer``.

    Bins have levels, so neither side has more copies than there are levels, whatever the lengths; ``width`` is that of the
    lowest. A pair comes once. ``how`` is that of ``inner.join(outer)``: inner, left_semi or left_anti; for the latter two
    rows of ``inner`` are written with a key of their own. See ``contained`` for keys alone.
    """
    if how == "inner":
        return _looked_up(outer, inner, on, a, b, width, how)
    keyed = written(inner.withColumn("_key", F.monotonically_increasing_id()), "keyed")
    return keyed.join(contained(outer, keyed, on, a, b, width, "_key"), "_key", how).select(*inner.columns)


def contained(outer: DataFrame, inner: DataFrame, on: list[str], a: tuple[str, str], b: tuple[str, str], width: int, key: str) -> DataFrame:
    """The distinct ``key`` of rows of ``inner`` that lie strictly inside a row of ``outer``."""
    return _looked_up(outer, inner, on, a, b, width, "left_semi").select(key).distinct()


def spanning_reads(sites: DataFrame, reads: DataFrame, buffer: int = 500, min_quality: int = 30, width: int = 10_000) -> DataFrame:
    """site_key, read_id: distinct reads that span each site (site_key, ref_id, start_pos, end_pos) by more than ``buffer``
    on both sides with at least ``min_quality``. Reads that reach no site's stretch on any reference are left out first."""
    good = reads.where(F.col("mapq") >= min_quality).select("ref_id", "read_id", F.col("read_start").alias("r0"), F.col("read_end").alias("r1"))
    wide = sites.select("ref_id", "site_key", (F.col("start_pos") - buffer).alias("w0"), (F.col("end_pos") + buffer).alias("w1"))
    ends = wide.agg(F.max("w0").alias("_last"), F.min("w1").alias("_first"))  # one row
    good = good.join(F.broadcast(ends)).where((F.col("r0") < F.col("_last")) & (F.col("r1") > F.col("_first"))).drop("_last", "_first")
    return containment_join(good, wide, ["ref_id"], ("r0", "r1"), ("w0", "w1"), width).select("site_key", "read_id").distinct()


def read_support(sites: DataFrame, reads: DataFrame, buffer: int = 500, min_quality: int = 30, width: int = 10_000) -> DataFrame:
    """site_key, reads: how many reads span each site, as ``spanning_reads`` has them; sites without any are left out."""
    return spanning_reads(sites, reads, buffer, min_quality, width).groupBy("site_key").agg(F.count(F.lit(1)).alias("reads"))


def validate_sites(sites: DataFrame, reads: DataFrame, alignments: DataFrame, flank: int = 1000, min_quality: int = 30, width: int = 10_000) -> DataFrame:
    """``sites`` (site_key, ref_id, start_pos, end_pos) with evidence: ``read`` where a read of enough quality contains
    the site widened by ``flank`` (its start held at 1), else ``alignment`` where an alignment (ref_id, ref_start,
    ref_end, ref_length) does, the widened end held within the reference; else null."""
    wide = sites.select("site_key", "ref_id", F.greatest(F.col("start_pos") - flank, F.lit(1)).alias("w0"), (F.col("end_pos") + flank).alias("w1"))
    good = reads.where(F.col("mapq") >= min_quality).select("ref_id", F.col("read_start").alias("r0"), F.col("read_end").alias("r1"))
    by_read = contained(good, wide, ["ref_id"], ("r0", "r1"), ("w0", "w1"), width, "site_key").withColumn("by_read", F.lit(True))
    lengths = alignments.groupBy("ref_id").agg(F.max("ref_length").alias("ref_length"))
    # A closed interval of whole positions lies within another where it lies strictly inside one wider by 1 on both sides.
    whole = alignments.select("ref_id", (F.col("ref_start") - 1).alias("r0"), (F.col("ref_end") + 1).alias("r1"))
    held = wide.join(lengths, "ref_id").select("site_key", "ref_id", "w0", F.least("w1", "ref_length").alias("w1"))
    by_alignment = contained(whole, held, ["ref_id"], ("r0", "r1"), ("w0", "w1"), width, "site_key").withColumn("by_alignment", F.lit(True))
    marked = sites.join(by_read, "site_key", "left").join(by_alignment, "site_key", "left")
    return marked.withColumn("evidence", F.when(F.col("by_read"), "read").when(F.col("by_alignment"), "alignment")).drop("by_read", "by_alignment")
