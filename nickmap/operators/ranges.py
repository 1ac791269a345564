"""Scans along references in segments, so that tasks follow the rows and not the references.

A segment is a bin of positions. Windows run within segments; what a segment needs to know of those before or behind it (a
count, a running value, the next row) is carried over by one summary row for each segment, and only the summaries are
ordered by whole references.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nickmap.sources.shared import written

_UPTO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def in_segments(rows: DataFrame, at: str, width: int) -> DataFrame:
    """``rows`` with their segment of ``width`` positions as ``_seg``."""
    return rows.withColumn("_seg", F.floor(F.col(at) / width).cast("long"))


def _carry(rows: DataFrame, on: list[str], aggregates: list[Column], carried: list[tuple[str, Column]]) -> DataFrame:
    """A row for each segment with ``carried`` columns, windows over the segments' ``aggregates``."""
    return rows.groupBy(*on, "_seg").agg(*aggregates).select(*on, "_seg", *[c.alias(name) for name, c in carried])


def _along(on: list[str]):
    return Window.partitionBy(*on).orderBy("_seg")


def with_next(rows: DataFrame, on: str | list[str], order: list[str], names: dict[str, str], width: int) -> DataFrame:
    """Adds columns of the next row of each ``on`` in ``order`` (its first column the position): ``names`` maps new names to
    the columns they come from; null at the end."""
    on = [on] if isinstance(on, str) else on
    rows = in_segments(rows, order[0], width)
    fields = list(dict.fromkeys(names.values()))
    whole = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *fields])])
    ahead = _carry(rows, on, [F.min(whole).alias("_first")], [("_ahead", F.lead("_first").over(_along(on)))])
    behind = rows.withColumn("_next", F.lead(whole).over(Window.partitionBy(*on, "_seg").orderBy(*order))).join(ahead, [*on, "_seg"])
    following = F.coalesce("_next", "_ahead")
    return behind.select(*[c for c in rows.columns if c != "_seg"], *[following[c].alias(name) for name, c in names.items()])


def with_place(rows: DataFrame, on: str | list[str], order: list[str], width: int, place: str, total: str | None = None) -> DataFrame:
    """Adds each row's number from 1 along ``on`` in ``order`` as ``place``, and how many there are as ``total``."""
    on = [on] if isinstance(on, str) else on
    rows = in_segments(rows, order[0], width)
    along = _along(on)
    sums = [("_ahead", F.coalesce(F.sum("_n").over(along.rowsBetween(*_BEFORE)), F.lit(0)))] + ([(total, F.sum("_n").over(Window.partitionBy(*on)))] if total else [])
    carry = _carry(rows, on, [F.count(F.lit(1)).alias("_n")], sums)
    numbered = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*on, "_seg").orderBy(*order))).join(carry, [*on, "_seg"])
    return numbered.select(*[c for c in rows.columns if c != "_seg"], (F.col("_ahead") + F.col("_at")).alias(place), *([total] if total else []))


def with_running(rows: DataFrame, on: str | list[str], order: list[str], column: str, width: int, name: str, kind: str = "sum", own: bool = True) -> DataFrame:
    """Adds the ``kind`` (sum, max or min) of ``column`` over the rows of each ``on`` up to each one in ``order``; without
    ``own``, over those before it, null where there is none."""
    on = [on] if isinstance(on, str) else on
    f = {"sum": F.sum, "max": F.max, "min": F.min}[kind]
    both = {"sum": lambda a, b: F.when(a.isNull() & b.isNull(), None).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))), "max": F.greatest, "min": F.least}[kind]
    rows = in_segments(rows, order[0], width)
    carry = _carry(rows, on, [f(column).alias("_v")], [("_ahead", f("_v").over(_along(on).rowsBetween(*_BEFORE)))])
    within = Window.partitionBy(*on, "_seg").orderBy(*order).rowsBetween(*(_UPTO if own else _BEFORE))
    return rows.withColumn("_in", f(column).over(within)).join(carry, [*on, "_seg"]).select(*[c for c in rows.columns if c != "_seg"], both(F.col("_in"), F.col("_ahead")).alias(name))


def around(probes: DataFrame, labels: DataFrame, on: str, at: str, width: int, before: str, after: str) -> DataFrame:
    """Adds to ``probes`` (``on``, ``at`` and others) the greatest site_id of ``labels`` (``on``, site_id, pos) at or before
    ``at`` and the least at or after it; null where there is none. Site ids rise with positions."""
    own = [c for c in probes.columns if c not in (on, at)]
    rows = labels.select(on, F.col("pos").cast("long").alias("_at"), F.col("site_id").alias("_site"), F.lit(0).alias("_probe"), *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in own])
    asked = probes.select(on, F.col(at).cast("long").alias("_at"), F.lit(None).cast(labels.schema["site_id"].dataType).alias("_site"), F.lit(1).alias("_probe"), *own)
    both = in_segments(rows.unionByName(asked), "_at", width)
    behind = Window.partitionBy(on).orderBy(F.desc("_seg")).rowsBetween(*_BEFORE)
    carry = _carry(both, [on], [F.max("_site").alias("_most"), F.min("_site").alias("_least")], [("_past", F.max("_most").over(_along([on]).rowsBetween(*_BEFORE))), ("_future", F.min("_least").over(behind))])
    segment = Window.partitionBy(on, "_seg")
    found = both.withColumn("_b", F.max("_site").over(segment.orderBy("_at", "_probe").rowsBetween(*_UPTO))).withColumn("_a", F.min("_site").over(segment.orderBy(F.desc("_at"), "_probe").rowsBetween(*_UPTO)))
    found = found.where("_probe = 1").join(carry, [on, "_seg"])
    return found.select(on, F.col("_at").alias(at), *own, F.coalesce("_b", "_past").alias(before), F.coalesce("_a", "_future").alias(after))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their number from 1 over the whole table in ``order``: ranges are sorted each by itself and written,
    and the sizes of the ranges before are added."""
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(*_BEFORE)  # one row for each range
    ahead = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    return placed.withColumn("_part", part).join(F.broadcast(ahead), "_part").select(*rows.columns, (F.col("_ahead") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("number"))
