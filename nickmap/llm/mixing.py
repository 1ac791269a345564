"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, table, with_row_id, written

SEED = "mix-1"


def words(text: Column) -> Column:
    """Number of runs of other than ASCII white space; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _body(doc_id: str, text: str) -> Column:
    """The digest of a text that has no id, so that rows without ids have draws of their own; else null."""
    return F.when(F.col(doc_id).isNull(), F.md5(F.coalesce(F.col(text), F.lit("")))).alias("body")


def water_fill(sources: DataFrame, total: Column, max_epochs: float) -> DataFrame:
    """Adds target to ``sources`` (source, source_size, weight): shares of ``total`` by weight, none above
    ``max_epochs`` times the source's size.

    Clamping and resharing until none is above ends where each target is the lesser of its cap and a common level times
    its weight; by rising cap a weight the level follows from running sums, so no loop is needed. The windows run over a
    row for each source.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    by_cap = Window.orderBy("full_at", "index")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = sources.withColumn("cap", cap).withColumn("full_at", cap / F.col("weight"))
    filled = filled.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # The caps fill in this order; the first source that its level doesn't fill sets the level of all behind it.
    level = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", "index", "level"))).over(Window.partitionBy())
    filled = filled.withColumn("common", level["level"])
    return filled.withColumn("target", F.coalesce(F.least("cap", F.col("common") * F.col("weight")), F.col("cap")))


def _mixed(base: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float, seed: str) -> DataFrame:
    """Adds source_size, target, whole (times a document comes whole) and part (further words of it) to ``base``
    (key, doc_id, source, size, body: digest of a text without id), a written table."""
    # Two levels of running sums; about as many buckets as a bucket has rows.
    buckets = max(1, math.isqrt(base.count()))
    draw = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null"), "body"))))
    bucket = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("long")

    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("index", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.element_at(turn, (F.col("index") - 1) % len(weights) + 1))
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    sources = water_fill(sources, total, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("whole", whole).withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    sources = written(sources.select("source", "index", "source_size", "target", "whole", "rest"), "sources")

    known = sources.select(F.col("source").alias("of"), "index", "source_size", "target", "whole", "rest")
    drawn = base.withColumn("draw", draw).join(known, F.col("source").eqNullSafe(F.col("of"))).withColumn("bucket", bucket)
    drawn = written(drawn.select("key", "doc_id", "size", "draw", "index", "bucket", "source_size", "target", "whole", "rest"), "drawn")
    sums = drawn.groupBy("index", "bucket").agg(F.sum("size").alias("in_bucket"))
    ahead = Window.partitionBy("index").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("index", "bucket", F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("index", "bucket").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(sums, ["index", "bucket"])
    part = F.least(F.greatest(F.col("rest") - F.col("ahead") - F.col("within"), F.lit(0)), F.col("size"))
    return placed.select("key", "doc_id", "size", "source_size", "target", "whole", part.alias("part"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, max_epochs: float = 2.0, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of ``docs`` (doc_id, text, source).

    Sources by code point, nulls as a source of their own and last, weigh ``weights`` in turn and share ``share`` times
    all words; see ``water_fill``. A source's documents come whole as often as its target holds them all; the rest is
    taken from its documents in an order drawn from ``seed`` and doc_id, the last of them in part, so that the words
    taken are the target rounded. Rows that tie in that order count by size, so a rerun takes the same. Null texts have size 0
    and give nothing; rows without an id are drawn by their text; further columns are ignored; an empty table gives an empty result.
    """
    base = written(docs.select(F.lit(None).cast("long").alias("key"), "doc_id", "source", words(F.col("text")).alias("size"), _body("doc_id", "text")), "mix")
    mixed = _mixed(base, weights, share, max_epochs, seed)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, max_epochs: float = 2.0, seed: str = SEED) -> DataFrame:
    """The mix itself: rows of ``docs`` with all columns, each as often as it is taken. The one document of a source that
    comes in part has its first words, joined by spaces."""
    rows = with_row_id(docs)
    base = written(rows.select(F.col("row_id").alias("key"), "row.doc_id", "row.source", words(F.col("row.text")).alias("size"), _body("row.doc_id", "row.text")), "mix")
    mixed = _mixed(base, weights, share, max_epochs, seed).where("whole > 0 or part > 0").select(F.col("key").alias("row_id"), "size", "whole", "part")
    times = F.concat(F.array_repeat(F.col("size"), F.col("whole").cast("int")), F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<long>")))
    taken = rows.join(mixed.withColumn("times", times), "row_id").withColumn("n", F.explode("times"))
    some = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0)), 1, F.greatest(F.col("n"), F.lit(1)).cast("int")), " ")
    text = F.when(F.col("n") == F.col("size"), F.col("row.text")).otherwise(some)
    return taken.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
with docs as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5(concat('mix-1', coalesce(cast(doc_id as varchar), concat('null', md5(coalesce(text, '')))))) as draw
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as index
  from docs group by source),
weighed as (
  select *, case (index - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight,
         1.5 * sum(source_size) over () as total, 2.0 * source_size as cap
  from sources),
levels as (
  select *, cap / weight as full_at,
         (total - coalesce(sum(cap) over (order by cap / weight, index rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by cap / weight, index rows between current row and unbounded following) as level
  from weighed),
filled as (
  select source, index, source_size, cast(least(cap, weight * (
           select level from levels x where level < full_at order by full_at, index limit 1)) as double) as target
  from levels),
parted as (
  select *, cast(case when source_size > 0 then floor(target / source_size) else 0 end as bigint) as whole from filled)
select doc_id, size, source_size, target,
       cast(whole * size + least(greatest(round(target - whole * source_size)
            - coalesce(sum(size) over (partition by p.index order by draw, doc_id, size rows between unbounded preceding and 1 preceding), 0), 0), size) as bigint) as taken
from docs d join parted p on d.source is not distinct from p.source
"""
