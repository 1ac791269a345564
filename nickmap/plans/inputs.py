"""Label maps, alignments, molecules and reads derived from the star-schema tables, for the registered queries.

Events of a user are the labels of a reference, blocks of eight of them an assembled map; positions are microseconds.
Line items are molecules and reads, orders are sites to validate; their positions are labels and days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOUR = 3_600_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _since(ts: str, day: str):
    return F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lit(f"{day} 00:00:00").cast("timestamp"))


def _day(ts: str):
    return F.datediff(F.col(ts).cast("date"), F.lit("1995-01-01").cast("date")).cast("long")


def nicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    strand = F.when(kind == "click", 1).when(kind == "view", -1).when(kind == "purchase", 2).when(kind == "signup", -2).otherwise(3)
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("ref_id"), _since("ts", "2024-01-01").alias("pos"), strand.alias("strand"))


def ref_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("ref_id"), F.row_number().over(order).cast("long").alias("site_id"), _since("ts", "2024-01-01").alias("pos"), F.col("value").alias("coverage"))


def blocks(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    """ref_id, blk, map_id, s0 and s1 (first and last reference label), orientation, confidence of each map; of the maps on
    ``labels`` (as of ``ref_labels``) if given, here and below."""
    b = F.floor((F.col("site_id") - 1) / 8).cast("long")
    grouped = (labels or ref_labels(spark, sf_dir)).withColumn("blk", b).groupBy("ref_id", "blk").agg(F.min("site_id").alias("lo"), F.max("site_id").alias("hi"), F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("coverage").cast("decimal(18,4)")), 2).cast("double").alias("confidence"))
    return grouped.select(
        "ref_id", "blk", (F.col("ref_id") * 1000 + F.col("blk")).alias("map_id"), F.greatest(F.col("lo") - F.when(F.col("blk") % 5 == 3, 3).otherwise(0), F.lit(1)).alias("s0"),
        (F.col("hi") - F.when(F.col("n") == 8, F.col("blk") % 3).otherwise(0)).alias("s1"), F.when((F.col("ref_id") + F.col("blk")) % 4 == 0, "-").otherwise("+").alias("orientation"), "confidence",
    )


def aligned_labels(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    """The columns of ``map_pairs`` and, of each label's map, orientation, confidence, ends (struct of the reference positions
    start, last and end of its alignment) and head (whether the label is its first on the reference).

    A label is in its block's map, one of the last three of a block maybe in the next one's too, so labels are sent to their
    maps once and are not joined.
    """
    b = F.floor((F.col("site_id") - 1) / 8).cast("long")
    near = F.when(((b + 1) % 5 == 3) & ((F.col("site_id") - 1) % 8 >= 5), F.array(b, b + 1)).otherwise(F.array(b))
    held = (labels or ref_labels(spark, sf_dir)).where("ref_id is not null").select("ref_id", "site_id", "pos", "coverage", b.alias("own"), F.explode(near).alias("blk"))
    whole = Window.partitionBy("ref_id", "blk")
    own = F.col("own") == F.col("blk")
    site, hi = F.when(own, F.col("site_id")), F.max(F.when(own, F.col("site_id"))).over(whole)
    maps = held.withColumns({
        "s0": F.greatest(F.min(site).over(whole) - F.when(F.col("blk") % 5 == 3, 3).otherwise(0), F.lit(1)), "n": F.count(site).over(whole), "hi": hi,
        "confidence": F.round(F.sum(F.when(own, F.col("coverage").cast("decimal(18,4)"))).over(whole), 2).cast("double"),
    }).where("n > 0")
    maps = maps.withColumn("s1", F.col("hi") - F.when(F.col("n") == 8, F.col("blk") % 3).otherwise(0)).where("site_id between s0 and s1")
    end = F.col("s1") - F.when((F.col("blk") % 7 == 6) & (F.col("s1") > F.col("s0")), 1).otherwise(0)
    maps = maps.withColumns({
        "orientation": F.when((F.col("ref_id") + F.col("blk")) % 4 == 0, "-").otherwise("+"), "head": F.col("site_id") == F.min("site_id").over(whole),
        "ends": F.struct(F.min("pos").over(whole).alias("start"), F.max("pos").over(whole).alias("last"), F.max(F.when(F.col("site_id") == end, F.col("pos"))).over(whole).alias("end")),
    })
    forward, first, last = F.col("orientation") == "+", F.col("ends.start"), F.col("ends.last")
    return maps.select(
        "ref_id", F.col("site_id").alias("ref_site"), F.col("pos").alias("ref_pos"), "coverage", (F.col("ref_id") * 1000 + F.col("blk")).alias("map_id"), F.when(forward, F.col("site_id") - F.col("s0") + 1).otherwise(F.col("s1") - F.col("site_id") + 1).alias("map_site"),
        F.when(forward, F.col("pos") - first + 20).otherwise(last - F.col("pos") + 20).alias("map_pos"), (F.col("s1") - F.col("s0") + 1).alias("num_sites"), (last - first + 40).alias("map_length"), F.col("blk").alias("entry"), "orientation", "confidence", "ends", "head",
    )


def map_pairs(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    """ref_id, ref_site, ref_pos, coverage, map_id, map_site, map_pos, num_sites, map_length, entry: all labels of all maps,
    with those of the reference that they align to."""
    return aligned_labels(spark, sf_dir, labels).drop("orientation", "confidence", "ends", "head")


def labels_of(pairs: DataFrame) -> DataFrame:
    """Map labels from ``map_pairs`` or ``aligned_labels``, as ``map_labels`` has them."""
    return pairs.select("map_id", "num_sites", F.col("map_site").alias("site_id"), F.col("map_pos").alias("pos"), "map_length")


def map_labels(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    return labels_of(map_pairs(spark, sf_dir, labels))


def alignments_of(pairs: DataFrame) -> DataFrame:
    """Alignments from ``aligned_labels``, as ``alignments`` has them."""
    forward, a, z, e = F.col("orientation") == "+", F.col("ends.start"), F.col("ends.last"), F.col("ends.end")
    return pairs.where("head").select(
        F.col("map_id").alias("qry_id"), "ref_id", "orientation", "confidence", a.alias("ref_start"), e.alias("ref_end"),
        F.when(forward, F.lit(20)).otherwise(z - a + 20).alias("qry_start"), F.when(forward, e - a + 20).otherwise(z - e + 20).alias("qry_end"),
    )


def alignments(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    """One alignment a map, from its first label to its last, or to the one before in every seventh map."""
    return alignments_of(aligned_labels(spark, sf_dir, labels))


def end_ratios(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    return _ratios(blocks(spark, sf_dir, labels))


def ratios_of(pairs: DataFrame) -> DataFrame:
    """End ratios from ``aligned_labels``, as ``end_ratios`` has them."""
    return _ratios(pairs.where("head"))


def _ratios(maps: DataFrame) -> DataFrame:
    return maps.select("map_id", (F.col("map_id") % 10 / 10.0).alias("start_ratio"), ((F.floor(F.col("map_id") / 10) + 7) % 10 / 10.0).alias("end_ratio"))


#: Where a line item lies as a molecule: a reference and its first and last label. Molecules that agree in it are a run.
RUN = {"map_id": "l_partkey % 150", "lab0": "1 + l_suppkey % 60", "lab1": "1 + l_suppkey % 60 + cast(l_quantity as bigint) % 12"}


def _placed(items: DataFrame) -> DataFrame:
    return items.withColumns({name: F.expr(sql) for name, sql in RUN.items()})


def molecules(spark: SparkSession, sf_dir: str, by_run: bool = False, among: DataFrame | None = None) -> DataFrame:
    """mol_id, map_id (a reference), lab0, lab1: runs of consecutive labels. Line items have no key of their own, so a
    molecule is told by all that it is made of; equal rows are one molecule. With ``by_run`` they lie by their runs, as a
    join on those needs them; the one shuffle for it also tells equal rows. ``among`` (of RUN's columns, distinct) are the
    runs whose molecules are asked for, all if not given; the others' aren't shuffled. There are 108,000 runs at most,
    150 x 60 x 12, whatever the size of the table, so they are sent to all tasks."""
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"), _day("l_shipdate").alias("day"), F.col("l_quantity").cast("long").alias("l_quantity")]
    items = _placed(_table(spark, sf_dir, "lineitem").select(*parts))
    if among is not None:
        items = items.join(F.broadcast(among), list(RUN), "left_semi")
    if by_run:
        items = items.repartition(*RUN).distinct()
    else:
        own = [c for c in items.columns if c not in RUN]
        items = _placed(items.select(*own).distinct())
    return items.select(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents", "day", "l_quantity").alias("mol_id"), *RUN)


def molecule_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct runs that molecules have."""
    return _placed(_table(spark, sf_dir, "lineitem")).select(*RUN).distinct()


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = _day("l_shipdate")
    name = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", start, F.col("l_quantity").cast("long"))
    return _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("ref_id"), name.alias("read_id"), start.alias("read_start"), (start + F.col("l_quantity").cast("long")).alias("read_end"), (F.col("l_linenumber") * 10).alias("mapq"))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("site_key"), (F.col("o_custkey") % 100).alias("ref_id"), _day("o_orderdate").alias("start_pos"), (_day("o_orderdate") + 5).alias("end_pos"))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"), F.col("text").alias("bases"))


#: The same inputs as common table expressions.
SQL = """
with nicks as (
  select user_id as ref_id, epoch_us(ts) - epoch_us(timestamp '2024-01-01') as pos,
         case event_type when 'click' then 1 when 'view' then -1 when 'purchase' then 2 when 'signup' then -2 else 3 end as strand
  from events),
neighbours as (
  select *, lead(pos) over w as pos2, lead(strand) over w as strand2 from nicks window w as (partition by ref_id order by pos)),
sites as (
  select ref_id, pos as start_pos, pos2 as end_pos, site_type from (
    select *, case
        when strand = 1 and strand2 = -1 and pos2 - pos <= 21600000000 then 'TypeI'
        when strand = -1 and strand2 = 1 and pos2 - pos <= 21600000000 then 'TypeII'
        when ((strand = 1 and strand2 = 2) or (strand = -2 and strand2 = -1)) and pos2 - pos <= 21600000000 then 'TypeIII'
        when ((strand = 2 and strand2 = 1) or (strand = -1 and strand2 = -2)) and pos2 - pos <= 21600000000 then 'TypeIV'
        when strand = strand2 and strand <> 3 and pos2 - pos <= 3600000000 then 'TypeV'
        when (strand = 3 or strand2 = 3) and pos2 - pos <= 21600000000 then 'TypeVI' end as site_type
    from neighbours) where site_type is not null),
keyed_sites as (select concat_ws('/', ref_id, start_pos) as site_key, * from sites),
ref_labels as (
  select user_id as ref_id, row_number() over (partition by user_id order by ts, event_id) as site_id,
         epoch_us(ts) - epoch_us(timestamp '2024-01-01') as pos, value as coverage
  from events),
maps as (
  select ref_id, b as blk, ref_id * 1000 + b as map_id,
         greatest(min(site_id) - case when b % 5 = 3 then 3 else 0 end, 1) as s0,
         max(site_id) - case when count(*) = 8 then b % 3 else 0 end as s1,
         case when (ref_id + b) % 4 = 0 then '-' else '+' end as orientation,
         cast(round(sum(cast(coverage as decimal(18,4))), 2) as double) as confidence
  from (select *, (site_id - 1) // 8 as b from ref_labels) group by ref_id, b),
map_pairs as (
  select m.ref_id, l.site_id as ref_site, l.pos as ref_pos, l.coverage, m.map_id,
         case m.orientation when '+' then l.site_id - m.s0 + 1 else m.s1 - l.site_id + 1 end as map_site,
         case m.orientation when '+' then l.pos - a.pos + 20 else z.pos - l.pos + 20 end as map_pos,
         m.s1 - m.s0 + 1 as num_sites, z.pos - a.pos + 40 as map_length, m.blk as entry
  from maps m
  join ref_labels a on a.ref_id = m.ref_id and a.site_id = m.s0
  join ref_labels z on z.ref_id = m.ref_id and z.site_id = m.s1
  join ref_labels l on l.ref_id = m.ref_id and l.site_id between m.s0 and m.s1),
map_labels as (select map_id, num_sites, map_site as site_id, map_pos as pos, map_length from map_pairs),
alignments as (
  select m.map_id as qry_id, m.ref_id, m.orientation, m.confidence, a.pos as ref_start, e.pos as ref_end,
         case m.orientation when '+' then 20 else z.pos - a.pos + 20 end as qry_start,
         case m.orientation when '+' then e.pos - a.pos + 20 else z.pos - e.pos + 20 end as qry_end
  from maps m
  join ref_labels a on a.ref_id = m.ref_id and a.site_id = m.s0
  join ref_labels z on z.ref_id = m.ref_id and z.site_id = m.s1
  join ref_labels e on e.ref_id = m.ref_id and e.site_id = m.s1 - case when m.blk % 7 = 6 and m.s1 > m.s0 then 1 else 0 end),
end_ratios as (select map_id, (map_id % 10) / 10.0::double as start_ratio, ((map_id // 10 + 7) % 10) / 10.0::double as end_ratio from maps),
molecules as (
  select distinct concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint),
                   date_diff('day', timestamp '1995-01-01', l_shipdate), cast(trunc(l_quantity) as bigint)) as mol_id,
         l_partkey % 150 as map_id, 1 + l_suppkey % 60 as lab0, 1 + l_suppkey % 60 + cast(trunc(l_quantity) as bigint) % 12 as lab1
  from lineitem),
mol_pairs as (
  select mol_id, map_id, map_site, map_site - lab0 + 1 as mol_site from (select *, unnest(range(lab0, lab1 + 1)) as map_site from molecules)
  where (map_id, map_site) in (select (ref_id, site_id) from ref_labels)),
reads as (
  select l_suppkey as ref_id,
         concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', timestamp '1995-01-01', l_shipdate), cast(trunc(l_quantity) as bigint)) as read_id,
         date_diff('day', timestamp '1995-01-01', l_shipdate) as read_start,
         date_diff('day', timestamp '1995-01-01', l_shipdate) + cast(trunc(l_quantity) as bigint) as read_end, l_linenumber * 10 as mapq
  from lineitem),
intervals as (
  select o_orderkey as site_key, o_custkey % 100 as ref_id, date_diff('day', timestamp '1995-01-01', o_orderdate) as start_pos,
         date_diff('day', timestamp '1995-01-01', o_orderdate) + 5 as end_pos
  from orders),
pairs0 as (
  select ref_id, row_number() over w as pair_no, qry_id as first_id, orientation as o1, confidence as c1, ref_start as r1s, ref_end as r1e, qry_start as q1s, qry_end as q1e,
         lead(qry_id) over w as second_id, lead(orientation) over w as o2, lead(confidence) over w as c2, lead(ref_start) over w as r2s, lead(ref_end) over w as r2e,
         lead(qry_start) over w as q2s, lead(qry_end) over w as q2e
  from alignments window w as (partition by ref_id order by ref_start, qry_id)),
pairs as (select *, r2s - r1e as distance from pairs0 where second_id is not null),
overlapping as (
  select * from pairs where r2e >= r1e and r2s >= r1s and r2e >= r1s and (distance >= 0 or abs(distance) <= 86400000000)),
near as (select * from overlapping where distance <= 43200000000),
terminal as (
  select p.* from near p
  join map_labels a on a.map_id = p.first_id and a.pos = p.q1e
  join map_labels b on b.map_id = p.second_id and b.pos = p.q2s
  where a.site_id = case p.o1 when '+' then a.num_sites else 1 end and b.site_id = case p.o2 when '+' then 1 else b.num_sites end),
labelled as (
  select p.*, coalesce(a.site_id, 0) as end_label, coalesce(b.site_id, 0) as start_label, coalesce(b.site_id, 0) - coalesce(a.site_id, 0) - 1 as ld
  from terminal p left join ref_labels a on a.ref_id = p.ref_id and a.pos = p.r1e left join ref_labels b on b.ref_id = p.ref_id and b.pos = p.r2s),
candidates as (select * from labelled where case when distance >= 0 then ld <= 1 else abs(ld) <= 5 end),
windowed as (
  select c.*, coalesce(a.pos, 0) as thick_start, coalesce(b.pos, 0) as thick_end, coalesce(m.pos, 0) as missed_label,
         case when ld < -1 then r2s - 21600000000 else coalesce(a.pos, 0) - 21600000000 end as window_min,
         case when ld < -1 then r1e + 21600000000 else coalesce(b.pos, 0) + 21600000000 end as window_max
  from candidates c
  left join ref_labels a on a.ref_id = c.ref_id and a.site_id = case when distance >= 0 then end_label - 1 else end_label end
  left join ref_labels b on b.ref_id = c.ref_id and b.site_id = case when distance >= 0 then start_label + 1 else start_label end
  left join ref_labels m on m.ref_id = c.ref_id and ld = 1 and m.site_id = end_label + 1),
accounted as (
  select w.ref_id, w.pair_no, min((s.start_pos, s.end_pos, s.site_type)) as site
  from windowed w join sites s on s.ref_id = w.ref_id
  where least(r1e, r2s) >= case when abs(s.start_pos - window_min) > 3600000000 then s.start_pos - 3600000001 else window_min end
    and greatest(r1e, r2s) <= case when abs(window_max - s.end_pos) > 3600000000 then s.end_pos + 3600000001 else window_max end
  group by w.ref_id, w.pair_no),
sited as (
  select w.*, site[1] as site_start, site[2] as site_end, site[3] as site_type from windowed w left join accounted using (ref_id, pair_no)),
faced as (
  select s.*, case o1 when '+' then a.end_ratio else a.start_ratio end as first_ratio, case o2 when '+' then b.start_ratio else b.end_ratio end as second_ratio,
         case o1 when '+' then a.start_ratio else a.end_ratio end as outer_start, case o2 when '+' then b.end_ratio else b.start_ratio end as outer_end
  from sited s join end_ratios a on a.map_id = first_id join end_ratios b on b.map_id = second_id),
eligible as (
  select * exclude (site_type), coalesce(site_type, case when first_ratio >= 0.7 and second_ratio >= 0.7 and ld >= -1
         and case when distance >= 0 then ld <= 1 else abs(ld) <= 5 end then 'Observed' end) as site_type from faced),
runs as (select *, pair_no - row_number() over (partition by ref_id order by pair_no) as run from eligible where site_type is not null),
plan as (select * from (select *, row_number() over (partition by ref_id, run order by pair_no) as n from runs) where n % 2 = 1)
"""
