"""Operations on maps: merging along a plan, lifting alignments and labels, breaking, reducing, and sets of maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nickmap.functions.scalars import padding
from nickmap.operators.ranges import numbered, with_running
from nickmap.operators.stitch import SEGMENT
from nickmap.sources.shared import written

#: Maps that six rounds of pairwise merging can make one.
GROUP = 64
#: Names of merged maps are the first one's with this added in each round, as the formats have it; ids are dealt out.
NAME_OFFSET = 100_000


def pairwise_groups(plan: DataFrame) -> DataFrame:
    """Junctions of a plan of disjoint pairs: each pair is a group of its own, named by its first map."""
    return _junctions(plan.withColumn("group_id", F.col("first_id")).withColumn("junction", F.lit(1)))


def chained_groups(pairs: DataFrame) -> DataFrame:
    """Junctions of runs of consecutive ``pairs`` (all eligible ones, not only disjoint): what repeated rounds of pairwise
    merging give, in groups of at most GROUP maps. A group is named by its first map. A map that recurs on a reference is
    merged there once, at its first place among the pairs: pairs that need it at another place are left out."""
    places = pairs.select("ref_id", F.explode(F.array(F.struct(F.col("first_id").alias("id"), F.col("pair_no").alias("at")), F.struct(F.col("second_id").alias("id"), (F.col("pair_no") + 1).alias("at")))).alias("x"))
    first = places.groupBy("ref_id", "x.id").agg(F.min("x.at").alias("at"))
    pairs = pairs.join(first.toDF("ref_id", "first_id", "_a"), ["ref_id", "first_id"]).join(first.toDF("ref_id", "second_id", "_b"), ["ref_id", "second_id"])
    pairs = pairs.where((F.col("_a") == F.col("pair_no")) & (F.col("_b") == F.col("pair_no") + 1)).drop("_a", "_b")
    along = Window.partitionBy("ref_id").orderBy("pair_no")
    runs = pairs.withColumn("_run", F.col("pair_no") - F.row_number().over(along))
    within = Window.partitionBy("ref_id", "_run").orderBy("pair_no")
    placed = runs.withColumn("_n", F.row_number().over(within) - 1).withColumn("_g", F.floor(F.col("_n") / GROUP))
    inside = placed.where(F.floor((F.col("_n") + 1) / GROUP) == F.col("_g"))
    group = Window.partitionBy("ref_id", "_run", "_g").orderBy("pair_no")
    named = inside.withColumn("group_id", F.first("first_id").over(group)).withColumn("junction", F.row_number().over(group))
    return _junctions(named)


def _junctions(pairs: DataFrame) -> DataFrame:
    """group_id, junction, the two maps, and what merging needs: pad, labels to trim on either side, missed label."""
    pad = padding(F.col("first_ref_end"), F.col("second_ref_start"))
    cut = F.when((F.col("label_distance") <= -2) & (pad < 0), F.abs("label_distance")).otherwise(0)
    first = F.col("first_confidence") >= F.col("second_confidence")
    offset = F.when(F.col("label_distance") == 1, F.abs(F.col("missed_label") - F.col("first_ref_end")) + 1)
    return pairs.select("ref_id", "group_id", "junction", "first_id", "second_id", "first_orientation", "second_orientation", pad.alias("pad"), F.when(first, cut).otherwise(0).alias("trim_first"), F.when(first, 0).otherwise(cut).alias("trim_second"), offset.alias("missed_offset"))


def lineage(junctions: DataFrame, map_labels: DataFrame) -> DataFrame:
    """What becomes of maps, as a written table: a row for each map of each group with ref_id, group_id, new_id, name, member
    (from 1), map_id, orientation, trims, shift of its positions, map_length, num_sites and the merged map's new_length.

    A group is told by its reference and its first map, so a map that aligns to two references is merged on each of them.
    New ids are dealt out above the greatest id of ``map_labels``, in the order of ref_id and group_id, so none names two
    maps; labels, alignments, ratios and stitches of merged maps all take theirs from here. ``name`` is the first map's id
    with the offset added as often as pairwise rounds would add it, which several maps can share.
    """
    first = junctions.where("junction = 1").select("ref_id", "group_id", F.lit(1).alias("member"), F.col("first_id").alias("map_id"), F.col("first_orientation").alias("orientation"), F.lit(0).alias("pad_before"), F.lit(0).alias("trim_head"))
    others = junctions.select("ref_id", "group_id", (F.col("junction") + 1).alias("member"), F.col("second_id").alias("map_id"), F.col("second_orientation").alias("orientation"), F.col("pad").alias("pad_before"), F.col("trim_second").alias("trim_head"))
    tails = junctions.select("ref_id", "group_id", F.col("junction").alias("member"), F.col("trim_first").alias("trim_tail"), "missed_offset")
    lengths = map_labels.select("map_id", "map_length", "num_sites").distinct()
    greatest = map_labels.agg(F.max("map_id").alias("_greatest"))  # one row
    ids = numbered(first.select("ref_id", "group_id"), "ref_id", "group_id").join(F.broadcast(greatest)).select("ref_id", "group_id", (F.col("_greatest") + F.col("number")).cast("long").alias("new_id"))
    members = first.unionByName(others).join(tails, ["ref_id", "group_id", "member"], "left").join(lengths, "map_id").join(ids, ["ref_id", "group_id"])
    group = Window.partitionBy("ref_id", "group_id")
    upto = group.orderBy("member").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rounds = F.ceil(F.log2(F.count(F.lit(1)).over(group)))
    size = F.col("map_length") + F.col("pad_before")
    return written(members.select(
        "ref_id", "group_id", "new_id", (F.col("group_id") + NAME_OFFSET * rounds).cast("long").alias("name"), "member", "map_id", "orientation", "trim_head", F.coalesce("trim_tail", F.lit(0)).alias("trim_tail"), "missed_offset",
        (F.sum(size).over(upto) - F.col("map_length")).alias("shift"), "map_length", "num_sites", F.sum(size).over(group).alias("new_length"),
    ), "lineage")


def merge_maps(members: DataFrame, map_labels: DataFrame) -> DataFrame:
    """map_id, num_sites, site_id, pos, map_length, old_id, old_site of the merged maps of a ``lineage``: members turned to
    the reference, trimmed, shifted behind one another, with labels the assemblies missed (old_id null) put in, and
    numbered anew."""
    forward = F.col("orientation") == "+"
    turned = members.join(map_labels.select("map_id", F.col("site_id").alias("old_site"), F.col("pos").alias("old_pos")), "map_id")
    turned = turned.withColumn("_site", F.when(forward, F.col("old_site")).otherwise(F.col("num_sites") - F.col("old_site") + 1))
    turned = turned.withColumn("_pos", F.col("shift") + F.when(forward, F.col("old_pos")).otherwise(F.col("map_length") - F.col("old_pos")))
    kept = turned.where((F.col("_site") > F.col("trim_head")) & (F.col("_site") <= F.col("num_sites") - F.col("trim_tail")))
    kept = kept.select("new_id", "new_length", "member", F.lit(0).alias("_late"), "_site", F.col("_pos").alias("pos"), F.col("map_id").alias("old_id"), "old_site")
    last = turned.where(F.col("missed_offset").isNotNull()).groupBy("new_id", "new_length", "member", "missed_offset").agg(F.max("_pos").alias("_last"))
    missed = last.select("new_id", "new_length", "member", F.lit(1).alias("_late"), F.lit(0).alias("_site"), (F.col("_last") + F.col("missed_offset") + 1).alias("pos"), F.lit(None).cast("long").alias("old_id"), F.lit(None).cast(kept.schema["old_site"].dataType).alias("old_site"))
    rows, whole = kept.unionByName(missed), Window.partitionBy("new_id")
    return rows.select(F.col("new_id").alias("map_id"), F.count(F.lit(1)).over(whole).alias("num_sites"), F.row_number().over(whole.orderBy("member", "_late", "_site")).alias("site_id"), "pos", F.col("new_length").alias("map_length"), "old_id", "old_site")


def apply_merges(members: DataFrame, map_labels: DataFrame, merged: DataFrame | None = None) -> DataFrame:
    """All maps after merging: the merged ones (``merged``, if ``merge_maps`` is at hand) and, unchanged, those that no group
    has."""
    used = members.select("map_id").distinct()
    columns = ["map_id", "num_sites", "site_id", "pos", "map_length"]
    merged = merge_maps(members, map_labels) if merged is None else merged
    return merged.select(*columns).unionByName(map_labels.join(used, "map_id", "left_anti").select(*columns))


def lift_alignments(alignments: DataFrame, members: DataFrame) -> DataFrame:
    """Alignments after merging: a merged map runs from its first member's start to its last one's end, forwards, with
    the members' confidences summed; others are unchanged."""
    ends = members.join(alignments.withColumnRenamed("qry_id", "map_id").drop("orientation"), ["ref_id", "map_id"])
    place = lambda p: F.col("shift") + F.when(F.col("orientation") == "+", F.col(p)).otherwise(F.col("map_length") - F.col(p))
    ends = ends.withColumn("_start", place("qry_start")).withColumn("_end", place("qry_end"))
    merged = ends.groupBy("new_id", "ref_id").agg(F.min_by("ref_start", "member").alias("ref_start"), F.max_by("ref_end", "member").alias("ref_end"), F.min_by("_start", "member").alias("qry_start"), F.max_by("_end", "member").alias("qry_end"), F.sum("confidence").alias("confidence"))
    merged = merged.select(F.col("new_id").alias("qry_id"), "ref_id", F.lit("+").alias("orientation"), "confidence", "ref_start", "ref_end", "qry_start", "qry_end")
    used = members.select(F.col("map_id").alias("qry_id")).distinct()
    return merged.unionByName(alignments.join(used, "qry_id", "left_anti").select(*merged.columns))


def merged_ratios(members: DataFrame, ratios: DataFrame) -> DataFrame:
    """map_id, start_ratio, end_ratio of the merged maps: the ratios of their outer ends, 0 where a map has none."""
    sides = members.join(ratios, "map_id", "left").na.fill(0.0, ["start_ratio", "end_ratio"])
    forward = F.col("orientation") == "+"
    start, end = F.when(forward, F.col("start_ratio")).otherwise(F.col("end_ratio")), F.when(forward, F.col("end_ratio")).otherwise(F.col("start_ratio"))
    return sides.groupBy("new_id").agg(F.min_by(start, "member").alias("start_ratio"), F.max_by(end, "member").alias("end_ratio")).withColumnRenamed("new_id", "map_id")


def label_lift(merged: DataFrame, map_labels: DataFrame) -> DataFrame:
    """old_id, old_site, new_id, new_site: where each label of ``map_labels`` lies after a merge, from the labels ``merged`` of
    ``merge_maps``. Maps that are not merged stay; labels that were trimmed are left out; a map merged on two references
    has its labels on both merged maps."""
    moved = merged.where("old_id is not null").select("old_id", "old_site", F.col("map_id").alias("new_id"), F.col("site_id").alias("new_site"))
    used = moved.select(F.col("old_id").alias("map_id")).distinct()
    stay = map_labels.join(used, "map_id", "left_anti").select(F.col("map_id").alias("old_id"), F.col("site_id").alias("old_site"), F.col("map_id").alias("new_id"), F.col("site_id").alias("new_site"))
    return moved.unionByName(stay)


def chain_lifts(first: DataFrame, second: DataFrame) -> DataFrame:
    """The label lift of two rounds, from those of each."""
    on = second.toDF("new_id", "new_site", "_id", "_site")
    return first.join(on, ["new_id", "new_site"]).select("old_id", "old_site", F.col("_id").alias("new_id"), F.col("_site").alias("new_site"))


def lift_pairs(pairs: DataFrame, lift: DataFrame) -> DataFrame:
    """``pairs`` (map_id, map_site and others) of aligned labels with the maps and labels that ``lift`` makes of them."""
    own = [c for c in pairs.columns if c not in ("map_id", "map_site")]
    moved = pairs.join(lift.toDF("map_id", "map_site", "_id", "_site"), ["map_id", "map_site"])
    return moved.select(*own, F.col("_id").alias("map_id"), F.col("_site").alias("map_site"))


def lift_merged(pairs: DataFrame, members: DataFrame, merged: DataFrame) -> DataFrame:
    """``lift_pairs`` for one round of merging, from its ``lineage`` and the labels of ``merge_maps``: labels of maps that no
    group has stay as they are and are not joined to a lift; those that were trimmed are left out."""
    moved = merged.where("old_id is not null").select(F.col("old_id").alias("map_id"), F.col("old_site").alias("map_site"), F.col("map_id").alias("_id"), F.col("site_id").alias("_site"))
    own = [c for c in pairs.columns if c not in ("map_id", "map_site")]
    lifted = pairs.join(moved, ["map_id", "map_site"]).select(*own, F.col("_id").alias("map_id"), F.col("_site").alias("map_site"))
    stay = pairs.join(members.select("map_id").distinct(), "map_id", "left_anti")
    return lifted.unionByName(stay.select(*own, "map_id", "map_site"))


def joined_molecules(pairs: DataFrame, lift: DataFrame) -> DataFrame:
    """map_id, mol_id, entry, labels of molecules on merged maps: ``pairs`` (mol_id, map_id, map_site) lifted. A molecule that
    spanned two maps which are one now has one alignment with the labels of both."""
    moved = lift_pairs(pairs.select("mol_id", "map_id", "map_site"), lift)
    return moved.groupBy("map_id", "mol_id").agg(F.array_sort(F.collect_set(F.col("map_site").cast("int"))).alias("labels")).withColumn("entry", F.col("mol_id"))


def break_maps(map_labels: DataFrame, breakpoints: DataFrame, min_length: int, min_labels: int = 2) -> DataFrame:
    """Maps cut at ``breakpoints`` (map_id, breakpoint): map_id, num_sites, site_id, pos, map_length of the pieces, with
    of_map and piece, the map each comes from and its number there from 0.

    Positions count from the break before a piece. Pieces shorter than ``min_length`` or with fewer than ``min_labels``
    labels are dropped. The first piece keeps its map's id; ids of others are dealt out above the greatest one, in the
    order of map and piece. Labels and breaks of a map go through one sort.
    """
    cuts = breakpoints.distinct()
    rows = map_labels.select("map_id", "pos", "map_length", F.lit(0).alias("_break")).unionByName(
        cuts.join(map_labels.select("map_id", "map_length").distinct(), "map_id").select("map_id", F.col("breakpoint").alias("pos"), "map_length", F.lit(1).alias("_break"))
    )
    along = Window.partitionBy("map_id").orderBy("pos", "_break").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = Window.partitionBy("map_id").orderBy(F.desc("pos"), F.desc("_break")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut_at = F.when(F.col("_break") == 1, F.col("pos"))
    placed = rows.withColumn("piece", F.sum("_break").over(along)).withColumn("_from", F.coalesce(F.last(cut_at, ignorenulls=True).over(along), F.lit(0)))
    placed = placed.withColumn("_to", F.coalesce(F.last(cut_at, ignorenulls=True).over(behind), F.col("map_length"))).where("_break = 0")
    one = Window.partitionBy("map_id", "piece")
    counted = placed.withColumn("num_sites", F.count(F.lit(1)).over(one)).withColumn("site_id", F.row_number().over(one.orderBy("pos"))).withColumn("_length", F.col("_to") - F.col("_from"))
    kept = written(counted.where((F.col("_length") >= min_length) & (F.col("num_sites") >= min_labels)).select(F.col("map_id").alias("of_map"), "piece", "num_sites", "site_id", (F.col("pos") - F.col("_from")).alias("pos"), F.col("_length").alias("map_length")), "pieces")
    greatest = map_labels.agg(F.max("map_id").alias("_greatest"))  # one row
    ids = numbered(kept.where("piece > 0 and site_id = 1").select("of_map", "piece"), "of_map", "piece").join(F.broadcast(greatest)).select("of_map", "piece", (F.col("_greatest") + F.col("number")).alias("_id"))
    return kept.join(ids, ["of_map", "piece"], "left").select(F.coalesce("_id", "of_map").cast("long").alias("map_id"), "num_sites", "site_id", "pos", "map_length", "of_map", F.col("piece").cast("int").alias("piece"))


def reduce_resolution(labels: DataFrame, limit: int, on: str = "ref_id", segment: int | None = None) -> DataFrame:
    """``labels`` (``on``, pos) with every run of labels closer than ``limit`` to the one before made one, at their mean
    position, and numbered anew. A task has a ``segment`` of a reference, 1000 times ``limit`` if not given."""
    segment = segment or 1000 * limit
    before = with_running(labels.select(on, "pos"), on, ["pos"], "pos", segment, "_last", "max", own=False)
    near = F.when(F.col("pos") - F.col("_last") < limit, 1).otherwise(0)
    runs = with_running(before.select(on, "pos", near.alias("_near"), (1 - near).alias("_new")), on, ["pos", "_near"], "_new", segment, "_run")
    means = runs.groupBy(on, "_run").agg(F.round(F.avg("pos")).cast("long").alias("pos"), F.count(F.lit(1)).alias("labels"))
    return means.select(on, F.col("_run").cast("long").alias("site_id"), "pos", "labels")


def unaligned_maps(map_labels: DataFrame, alignments: DataFrame) -> DataFrame:
    """map_id of maps that no alignment names."""
    return map_labels.select("map_id").distinct().join(alignments.select(F.col("qry_id").alias("map_id")), "map_id", "left_anti")


def merged_map_sets(*sets: DataFrame) -> DataFrame:
    """Labels of several map sets in one; their ids must differ."""
    out = sets[0]
    for x in sets[1:]:
        out = out.unionByName(x)
    return out


def by_reference(alignments: DataFrame, map_labels: DataFrame) -> DataFrame:
    """``map_labels`` with the references that their maps align to, for a write that is partitioned by reference."""
    return map_labels.join(alignments.select(F.col("qry_id").alias("map_id"), "ref_id").distinct(), "map_id")


def map_summary(map_labels: DataFrame, unit: int = 100_000) -> DataFrame:
    """maps, total_length, mean_length, min_length, max_length, n50, labels_per_unit of a map set, in one row.

    N50 is the length at which the longest maps make up half of the total. Lengths are summed in classes, of which there
    are about a thousand whatever the number of maps; the class in which the half is reached is known from their sums, and
    only it is looked at length by length, in as many classes again, until a class is one length.
    """
    maps = written(map_labels.groupBy("map_id").agg(F.max("map_length").cast("long").alias("length"), F.count(F.lit(1)).alias("labels")), "map-lengths")
    sums = maps.agg(F.count(F.lit(1)).alias("maps"), F.sum("length").alias("total_length"), F.round(F.avg("length"), 1).alias("mean_length"), F.min("length").alias("min_length"), F.max("length").alias("max_length"), F.round(F.sum("labels") * float(unit) / F.sum("length"), 3).alias("labels_per_unit"))
    return sums.join(F.broadcast(weighted_median(maps, "length").select(F.col("length").alias("n50"))))  # one row each


def weighted_median(rows: DataFrame, column: str, classes: int = 1024) -> DataFrame:
    """The greatest value of ``column``, a whole number, such that those no less make up half of its sum, in one row."""
    low, high, total = rows.agg(F.min(column), F.max(column), F.sum(column)).first()
    above = 0
    while low is not None and low < high:
        width = -(-(high - low + 1) // classes)
        held = rows.where(F.col(column).between(low, high)).groupBy(F.floor((F.col(column) - low) / width).alias("k")).agg(F.sum(column).alias("s")).collect()  # at most ``classes`` rows
        for r in sorted(held, key=lambda r: -r["k"]):
            if 2 * (above + r["s"]) >= total:
                low, high = low + r["k"] * width, min(high, low + (r["k"] + 1) * width - 1)
                break
            above += r["s"]
    return rows.sparkSession.range(1).select(F.lit(low).cast("long").alias(column))


def run_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table, records: how many rows each of the named ``tables`` has."""
    counts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table"), "records") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def alignment_summary(alignments: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """ref_id, maps, aligned_length, mean_confidence, covered: of each reference; covered is the length of the union of
    its alignments. A task has a ``segment`` of a reference."""
    each = with_running(alignments, "ref_id", ["ref_start", "ref_end"], "ref_end", segment, "_before", "max", own=False)
    new = F.greatest(F.lit(0), F.col("ref_end") - F.greatest(F.col("ref_start"), F.coalesce("_before", "ref_start")))
    each = each.withColumn("_new", new)
    return each.groupBy("ref_id").agg(F.countDistinct("qry_id").alias("maps"), F.sum(F.col("ref_end") - F.col("ref_start")).alias("aligned_length"), F.round(F.sum(F.col("confidence").cast("decimal(18,4)")).cast("double") / F.count("confidence"), 2).alias("mean_confidence"), F.sum("_new").alias("covered"))
