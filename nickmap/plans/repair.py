"""The whole repair: predict sites, stitch maps over them, score the stitches, undo weak ones, validate the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nickmap.operators import evidence, intervals, mapops, sequence, sites, stitch
from nickmap.sources.shared import written


@dataclass
class Stitched:
    """Results of ``stitch_rounds``: maps and alignments after all rounds; stitches (ref_id, start_pos, end_pos, site_type) with
    the map that holds each and the labels there on either side, left_label and right_label (0 if trimmed away); the label
    lift from the first maps to the last ones; and the lineage of all rounds, with generation from 1."""

    maps: DataFrame
    alignments: DataFrame
    stitches: DataFrame
    lift: DataFrame
    lineage: DataFrame


@dataclass
class Repaired:
    """Results of ``repair``: maps after all steps, alignments of the stitched maps, stitches with scores, broken ones and
    their evidence, statistics of the stitches by type, and the lineage of the stitched maps."""

    maps: DataFrame
    alignments: DataFrame
    stitches: DataFrame
    statistics: DataFrame
    lineage: DataFrame


STITCHES = "ref_id long, start_pos long, end_pos long, site_type string, map_id long, left_label long, right_label long"
LINEAGE = "generation int, new_id long, name long, ref_id long, member int, map_id long, orientation string, shift double, new_length double"


def _moved(stitches: DataFrame, members: DataFrame, merged: DataFrame) -> DataFrame:
    """``stitches`` with the maps and labels that a merge makes of theirs."""
    new = members.select("ref_id", "map_id", "new_id")
    at = lambda label, name: merged.select(F.col("old_id").alias("map_id"), F.col("old_site").alias(label), F.col("map_id").alias("new_id"), F.col("site_id").alias(name))
    joined = stitches.join(new, ["ref_id", "map_id"], "left").join(at("left_label", "_left"), ["map_id", "left_label", "new_id"], "left").join(at("right_label", "_right"), ["map_id", "right_label", "new_id"], "left")
    label = lambda c, moved: F.when(F.col("new_id").isNull(), F.col(c)).otherwise(F.coalesce(moved, F.lit(0))).cast("long").alias(c)
    return joined.select("ref_id", "start_pos", "end_pos", "site_type", F.coalesce("new_id", "map_id").alias("map_id"), label("left_label", "_left"), label("right_label", "_right"))


def _new_stitches(plan: DataFrame, members: DataFrame, merged: DataFrame) -> DataFrame:
    ends = merged.where("old_id is not null").groupBy("map_id", "old_id").agg(F.min("site_id").alias("_min"), F.max("site_id").alias("_max"))
    placed = stitch.stitch_positions(plan, "first_id", "second_id").join(members.where("member = 1").select("ref_id", F.col("map_id").alias("first_id"), F.col("new_id").alias("map_id")), ["ref_id", "first_id"])
    left, right = ends.select("map_id", F.col("old_id").alias("first_id"), F.col("_max").alias("left_label")), ends.select("map_id", F.col("old_id").alias("second_id"), F.col("_min").alias("right_label"))
    joined = placed.join(left, ["map_id", "first_id"], "left").join(right, ["map_id", "second_id"], "left")
    return joined.select("ref_id", "start_pos", "end_pos", "site_type", "map_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("left_label", "right_label")])


def stitch_rounds(alignments: DataFrame, map_labels: DataFrame, ref_labels: DataFrame, limits: stitch.Limits, found: DataFrame, ratios: DataFrame | None, rounds: int = 6, width: int = 50_000) -> Stitched:
    """At most ``rounds`` rounds of pairwise merging, each on the last one's lifted alignments; ends when no pair qualifies.
    With no pair at all the inputs come back unchanged. Each round's new ids are above all ids before it."""
    spark = map_labels.sparkSession
    stitches, lineages = spark.createDataFrame([], STITCHES), spark.createDataFrame([], LINEAGE)
    lift = map_labels.select(F.col("map_id").alias("old_id"), F.col("site_id").alias("old_site"), F.col("map_id").alias("new_id"), F.col("site_id").alias("new_site"))
    for generation in range(1, rounds + 1):
        plan = written(stitch.stitch_plan(alignments, map_labels, ref_labels, limits, found, ratios, width), "plan")
        if plan.isEmpty():
            break
        members = mapops.lineage(mapops.pairwise_groups(plan), map_labels)
        merged = written(mapops.merge_maps(members, map_labels), "merged")
        stitches = written(_moved(stitches, members, merged).unionByName(_new_stitches(plan, members, merged)), "stitches")
        lift = written(mapops.chain_lifts(lift, mapops.label_lift(merged, map_labels)), "lift")
        typed = members.withColumn("generation", F.lit(generation))
        lineages = lineages.unionByName(typed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in lineages.schema]))
        alignments = written(mapops.lift_alignments(alignments, members), "alignments")
        map_labels = written(mapops.apply_merges(members, map_labels, merged), "maps")
        if ratios is not None:
            ratios = written(ratios.unionByName(mapops.merged_ratios(members, ratios)), "ratios")
    return Stitched(map_labels, alignments, stitches, lift, lineages)


def repair(alignments: DataFrame, map_labels: DataFrame, ref_labels: DataFrame, nicks: DataFrame, molecules: DataFrame, reads: DataFrame, limits: stitch.Limits, ratios: DataFrame | None = None, gaps: tuple[int, int] = (1000, 100), buffer: int = 500, threshold: float = 1.0, min_piece: int = 30_000, width: int = 50_000, map_molecules: DataFrame | None = None, alike: DataFrame | None = None) -> Repaired:
    """Repairs ``map_labels`` with ``alignments`` to the reference ``ref_labels``.

    ``nicks`` (ref_id, pos, strand) give the sites; ``molecules`` (ref_id, mol_id, entry, labels) are alignments of single
    molecules to reference labels, ``reads`` (ref_id, read_id, read_start, read_end, mapq) aligned reads. With
    ``map_molecules`` (mol_id, map_id, map_site: labels of the maps that molecules align to) stitches are scored on the
    merged maps instead: the molecules' labels are lifted, and a molecule on two maps that are one now spans the stitch
    between them. A mol_id can stand for molecules that cover the same labels; ``alike`` (mol_id, molecules) then tells how
    many they are.
    """
    found = written(sites.classify_sites(nicks, *gaps, aggressive=True), "sites")
    done = stitch_rounds(alignments, map_labels, ref_labels, limits, found, ratios, width=width)
    maps, lifted = done.maps, done.alignments
    keyed = written(done.stitches.withColumn("site_key", F.concat_ws("/", "ref_id", "start_pos", "end_pos")), "stitches")
    if map_molecules is None:
        flanked = written(evidence.flanking_labels(keyed, ref_labels, segment=limits.segment), "flanked")
        last = ref_labels.groupBy("ref_id").agg(F.max("site_id").cast("int").alias("last_label"))
        placed = flanked.join(last, "ref_id").select("site_key", F.col("ref_id").alias("map_id"), F.col("start_label").alias("map_start"), F.col("end_label").alias("map_end"), F.lit(1).alias("first_label"), "last_label")
        spans = molecules.select(F.col("ref_id").alias("map_id"), "mol_id", "entry", "labels")
    else:
        last = maps.groupBy("map_id").agg(F.max("site_id").cast("int").alias("last_label"))
        placed = keyed.join(last, "map_id").select("site_key", "map_id", F.col("left_label").cast("int").alias("map_start"), F.col("right_label").cast("int").alias("map_end"), F.lit(1).alias("first_label"), "last_label")
        spans = written(mapops.joined_molecules(map_molecules, done.lift), "joined-molecules")
    support = evidence.molecule_support(placed, spans)
    support = support if alike is None else support.join(alike, "mol_id")
    scored = evidence.site_scores(keyed, support, intervals.read_support(keyed, reads, buffer, width=width))
    split = written(evidence.threshold_split(scored, threshold).join(keyed, "site_key"), "scored")
    # Where a weak stitch lies on its merged map: the alignment is forwards, so by its distance from the map's start.
    holds = lifted.select("ref_id", F.col("qry_id").alias("map_id"), F.col("ref_start").alias("a0"), F.col("ref_end").alias("a1"), "qry_start")
    weak = split.where("broken").select("ref_id", "site_key", F.col("map_id").alias("of"), F.col("start_pos").alias("s0"), F.col("end_pos").alias("s1"))
    held = intervals.containment_join(holds, weak, ["ref_id"], ("a0", "a1"), ("s0", "s1"), width).where("map_id = of")
    cuts = written(held.select("map_id", (F.col("qry_start") + (F.col("s0") + F.col("s1")) / 2 - F.col("a0")).cast("long").alias("breakpoint")), "cuts")
    broken = mapops.break_maps(maps, cuts, min_piece)
    # Maps without a cut stay whatever their size.
    pieces = broken.join(cuts.select(F.col("map_id").alias("of_map")).distinct(), "of_map", "left_semi").select(*maps.columns)
    whole = maps.join(cuts.select("map_id").distinct(), "map_id", "left_anti").select(*maps.columns)
    spans = alignments.join(ref_labels.groupBy("ref_id").agg(F.max("pos").alias("ref_length")), "ref_id").select("ref_id", "ref_start", "ref_end", "ref_length")
    validated = intervals.validate_sites(split.where("not broken").select("site_key", "ref_id", "start_pos", "end_pos"), reads, spans, width=width).select("site_key", "evidence")
    stitched = split.join(validated, "site_key", "left")
    return Repaired(whole.unionByName(pieces), lifted, stitched, sites.site_statistics(stitched), done.lineage)


def digested(chunks: DataFrame, motifs: list[str], partners: list[str]) -> tuple[DataFrame, DataFrame]:
    """Nicks (ref_id, pos, strand) and reference labels (ref_id, site_id, pos) of sequences in ``chunks``, whose ids are
    those of the references, for ``motifs`` and their reverse complements ``partners``; both as written tables."""
    nicks = sequence.nick_sites(chunks, motifs, partners).select(F.col("seq_id").alias("ref_id"), F.col("pos").cast("long").alias("pos"), "strand")
    labels = sequence.digest(chunks, [list(dict.fromkeys(motifs + partners))])
    labels = labels.select(F.col("cmap_id").alias("ref_id"), F.col("site_id").cast("long").alias("site_id"), F.col("position").cast("long").alias("pos"))
    return written(nicks, "nicks"), written(labels, "ref-labels")


def map_end_ratios(pairs: DataFrame, map_labels: DataFrame, min_occurrence: int = 10) -> DataFrame:
    """map_id, start_ratio, end_ratio of all maps by their molecules: ``pairs`` (mol_id, map_id, map_site, mol_site,
    mol_sites) are aligned labels. A label occurs as often as molecules are aligned to it; maps without any have ratio 0."""
    return evidence.molecule_end_ratios(pairs, map_labels, min_occurrence)


def repair_sequences(chunks: DataFrame, motifs: list[str], partners: list[str], alignments: DataFrame, map_labels: DataFrame, molecules: DataFrame, reads: DataFrame, limits: stitch.Limits, map_molecules: DataFrame | None = None, **options) -> Repaired:
    """``repair`` from the bases on: sites and reference labels are those of ``digested``, end ratios those of
    ``map_end_ratios`` for ``map_molecules`` if given (without, no site is taken as observed), and with those stitches are
    scored on the merged maps. ``alignments`` and ``molecules`` refer to the digest's labels; ``options`` are those of
    ``repair``."""
    nicks, labels = digested(chunks, motifs, partners)
    ratios = None if map_molecules is None else written(map_end_ratios(map_molecules, map_labels), "end-ratios")
    return repair(alignments, map_labels, labels, nicks, molecules, reads, limits, ratios, map_molecules=map_molecules, **options)
