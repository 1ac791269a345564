"""Sequences in chunks, motif scans, digests into label maps and their composition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nickmap.functions.scalars import letter_count, percent, reverse_complement
from nickmap.operators.ranges import with_place
from nickmap.sources.shared import written


def chunked(sequences: DataFrame, size: int = 65_536, overlap: int = 64) -> DataFrame:
    """seq_id, length, chunk_start (0-based), chunk_end, bases: each sequence (seq_id, bases) in chunks of ``size`` that
    run on for ``overlap`` bases into the next, so that whatever starts in a chunk and is no longer lies in it whole."""
    n = F.length("bases")
    starts = F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size)))
    parts = sequences.select("seq_id", n.cast("long").alias("length"), "bases", starts.alias("chunk_start"))
    return parts.select("seq_id", "length", F.col("chunk_start").cast("long"), F.least(F.col("chunk_start") + size, F.col("length")).cast("long").alias("chunk_end"), F.substring(F.col("bases"), F.col("chunk_start") + 1, F.lit(size + overlap)).alias("bases"))


def occurrences(text: Column, motif: str) -> Column:
    """Array of 0-based places where ``motif`` occurs, overlaps included.

    The text is cut before each occurrence; places are running sums of the lengths. A letter in front keeps a cut at the
    very start.
    """
    pieces = F.split(F.concat(F.lit("#"), text), f"(?=\\Q{motif}\\E)", -1)
    ahead = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(1)))
    none = F.struct(F.lit(-1).alias("at"), F.array().cast("array<int>").alias("found"))
    step = lambda s, x: F.struct((s["at"] + F.length(x)).alias("at"), F.concat(s["found"], F.array(s["at"] + F.length(x))).alias("found"))
    return F.when(F.size(pieces) > 1, F.aggregate(ahead, none, step)["found"]).otherwise(F.array().cast("array<int>"))


def motif_hits(chunks: DataFrame, motifs: list[tuple[str, int, bool]], stretch: int = 4096) -> DataFrame:
    """seq_id, length, pos, strand, step: places of ``motifs`` (motif, strand, whether the nick lies behind it) in
    ``chunks``; step is the motif's place in the list. All motifs are found in one pass over the bases.

    Chunks are searched by stretches of ``stretch`` bases, as gathering the places of one text takes the square of their
    number.
    """
    reach = max(len(motif) for motif, _, _ in motifs) - 1
    chunks = chunks.withColumn("skip", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("chunk_end") - F.col("chunk_start") - 1, F.lit(0)), F.lit(stretch).cast("long"))))
    chunks = chunks.select("seq_id", "length", (F.col("chunk_start") + F.col("skip")).alias("chunk_start"), F.least(F.col("chunk_start") + F.col("skip") + stretch, "chunk_end").alias("chunk_end"), F.substring(F.col("bases"), (F.col("skip") + 1).cast("int"), F.lit(stretch + reach)).alias("bases"))
    own = F.col("chunk_end") - F.col("chunk_start")

    def found(motif: str, strand: int, behind: bool, step: int) -> Column:
        hit = lambda p: F.struct((F.col("chunk_start") + p).alias("at"), F.lit(len(motif)).alias("size"), F.lit(len(motif) if behind else 0).alias("behind"), F.lit(strand).alias("strand"), F.lit(step).alias("step"))
        return F.transform(F.filter(occurrences(F.col("bases"), motif), lambda p: p < own), hit)

    each = [found(*motif, step) for step, motif in enumerate(motifs)]
    hits = chunks.select("seq_id", "length", F.explode(reduce(F.concat, each[1:], each[0])).alias("hit"))
    return hits.select("seq_id", "length", F.col("hit.at").alias("at"), F.col("hit.size").alias("size"), (F.col("hit.at") + F.col("hit.behind")).alias("pos"), F.col("hit.strand").alias("strand"), F.col("hit.step").alias("step"))


def nick_sites(chunks: DataFrame, motifs: list[str], reversed_complements: list[str]) -> DataFrame:
    """seq_id, pos, strand: nicks of motifs (strand 1, before the motif) and of their reverse complements (-1, behind it).

    A motif that touches the sequence's end is left out. Where several fall on one place the last in scanning order
    counts: motif by motif, forward before reverse complement.
    """
    order = [x for m, r in zip(motifs, reversed_complements, strict=True) for x in ((m, 1, False), (r, -1, True))]
    hits = motif_hits(chunks, order).where(F.col("at") + F.col("size") < F.col("length"))
    return hits.groupBy("seq_id", "pos").agg(F.max_by("strand", "step").alias("strand"))


def nick_sites_four_way(chunks: DataFrame, motifs: list[tuple[str, str, str, str]]) -> DataFrame:
    """seq_id, pos, strand from motifs in all orientations, each given as (forward, reverse, reverse complement,
    complement) with strands 1, 2, -1 and -2; reverse and reverse complement nick behind the motif. A place hit more than
    once has strand 3."""
    order = [x for f, r, rc, c in motifs for x in ((f, 1, False), (r, 2, True), (rc, -1, True), (c, -2, False))]
    hits = motif_hits(chunks, order).where(F.col("at") + F.col("size") < F.col("length"))
    return hits.groupBy("seq_id", "pos").agg(F.when(F.count(F.lit(1)) > 1, 3).otherwise(F.max("strand")).alias("strand"))


def digest(chunks: DataFrame, channels: list[list[str]], segment: int = 1_000_000) -> DataFrame:
    """cmap_id, contig_length, num_sites, site_id, channel, position: labels at the 1-based start of each motif of each
    channel (motif and reverse complement), one for a position and channel, numbered along the sequence; channels at one
    position keep their order. A task numbers a ``segment`` of a sequence. Terminal rows: see ``with_terminal_rows``.

    Hits are written, as numbering and what comes after it read them several times, and the bases are searched once.
    """
    order = [(m, k, False) for k, motifs in enumerate(channels, 1) for m in motifs]
    hits = motif_hits(chunks, order).groupBy("seq_id", "length", (F.col("at") + 1).alias("position"), F.col("strand").alias("channel")).agg(F.min("step").alias("step"))
    placed = with_place(written(hits, "hits"), "seq_id", ["position", "step"], segment, "site_id", "num_sites")
    return placed.select(F.col("seq_id").alias("cmap_id"), F.col("length").alias("contig_length"), "num_sites", F.col("site_id").cast("int").alias("site_id"), "channel", "position")


def with_terminal_rows(labels: DataFrame, maps: DataFrame) -> DataFrame:
    """``labels`` of ``digest`` with standard deviation, coverage and occurrence, and for each of ``maps`` (cmap_id,
    contig_length) a row of channel 0 at its end; maps without labels have that row alone."""
    rows = labels.select("*", F.lit(1.0).alias("stddev"), F.lit(1.0).alias("coverage"), F.lit(1.0).alias("occurrence"))
    counted = maps.select("cmap_id", "contig_length").join(labels.groupBy("cmap_id").agg(F.count(F.lit(1)).alias("n")), "cmap_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ends = counted.select("cmap_id", "contig_length", F.col("n").alias("num_sites"), (F.col("n") + 1).cast("int").alias("site_id"), F.lit(0).alias("channel"), F.col("contig_length").alias("position"), F.lit(0.0).alias("stddev"), F.lit(1.0).alias("coverage"), F.lit(0.0).alias("occurrence"))
    return rows.unionByName(ends)


def filter_maps(labels: DataFrame, maps: DataFrame, min_labels: int = 0, min_length: int = 0) -> DataFrame:
    """cmap_id, contig_length, labelled_positions of ``maps`` with at least so many distinct labelled positions and bases;
    ids stay as they are."""
    counts = labels.groupBy("cmap_id").agg(F.countDistinct("position").alias("n"))
    counted = maps.select("cmap_id", "contig_length").join(counts, "cmap_id", "left").select("cmap_id", "contig_length", F.coalesce("n", F.lit(0)).alias("labelled_positions"))
    return counted.where((F.col("labelled_positions") >= min_labels) & (F.col("contig_length") >= min_length))


def label_density(labels: DataFrame, maps: DataFrame) -> DataFrame:
    """cmap_id, channel, labels, per_100kb: labels of each map and channel, and of all maps (null id) by channel."""
    lengths = maps.select("cmap_id", "contig_length")
    all_length = lengths.agg(F.sum("contig_length").alias("all_length"))
    counts = labels.select("cmap_id", "channel").rollup("channel", "cmap_id").agg(F.count(F.lit(1)).alias("labels")).where("channel is not null")
    joined = counts.join(lengths, "cmap_id", "left").join(F.broadcast(all_length))  # one row
    return joined.select("cmap_id", "channel", "labels", F.round(F.col("labels") * 100_000 / F.coalesce("contig_length", "all_length"), 3).alias("per_100kb"))


def seeded_motifs(spark: SparkSession, n: int, length: int, seed: int = 0) -> DataFrame:
    """motif_id from 0, motif: ``n`` random motifs of A, C, G and T (at most 32 long), told by digests of seed and number."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    return spark.range(n).select(F.col("id").alias("motif_id"), F.translate(F.substring(digest, 1, length), "0123456789abcdef", "ACGT" * 4).alias("motif"))


#: Runs of up to SHORT bases are counted by words of TOGETHER of them, of which there can be 4 ** (SHORT + TOGETHER - 1).
SHORT, TOGETHER = 6, 4


def motif_null_model(chunks: DataFrame, motifs: DataFrame, stretch: int = 256) -> DataFrame:
    """motif_id, motif, observed, expected of many ``motifs`` (motif_id, motif) of A, C, G and T: how often each or its
    reverse complement starts in the sequences of ``chunks``, and how often it would by the letters' frequencies alone.

    All motifs are searched in one pass: the runs of bases of the motifs' lengths at each place are counted within tasks,
    and their counts are joined to the motifs by equality. A motif that is its own reverse complement counts once a place.
    Runs are taken from stretches of ``stretch`` bases, cut in two steps, as reaching into a text takes the longer the
    further it is; short ones by words that hold several places' runs, which are taken apart once they are counted. Longer
    ones have a place each, and only those of motifs are counted.
    """
    turned = reverse_complement(F.col("motif"))
    both = motifs.select("motif_id", "motif", F.explode(F.array_distinct(F.array(F.col("motif"), turned))).alias("run"))
    sizes = motifs.agg(F.collect_set(F.length("motif")).alias("sizes"))  # one row, no more entries than a motif is long
    parts = chunks.join(F.broadcast(sizes)).select("sizes", "bases", (F.col("chunk_end") - F.col("chunk_start")).alias("own"))
    for width in (16 * stretch, stretch):
        skips = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("own") - 1, F.lit(0)), F.lit(width).cast("long"))
        piece = F.substring(F.col("bases"), (F.col("skip") + 1).cast("int"), (width + F.array_max("sizes") - 1).cast("int"))
        parts = parts.withColumn("skip", F.explode(skips)).select("sizes", F.least(F.col("own") - F.col("skip"), F.lit(width)).alias("own"), piece.alias("bases"))
    parts = parts.withColumn("held", F.length("bases"))  # once a stretch, not for each of its words
    places = lambda n: F.least("own", F.col("held") - n + 1).cast("int")
    step = lambda n: F.when(n <= SHORT, TOGETHER).otherwise(1)
    word = lambda n, i: F.struct(n.alias("run_size"), F.substring(F.col("bases"), i, F.least(step(n), places(n) - i + 1) + n - 1).alias("word"))
    none = F.array().cast("array<struct<run_size:int,word:string>>")
    words = F.flatten(F.transform("sizes", lambda n: F.when(places(n) > 0, F.transform(F.sequence(F.lit(1), places(n), step(n)), lambda i: word(n, i))).otherwise(none)))
    known = both.select("run").distinct()
    words = parts.select(F.explode(words).alias("x")).select("x.*").join(known.select(F.col("run").alias("word"), F.lit(True).alias("is_run")), "word", "left")
    counted = words.where(F.col("is_run") | (F.col("run_size") <= SHORT)).groupBy("run_size", "word").agg(F.count(F.lit(1)).alias("words"))
    apart = F.transform(F.sequence(F.lit(1), F.length("word") - F.col("run_size") + 1), lambda i: F.substring(F.col("word"), i, F.col("run_size")))
    counts = counted.select("words", F.explode(apart).alias("run")).join(known, "run", "left_semi").groupBy("run").agg(F.sum("words").alias("n"))
    observed = both.join(counts, "run", "left").groupBy("motif_id", "motif").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("observed"), F.collect_list("run").alias("runs"))
    letters = composition(chunks).where("seq_id is null").select(*"acgtn")
    lengths = chunks.where("chunk_start = 0").join(F.broadcast(sizes)).select(F.explode("sizes").alias("size"), "length").groupBy("size").agg(F.sum(F.greatest(F.col("length") - F.col("size") + 1, F.lit(0))).alias("places"))
    total = F.col("a") + F.col("c") + F.col("g") + F.col("t")
    chance = lambda run: F.aggregate(F.split(run, ""), F.lit(1.0), lambda p, x: p * F.when(x == "", 1.0).otherwise(F.element_at(F.create_map(F.lit("A"), F.col("a"), F.lit("C"), F.col("c"), F.lit("G"), F.col("g"), F.lit("T"), F.col("t")), x) / total))
    joined = observed.join(F.broadcast(letters)).join(F.broadcast(lengths), F.length("motif") == F.col("size"))
    return joined.select("motif_id", "motif", "observed", F.round(F.aggregate("runs", F.lit(0.0), lambda s, run: s + chance(run)) * F.col("places"), 3).alias("expected"))


def composition(chunks: DataFrame) -> DataFrame:
    """seq_id, a, c, g, t, n, gc_percent, n_percent of each sequence and, with a null seq_id, of all."""
    own = F.expr("substring(bases, 1, cast(chunk_end - chunk_start as int))")
    letters = chunks.select("seq_id", *[letter_count(F.upper(own), x.upper()).alias(x) for x in "acgtn"])
    sums = letters.rollup("seq_id").agg(*[F.sum(x).alias(x) for x in "acgtn"])
    acgt = F.col("a") + F.col("c") + F.col("g") + F.col("t")
    return sums.select("seq_id", *"acgtn", F.round(percent(F.col("g") + F.col("c"), acgt), 2).alias("gc_percent"), F.round(percent(F.col("n"), acgt + F.col("n")), 2).alias("n_percent"))
