"""Line dedup by a segment-partition edit join, with DataFrame functions only.

A line is cut into threshold + 1 segments; two lines within the threshold share one of them unchanged, at places that
differ by no more than their lengths and the threshold allow. So each line is entered under its own segments and looked
up under the substrings that can be a shorter or equal line's segment. Lines that meet are compared by banded
bit-parallel edit distance, and what is linked, directly or by a chain, is one class.

Lines of a bucket are not compared at once: the same join is applied to what they have besides the shared segment, and again
while a bucket has many lines. Where little is left of the lines of a large bucket, one edit is found by key: what is left
without one character, at its place, is equal for lines that differ in that character. No bucket's lines are paired
unless they are few, and no bucket is one task's work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import likely, table, written
from .components import connected_components

#: Edits between lines of one class, after letter case and outer white space are set aside.
THRESHOLD = 1
#: Shorter lines (headings, bullets) are classed by their exact normal form; the edit join leaves them out.
MIN_CHARS = 20
#: Buckets with more lines are divided further, and where at most about SHORT characters are left of them, joined by key.
BUCKET, SHORT = 32, 8
#: What is set aside at the ends of a line: ASCII white space.
WHITE = " \t\r\x0b\x0c"


def normal_form(line: Column, numbers: bool = False) -> Column:
    """Lower case without outer ASCII white space; with ``numbers``, runs of digits count as one 0."""
    # Trimming of several characters is slow, and few lines need it.
    outer = reduce(lambda p, q: p | q, [line.startswith(c) | line.endswith(c) for c in WHITE])
    line = F.lower(F.when(outer, F.trim(line, F.lit(WHITE))).otherwise(line))
    return F.regexp_replace(line, "[0-9]+", "0") if numbers else line


def lines_of(docs: DataFrame, min_chars: int, numbers: bool = False) -> DataFrame:
    """doc_id, body (hash of the text), line_no, line, key for each line of ``docs`` (doc_id, text). key is the hash of
    the normal form, null for blank lines; line is that form, null for lines under ``min_chars``."""
    each = F.posexplode(F.split("text", "\n")).alias("line_no", "raw")
    lines = docs.select("doc_id", "text", F.xxhash64("text").alias("body")).select("doc_id", "body", each)
    # A column of its own, as Spark would work it out for each use otherwise.
    lines = lines.select("doc_id", "body", "line_no", normal_form(F.col("raw"), numbers).alias("form"))
    line, key = F.when(F.length("form") >= min_chars, F.col("form")), F.when(F.col("form") != "", F.xxhash64("form"))
    return lines.select("doc_id", "body", "line_no", line.alias("line"), key.alias("key"))


def segment_probes(threshold: int) -> list[tuple[int, int, int]]:
    """(how much shorter the other line is, segment from 1, shift of its place): all that a line of the same length or
    the longer of two within the threshold needs to look up; those with 0, any, 0 are its own segments."""
    found = []
    for shorter in range(threshold + 1):
        for i in range(1, threshold + 2):
            behind = threshold + 1 - i
            found += [(shorter, i, shift) for shift in range(max(1 - i, shorter - behind), min(i - 1, shorter + behind) + 1)]
    return found


def signatures(line: Column, n_chars: Column, scope: Column, threshold: int) -> Column:
    """Array of (sig, at, size): hashes under which a line of ``n_chars`` meets others within ``scope``, and the place of
    the substring."""
    parts = threshold + 1

    def one(shorter: int, i: int, shift: int) -> Column:
        length = n_chars - shorter
        short = F.floor(length / parts).cast("int")
        n_short = parts - length % parts
        at = (i - 1) * short + F.greatest(F.lit(0), F.lit(i - 1) - n_short) + shift
        size = short + F.when(F.lit(i) > n_short, 1).otherwise(0)
        sig = F.xxhash64(scope, length, F.lit(i), F.substring(line, at + 1, size))
        return F.when((at >= 0) & (length >= parts), F.struct(sig.alias("sig"), at.alias("at"), size.alias("size")))

    return F.array_compact(F.array(*[one(*x) for x in segment_probes(threshold)]))


def bounded_distance(a: Column, b: Column, threshold: int) -> Column:
    """Edit distance of two strings if at most ``threshold``, else null.

    Row e of the automaton is one whole number: bit ``threshold + d`` tells whether e edits suffice to have read the
    characters of ``b`` so far and d more of ``a``. One step takes a character of ``b`` against the band of ``a`` around
    it. The band's characters come from shifted copies of ``a``, so a step needs no access by place.
    """
    width = 2 * threshold + 1
    mask = (1 << width) - 1
    chars = lambda x: F.filter(F.split(x, ""), lambda c: c != "")
    left, right = chars(a), chars(b)
    shifted = []
    for d in range(-threshold, threshold + 1):
        moved = F.concat(F.array(*[F.lit("")] * -d), left) if d < 0 else F.slice(left, d + 1, F.greatest(F.size(left), F.lit(1)))
        shifted.append(moved.alias(f"a{d + threshold}"))
    steps = F.slice(F.arrays_zip(right.alias("b"), *shifted), 1, F.greatest(F.length(b), F.lit(1)))
    steps = F.when(F.length(b) == 0, F.slice(steps, 1, 0)).otherwise(steps)

    def closed(rows: list[Column]) -> list[Column]:
        """Lets unread characters of ``a`` be passed over at an edit each."""
        for e in range(1, len(rows)):
            rows[e] = rows[e].bitwiseOR(F.shiftleft(rows[e - 1], 1)).bitwiseAND(F.lit(mask))
        return rows

    names = [f"r{e}" for e in range(threshold + 1)]
    pack = lambda rows: F.struct(*[r.cast("long").alias(n) for r, n in zip(rows, names, strict=True)])
    start = pack([F.lit(((1 << e + 1) - 1) << threshold & mask) for e in range(threshold + 1)])

    def step(state: Column, x: Column) -> Column:
        match = reduce(lambda p, q: p + q, [F.when(x[f"a{k}"] == x["b"], F.lit(1 << k)).otherwise(F.lit(0)) for k in range(width)]).cast("long")
        rows = [state["r0"].bitwiseAND(match)]
        for e in range(1, threshold + 1):
            fewer = state[names[e - 1]]
            rows.append(state[names[e]].bitwiseAND(match).bitwiseOR(fewer).bitwiseOR(F.shiftright(fewer, 1)))
        return pack(closed(rows))

    end = F.aggregate(steps, start, step)
    diagonal = F.length(a) - F.length(b) + threshold
    arrived = lambda row: row.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), diagonal)) != 0
    # Within a transform, the automaton runs once a pair, however often its end is looked at.
    distance = F.transform(F.array(end), lambda rows: F.coalesce(*[F.when(arrived(rows[n]), F.lit(e)) for e, n in enumerate(names)]))[0]
    return F.when(F.abs(F.length(a) - F.length(b)) <= threshold, distance)


def _met(rows: DataFrame, size: Column) -> DataFrame:
    """Those of ``rows`` (sig, ...) that are not alone in their bucket, with n, the bucket's rows, and shortest, the least
    ``size`` in it, as a written table. Buckets are counted first, so that joining them to rows can be split."""
    sizes = written(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("shortest")).where("n > 1"), "line-counts")
    return written(likely(rows, "sig", sizes).join(sizes, "sig"), "line-buckets")


def _paired(rows: DataFrame, threshold: int) -> DataFrame:
    """u, v: keys within ``threshold`` edits among the ``rows`` (sig, key, rest) of each small bucket."""
    a = rows.select("sig", F.col("key").alias("u"), F.col("rest").alias("a"))
    b = rows.select("sig", F.col("key").alias("v"), F.col("rest").alias("b"))
    near = bounded_distance(F.col("a"), F.col("b"), threshold).isNotNull()
    return a.join(b, "sig").where((F.col("u") < F.col("v")) & (F.abs(F.length("a") - F.length("b")) <= threshold) & near).select("u", "v")


def _keyed(rows: DataFrame) -> DataFrame:
    """u, v: links that connect what lies within one edit among the ``rows`` (sig, key, rest) of each bucket, however large.

    A rest without its character p, as (p, those left), is equal for rests that differ in that character only; one rest
    stands for all of these. Without it, it may also be another rest as a whole.
    """
    n = F.length("rest")
    without = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda p: F.struct(p.alias("p"), F.concat(F.substring("rest", F.lit(1), p - 1), F.substring("rest", p + 1, n)).alias("left"))))
    whole = F.array(F.struct(F.lit(0).alias("p"), F.col("rest").alias("left"), F.lit(True).alias("heads")))
    changed = F.transform(without, lambda x: F.struct(x["p"].alias("p"), x["left"].alias("left"), F.lit(True).alias("heads")))
    dropped = F.transform(without, lambda x: F.struct(F.lit(0).alias("p"), x["left"].alias("left"), F.lit(False).alias("heads")))
    none = F.array().cast("array<struct<p:int,left:string,heads:boolean>>")
    ways = rows.select("sig", "key", "rest", F.explode(F.concat(whole, F.coalesce(changed, none), F.coalesce(dropped, none))).alias("way"))
    ways = ways.select(F.xxhash64("sig", "way.p", "way.left").alias("at"), "key", "rest", "way.heads")
    heads = written(ways.where("heads").groupBy("at").agg(F.min(F.struct("key", "rest")).alias("head")), "line-heads")
    near = bounded_distance(F.col("head.rest"), F.col("rest"), 1).isNotNull()
    return ways.join(heads, "at").where((F.col("head.key") != F.col("key")) & near).select(F.col("head.key").alias("u"), F.col("key").alias("v")).distinct()


def line_links(lines: DataFrame, distinct: DataFrame, threshold: int) -> DataFrame:
    """u, v: links between keys of distinct lines that connect all within ``threshold`` edits, and no others.

    What two lines have besides a shared substring is within the threshold where the lines are, for one such substring at
    least. So what remains of the lines of a bucket meets again under signatures of that bucket: twice for all buckets
    (fewer times for larger thresholds, whose signatures are many), as that leaves few pairs to compare and those short,
    and further for large ones. For thresholds over 1, a large bucket whose lines differ in at most twice the threshold
    of characters is compared pair by pair.
    """
    met = _met(distinct.select("key", F.explode("sigs").alias("sig")), F.lit(0)).select("sig", "key")
    keys = written(met.select("key").distinct(), "line-keys")
    # An inner join, as a semi-join would be pushed below the filter.
    texts = likely(lines.where("line is not null").select("key", "line"), "key", keys).join(keys, "key")
    texts = written(texts.groupBy("key").agg(F.min("line").alias("line")), "line-texts")
    rows = met.join(texts, "key").select("sig", "key", "line", F.explode(signatures(F.col("line"), F.length("line"), F.lit(0), threshold)).alias("s")).where("s.sig = sig")
    rest = F.concat(F.expr("substring(line, 1, s.at)"), F.expr("substring(line, s.at + s.size + 1)"))
    open_ = written(rows.select("sig", "key", rest.alias("rest")).dropDuplicates(["sig", "key"]), "line-rests")
    few, many, rounds = [], [], 2 // threshold
    while not open_.isEmpty():
        found = signatures(F.col("rest"), F.length("rest"), F.col("sig"), threshold)
        left = lambda s: F.concat(F.substring("rest", F.lit(1), s["at"]), F.substring("rest", s["at"] + s["size"] + 1, F.length("rest")))
        again = open_.select("key", F.explode(F.array_distinct(F.transform(found, lambda s: F.struct(s["sig"].alias("sig"), left(s).alias("rest"))))).alias("s"))
        again = _met(again.select("s.sig", "key", "s.rest"), F.length("rest"))
        rounds -= 1
        little = F.col("shortest") <= (SHORT if threshold == 1 else 2 * threshold)
        small = (F.col("n") <= BUCKET) & (F.lit(rounds <= 0) | little)
        few.append(again.where(small if threshold == 1 else small | little).select("sig", "key", "rest"))
        if threshold == 1:
            many.append(again.where(~small & little).select("sig", "key", "rest"))
        open_ = again.where(~small & ~little).select("sig", "key", "rest")
    none = met.select(F.col("key").alias("u"), F.col("key").alias("v")).limit(0)
    if not few:
        return none
    pairs = _paired(reduce(DataFrame.unionByName, few), threshold)
    return pairs.unionByName(_keyed(reduce(DataFrame.unionByName, many))) if many else pairs


def _classes(docs: DataFrame, threshold: int, min_chars: int, numbers: bool) -> DataFrame:
    """key, first (doc_id and line_no of the first line of its class), for each distinct line that has a key."""
    lines = lines_of(docs, min_chars, numbers)
    sigs = signatures(F.col("line"), F.col("n"), F.lit(0), threshold)["sig"]
    some = lines.where("key is not null").select("key", F.struct("doc_id", "line_no").alias("first"), "line", F.length("line").alias("n")).select("key", "first", F.array_distinct(sigs).alias("sigs"))
    distinct = written(some.groupBy("key").agg(F.min("first").alias("first"), F.first("sigs").alias("sigs")), "lines")
    roots = written(connected_components(line_links(lines, distinct, threshold)).withColumnRenamed("v", "key"), "line-roots")
    members = distinct.select("key", "first").join(roots, "key")
    heads = written(members.groupBy("root").agg(F.min("first").alias("head")), "line-heads")
    linked = roots.join(heads, "root").select("key", "head")
    return written(distinct.select("key", "first").join(linked, "key", "left").select("key", F.coalesce("head", "first").alias("first")), "line-classes")


def _told(docs: DataFrame, threshold: int, min_chars: int, numbers: bool) -> DataFrame:
    """doc_id, body, line_no, class_doc_id, class_line_no, kept for each line of ``docs``."""
    lines = lines_of(docs, min_chars, numbers).select("doc_id", "body", "line_no", "key")
    classes = _classes(docs, threshold, min_chars, numbers).withColumnRenamed("key", "of")
    # Blank lines have no key; a number of their own spreads them over the join, which must not find it.
    lines = lines.withColumn("of", F.coalesce("key", F.xxhash64("doc_id", "body", "line_no"))).join(classes, "of", "left")
    first = F.when(F.col("key").isNotNull(), F.col("first")).otherwise(F.struct("doc_id", "line_no"))
    kept = F.col("key").isNull() | (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.line_no") == F.col("line_no")))
    return lines.select("doc_id", "body", "line_no", first["doc_id"].alias("class_doc_id"), first["line_no"].alias("class_line_no"), kept.alias("kept"))


def line_classes(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, numbers: bool = False) -> DataFrame:
    """doc_id, line_no (from 0), class_doc_id, class_line_no, kept for each line of ``docs`` (doc_id, text), lines being
    parted by line feeds.

    A line's class is named by its first line: the least doc_id (nulls first), then line_no; that line is kept. Lines of
    equal normal form are one class, whatever their length, and those of ``min_chars`` or more (in that form) also
    with all lines within ``threshold`` edits, directly or by a chain; blank lines are classes of their own. Null texts
    have no line; an empty text has one. Repeated rows count as one document: their lines are kept or not alike.
    Further columns are ignored; an empty table gives an empty result. Lines are told apart by a 64-bit hash of their
    normal form; with ``numbers``, runs of digits are alike in it.
    """
    return _told(docs, threshold, min_chars, numbers).drop("body")


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, numbers: bool = False) -> DataFrame:
    """``docs`` with all columns and rows, the text without lines that are not the first of their class, as
    ``line_classes`` has them. A text may become empty; null texts stay null."""
    told = _told(docs, threshold, min_chars, numbers)
    flags = told.groupBy("doc_id", "body").agg(F.array_sort(F.collect_set(F.struct("line_no", "kept"))).alias("flags"), F.every("kept").alias("whole"))
    flags = flags.where("not whole").select(F.col("doc_id").alias("of"), "body", "flags")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("key"))
    joined = rows.join(flags, (F.col("row.doc_id").eqNullSafe(F.col("of"))) & (F.col("key") == F.col("body")), "left")
    left = F.array_join(F.filter(F.split("row.text", "\n"), lambda x, i: F.element_at("flags", i + 1)["kept"]), "\n")
    text = F.when(F.col("flags").isNull(), F.col("row.text")).otherwise(left)
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents"))
