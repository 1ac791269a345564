"""Scalar functions on sequences, alignments and stitch intervals."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

# The IUPAC nucleotide codes and their complements, in both cases.
IUPAC = "ABCDGHMNRSTUVWXY"
IUPAC_COMPLEMENT = "TVGHCDKNYSAABWXR"

# Nicking enzymes and their recognition motifs.
ENZYMES = {"BspQI": "GCTCTTC", "BbvCI": "CCTCAGC", "BsmI": "GAATGC", "BsrDI": "GCAATG", "bseCI": "ATCGAT"}

# Display colours of predicted sites.
SITE_COLOURS = {"TypeI": "255,0,0,255", "TypeII": "0,255,0,255", "TypeIII": "0,0,255,255", "TypeIV": "255,128,0,255", "TypeV": "128,0,255,255", "TypeVI": "0,128,128,255", "Observed": "255,255,255,255"}


def complement(sequence: Column, alphabet: str = IUPAC, partner: str = IUPAC_COMPLEMENT) -> Column:
    """Each letter's complement in the same case; other letters stay. Null for a null."""
    return F.translate(sequence, alphabet + alphabet.lower(), partner + partner.lower())


def reverse_complement(sequence: Column, alphabet: str = IUPAC, partner: str = IUPAC_COMPLEMENT) -> Column:
    return complement(F.reverse(sequence), alphabet, partner)


def motif_of(enzyme: str) -> str:
    """Recognition motif of an enzyme, told by the first three letters of its name in any case, or else of a motif of
    A, C, G and T itself. Raises ValueError for anything else."""
    known = {name[:3].upper(): motif for name, motif in ENZYMES.items()}
    upper = enzyme.strip().upper()
    if upper[:3] in known and not set(upper) <= set("ACGT"):
        return known[upper[:3]]
    if upper and set(upper) <= set("ACGT"):
        return upper
    raise ValueError(f"neither an enzyme nor a motif: {enzyme!r}")


def random_motif(length: int = 7, seed: int = 0) -> str:
    """A random motif, for how many sites chance alone gives."""
    return "".join(random.Random(seed).choices("ACGT", k=length))


def letter_count(sequence: Column, letter: str) -> Column:
    return (F.length(sequence) - F.length(F.replace(sequence, F.lit(letter)))).cast("long")


def percent(part: Column, whole: Column) -> Column:
    """``part`` in ``whole`` as a percentage, 0 where ``whole`` is 0."""
    return F.when(whole != 0, 100.0 * part / whole).otherwise(0.0)


def alignment_pairs(alignment: Column) -> Column:
    """Array of (ref, qry) label ids of an alignment text such as ``(1,1)(2,2)``, in its order."""
    ids = lambda group: F.transform(F.regexp_extract_all(alignment, F.lit(r"\((\d+),(\d+)\)"), F.lit(group)), lambda x: x.cast("int"))
    return F.arrays_zip(ids(1).alias("ref"), ids(2).alias("qry"))


def query_label_of(pairs: Column, ref: Column) -> Column:
    """Query label aligned to a reference label, the last one if there are several, null if there is none."""
    return F.element_at(F.filter(pairs, lambda p: p["ref"] == ref), -1)["qry"]


def site_colour(site_type: Column) -> Column:
    colours = F.create_map(*[F.lit(x) for pair in SITE_COLOURS.items() for x in pair])
    return F.coalesce(colours[site_type], F.lit("0,0,0,255"))


def padding(end1: Column, start2: Column) -> Column:
    """Bases from one map's end to the next one's start, negative where they overlap."""
    return start2 - end1 + 1


def stitch_interval(end1: Column, start2: Column) -> tuple[Column, Column]:
    """Start and end of a stitch: the gap between two maps, or their overlap, one base wider on either side."""
    apart = padding(end1, start2) >= 0
    start = F.when(apart, end1 - 1).otherwise(start2 - 1).cast("long")
    end = F.when(apart, start2 + 1).otherwise(end1 + 1).cast("long")
    return start, end


def log10_or_zero(x: Column) -> Column:
    return F.when(x != 0, F.log10(x)).otherwise(F.lit(0.0))


def flank(start: Column, end: Column, length: Column, buffer: int = 50) -> tuple[Column, Column]:
    """A 1-based stretch widened by ``buffer`` on both sides and held within a sequence of ``length``."""
    return F.greatest(start - buffer, F.lit(1)), F.when(end + buffer > length, length - 1).otherwise(end + buffer)
