"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nickmap.sources.shared import shared_dir, written

__all__ = ["WORD", "held_out", "likely", "shared_dir", "table", "with_row_id", "written"]

#: A run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bits of the filter of ``likely``; its size is fixed at 2 MB.
FILTER_BITS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def likely(rows: DataFrame, name: str, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose column ``name`` is not among ``keys``.

    A filter of fixed size, made of all keys, goes to every task and keeps rows without a partner out of a shuffle; where
    it is full, all rows pass.
    """
    # Spark numbers bits from 1 and 32768 of them make a row.
    place = F.pmod(F.col(name), F.lit(1 << FILTER_BITS)) + 1
    bits = keys.groupBy(F.bitmap_bucket_number(place).alias("filter")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0
    return rows.withColumn("filter", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "filter").where(is_set).drop("filter", "bits")


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the quarter that no label is learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def with_row_id(docs: DataFrame) -> DataFrame:
    """row_id and row (all columns of ``docs``) as a written table, so that an id stays with its row, whatever ids,
    nulls, repeated rows or further columns ``docs`` has."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return written(docs.select(F.monotonically_increasing_id().alias("row_id"), row), "rows")
