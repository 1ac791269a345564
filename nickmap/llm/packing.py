"""Packing by concatenation: two-pass prefix sums give every document its place in one stream of ids, which is cut into
fixed windows; a document that crosses a cut leaves a piece on either side."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written
from .tokens import encoder, tokenizer_path

ENCODED = "part int, doc_id long, within long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The first pass encodes every text once, notes each document's place within its partition, and writes the ids; the
    second adds the totals of the partitions before and cuts at multiples of ``capacity``. Only the very last sequence
    can be short. No row is shuffled, whatever the length of a text. Null texts are empty ones and consist of the end id;
    null ids and repeated rows are packed like others; further columns are ignored; an empty table gives no piece.
    """
    width = encoder(tokenizer).dtype

    def encode(batches):
        import pyarrow as pa

        part, e, place = TaskContext.get().partitionId(), encoder(tokenizer), 0
        end = np.array([end_id], e.dtype).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [e.ids(x.as_py()) + end for x in some.column("text")]
                counts = np.array([len(x) // e.dtype.itemsize for x in ids], np.int64)
                starts = place + np.cumsum(counts) - counts
                place += int(counts.sum())
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.int32()), some.column("doc_id").cast(pa.int64()), pa.array(starts), pa.array(ids, pa.binary())], ["part", "doc_id", "within", "ids"])

    encoded = written(docs.select("doc_id", "text").mapInArrow(encode, ENCODED), "packing")
    totals = encoded.groupBy("part").agg(F.sum(F.octet_length("ids").cast("long") / width.itemsize).cast("long").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition of the input
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))

    def cut(batches):
        import pyarrow as pa

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            rows = [[] for _ in names]
            for doc_id, place, blob in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "place", "ids")), strict=True):
                ids = np.frombuffer(blob, width).astype("<u4")
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(place + start, capacity)
                    n = min(capacity - offset, len(ids) - start)
                    for column, value in zip(rows, (doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), sequence, offset), strict=True):
                        column.append(value)
                    start += n
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names)

    # A row for each input partition: its size is that of the input's partition list, which the driver holds anyway.
    placed = encoded.join(F.broadcast(offsets), "part").select("doc_id", (F.col("before") + F.col("within")).alias("place"), "ids")
    return placed.mapInArrow(cut, PIECES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 2)
