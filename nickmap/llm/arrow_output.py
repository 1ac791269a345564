"""Token ids in Arrow files of equal-length sequences.

Each shard holds a range of documents in ascending id order: ``<shard>.arrow`` is an Arrow file whose record batches have
two fixed-size-list columns, ``ids`` and ``mask`` (false on padding), so that sequence i is found by arithmetic and read
from a memory map without a copy; ``<shard>.docs.arrow`` tells where each document starts.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, table, written
from .tokens import encoder, tokenizer_path

#: Sequences in a record batch.
ROWS = 512
INDEX = "shard string, part int, least long, ids long, documents long"
DOCUMENTS = "shard string, doc_id long, start long, n_tokens long, ids_crc32 long"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class ShardWriter:
    """Writes one shard. A file gets its name when it is complete, so a repeated or lost task leaves no half file."""

    def __init__(self, folder: str, name: str, attempt: int, dtype: np.dtype, length: int, rows: int):
        import pyarrow as pa

        self.pa, self.length, self.dtype, self.rows = pa, length, dtype, rows
        self.fs, base = _filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.name, self.target, self.temp = name, f"{base}/{name}", f"{base}/_{name}.{attempt}"
        self.kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(self.kind, length)), ("mask", pa.list_(pa.bool_(), length))], {"rows": str(rows)})
        self.sink = self.fs.open_output_stream(f"{self.temp}.arrow")
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held, self.n_held, self.total = [], 0, 0
        self.ids, self.starts, self.counts = [], [], []

    def _put(self, flat: np.ndarray, real: int) -> None:
        pa = self.pa
        mask = np.arange(len(flat)) < real
        fixed = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (flat, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(fixed, schema=self.schema))

    def _flush(self, last: bool) -> None:
        flat, size = np.concatenate([np.zeros(0, self.dtype), *self.held]), self.rows * self.length
        while len(flat) >= size:
            self._put(flat[:size], size)
            flat = flat[size:]
        if last and len(flat):
            self._put(np.concatenate([flat, np.zeros(-len(flat) % self.length, self.dtype)]), len(flat))
            flat = flat[:0]
        self.held, self.n_held = [flat.copy()], len(flat)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.starts.append(self.total)
        self.counts.append(len(ids))
        self.total += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.rows * self.length:
            self._flush(False)

    def close(self) -> None:
        pa = self.pa
        self._flush(True)
        self.file.close()
        self.sink.close()
        docs = pa.table({"doc_id": pa.array(self.ids, pa.int64()), "start": pa.array(self.starts, pa.int64()), "n_tokens": pa.array(self.counts, pa.int64())})
        with self.fs.open_output_stream(f"{self.temp}.docs.arrow") as sink, pa.ipc.new_file(sink, docs.schema) as file:
            file.write_table(docs, max_chunksize=65536)
        for kind in ("arrow", "docs.arrow"):
            self.fs.move(f"{self.temp}.{kind}", f"{self.target}.{kind}")


class Shard:
    """A shard's ids and masks, without a copy where the folder is local."""

    def __init__(self, folder: str, name: str):
        import pyarrow as pa
        from pyarrow import fs

        system, base = _filesystem(folder)
        local = isinstance(system, fs.LocalFileSystem)
        get = (lambda p: pa.memory_map(p)) if local else system.open_input_file
        self.file = pa.ipc.open_file(get(f"{base}/{name}.arrow"))
        self.documents = pa.ipc.open_file(get(f"{base}/{name}.docs.arrow"))
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = int(self.file.schema.metadata[b"rows"])
        self.at, self.batch = -1, None

    def _batch(self, k: int) -> np.ndarray:
        if k != self.at:
            self.at, self.batch = k, self.file.get_batch(k)
        return self.batch.column(0).flatten().to_numpy()

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``, counted from 0 in this shard."""
        ids = self._batch(i // self.rows)
        at = slice(i % self.rows * self.length, (i % self.rows + 1) * self.length)
        return ids[at], self.batch.column(1).flatten().to_numpy(zero_copy_only=False)[at]

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the shard, across sequences and batches."""
        size, parts = self.rows * self.length, []
        while n > 0:
            part = self._batch(start // size)[start % size :][:n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, "<u2"), *parts])


def write_sequences(docs: DataFrame, tokenizer: str, folder: str, end_id: int, length: int = 2048, rows: int = ROWS) -> DataFrame:
    """Writes ``docs`` (doc_id, text) into ``folder`` and returns a row for each shard: shard, start (ids in the shards
    before it), ids, documents.

    Documents lie in ascending doc_id order, null ids first, repeated rows beside each other in the order of their
    texts; each is followed by ``end_id``. A record batch has ``rows`` sequences of ``length``. Null texts are empty ones. Further columns are ignored. An empty table writes
    no file and gives no row.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.col("text").asc_nulls_first())

    def write(batches):
        import pyarrow as pa

        task, e, out, least = TaskContext.get(), encoder(tokenizer), None, None
        end = np.array([end_id], e.dtype).tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if out is None:
                    out, least = ShardWriter(folder, f"part-{task.partitionId():06d}", task.taskAttemptId(), e.dtype, length, rows), doc_id
                out.add(doc_id, np.frombuffer(e.ids(text.as_py()) + end, e.dtype))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"shard": out.name, "part": task.partitionId(), "least": least, "ids": out.total, "documents": len(out.ids)}], schema=pa.schema([("shard", pa.string()), ("part", pa.int32()), ("least", pa.int64()), ("ids", pa.int64()), ("documents", pa.int64())]))

    shards = written(ordered.mapInArrow(write, INDEX), "arrow-index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    return shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"), "ids", "documents")


def read_documents(shards: DataFrame, folder: str) -> DataFrame:
    """A row for each document of the shards, from the files: shard, doc_id, start in the shard, n_tokens, ids_crc32."""

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for name in batch.column("shard").to_pylist():
                shard = Shard(folder, name)
                for k in range(shard.documents.num_record_batches):
                    docs = shard.documents.get_batch(k)
                    crc = [zlib.crc32(shard.tokens(s, n).astype("<u4").tobytes()) for s, n in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(crc), pa.string()), *docs.columns, pa.array(crc, pa.int64())], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.select("shard").repartition(n, "shard").mapInArrow(read, DOCUMENTS)


def op8_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "arrow")
    shards = written(write_sequences(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), folder, 2), "arrow-shards")
    found = read_documents(shards, folder).withColumnRenamed("start", "within")
    return found.join(shards.select("shard", "start"), "shard").select("doc_id", (F.col("start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
