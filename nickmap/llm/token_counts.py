"""Token counts by a digest cache.

Texts are identified by a digest of their content; the counts known so far lie in a table keyed by that digest and the
digest of the tokenizer. Only distinct contents that the table lacks are encoded, and their counts are appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, table, written
from .tokens import encoder, tokenizer_path, tokenizer_version

CACHE = "content binary, tokenizer string, n_tokens long"


def _cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts known for this tokenizer. An append that was repeated gives the same counts again, so they are grouped."""
    known = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    return known.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs`` (doc_id, text).

    ``tokenizer`` is a file of the tokenizers library, at the same path on all executors; ``cache`` a folder that all
    executors share, created where absent. Contents are normalised only so far that a null is an empty text: any other
    normalisation could change a count. Null and empty texts have 0 tokens; null ids and repeated rows are kept as they
    are; further columns are ignored; an empty table gives an empty result.

    Digests are compared with the cache first, and texts are shuffled only where some of them are new.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    text = F.coalesce(F.col("text"), F.lit(""))
    content = F.unhex(F.sha2(text, 256)).alias("content")
    digests = written(docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), content), "digests")
    known = written(_cached(spark, cache, version), "known-counts")
    new = written(digests.select("content").distinct().join(known, "content", "left_anti"), "new-contents")
    if not new.isEmpty():

        def encode(batches):
            import pyarrow as pa

            e = encoder(tokenizer)
            for batch in batches:
                counts = [e.count(x) for x in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())], ["content", "tokenizer", "n_tokens"])

        missing = docs.select(content, text.alias("text")).dropDuplicates(["content"]).join(new, "content", "left_semi")
        missing.mapInArrow(encode, CACHE).write.mode("append").parquet(cache)
        known = written(_cached(spark, cache, version), "known-counts")
    # Written tables on both sides: a content that many documents share can be split.
    return digests.join(known, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op6_token_counts(spark: SparkSession, sf_dir: str, cache: str | None = None) -> DataFrame:
    """Token counts of all documents. The query has a cache of its own for each call; with ``cache``, a folder that all
    executors share, it goes on with what earlier calls have counted."""
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), cache or shared_dir(spark, "token-cache"))
