"""Token counts through a cache of digests: only texts that were never counted are encoded."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.byte_bpe import ByteBpe
from siltstone.llm.common import kept, whole_text
from siltstone.session import hadoop_path

CACHE_SCHEMA = "digest binary, n_tokens long"


def tokenizer_version(tokenizer: str) -> str:
    """Digest of what decides the counts: the tokenizer's file and the library that reads it."""
    with open(tokenizer, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()[:32]


def _cache(spark: SparkSession, folder: str) -> DataFrame:
    fs, path = hadoop_path(spark, folder)
    if not fs.exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(folder)


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, limit: int = 512) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit; new counts join the cache.

    ``cache`` is a folder with one sub-folder per tokenizer version and one row
    per distinct text in it (a text that two jobs appended counts once). A rerun, or
    another corpus with the same texts, encodes nothing again. NULL texts count as
    empty, empty texts have no tokens; rows that repeat a document are returned
    as often as they come; other columns are not read. A failed job appends
    nothing: its files are listed only when it ends.

    With an empty cache one shuffle holds texts: one text per digest and map task goes to the task
    that keeps the first. With a filled one the digests that it lacks are found first, and only
    texts of these are moved. Counts come back in a join on digests alone, in which
    Spark can split a digest that many documents share.
    """
    spark = docs.sparkSession
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_version(tokenizer)}"
    text = whole_text(docs)
    keyed = docs.select(
        docs["doc_id"],
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.at(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 2500):
                piece = batch.slice(start, 2500)
                counts = [len(ids) // 4 for ids in bpe.encode(piece.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
                )

    cached = _cache(spark, folder).select("digest")
    texts = keyed.select("digest", "n_bytes", "text")
    if not cached.isEmpty():
        known = keyed.select("digest", "n_bytes").distinct()
        missing = kept(known.join(cached, "digest", "left_anti"), "missing-digests")
        # By size too, so that what follows is shuffled again and a text that many documents share can be split here.
        texts = texts.join(missing, ["digest", "n_bytes"], "left_semi")
    misses = texts.select("digest", "text").dropDuplicates(["digest"])
    misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(folder)
    counts = _cache(spark, folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return keyed.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
