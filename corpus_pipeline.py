"""From raw documents to token ids: toxicity, near-duplicates, long repeats, benchmark items, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept.
Stages before the last return the columns of ``documents``; the last returns ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import kept, table
from siltstone.llm.decontamination import with_leaks
from siltstone.llm.near_dups import near_rows, with_vertex
from siltstone.llm.repeats import remove_repeats
from siltstone.llm.sentencepieces import encode_documents
from siltstone.llm.toxicity import score_documents, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above their language's threshold go; NULL texts score as no words."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).filter(~F.col("toxic")).select(COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays, and one row of rows that repeat it.

    Groups are linked by a similarity of 0.8 over five-word shingles. Documents without words or id are in no group.
    Of rows that share an id only those go whose own text is in a group of a smaller id.
    """
    dropped = near_rows(docs).filter(~F.col("kept")).select("doc_id", "vertex").distinct()
    rest = with_vertex(docs.select(COLUMNS)).join(kept(dropped, "dropped-rows"), ["doc_id", "vertex"], "left_anti")
    # The vertex follows from the text; with it, rows need not be shuffled again after the join.
    return rest.dropDuplicates(["doc_id", "vertex", "text"]).select(COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that stand earlier are cut out of the texts; no document goes.

    A text that loses all its bytes stays as an empty one, and NULL texts become empty.
    """
    cut = remove_repeats(docs.select(COLUMNS), texts=True)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a window like one, go."""
    found = with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether the ids give the text back."""
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("repeats", without_repeats),
    ("benchmark", without_benchmark),
    ("encoding", encoded),
]

#: Not stated in SQL: a trained model decides what enters the second stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read back as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
