"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import new_folder


def _importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where the driver has it."""
    root, names = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = names.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        names["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written rows outlive a lost executor and are the same for every reader.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` over a value that is computed once, however often ``use`` names it in lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def whole_text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))
