"""Registry of checked queries: name, Spark callable and, where there is one, the SQL of the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inflecta.session import checkpoint_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``name``; the decorated callable takes (spark, sf_dir)."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query name: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def written(df: DataFrame) -> str:
    """The path of a fresh folder of the shared checkpoint folder, into which ``df`` is written as ``store``."""
    path = new_folder(df.sparkSession)
    df.write.parquet(f"{path}/store")
    return path


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/written-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
