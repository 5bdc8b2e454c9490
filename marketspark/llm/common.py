"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.session import configure, stage

#: Rows handed to a Python worker at once. Rows hold whole texts, so this bounds a worker's memory.
ARROW_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results and worker memory depend on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """While a job on rows of another size than whole texts runs: so many of them at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def groups_for(amount: int, each: int) -> int:
    """How many groups keep ``amount`` at ``each`` or less on average."""
    return max(1, -(-int(amount) // each))


__all__ = ["ARROW_ROWS", "arrow_rows", "groups_for", "prepare", "read", "stage", "text_or_empty"]
