"""The list of named queries and, where SQL can express them, their check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.scans import without_notes
from marketspark.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None
    survey: str


QUERIES: dict[str, Query] = {}


def query(name: str, survey: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_notes(fn(configure(spark), sf_dir))

        QUERIES[name] = Query(name, run, sql, survey)
        return fn

    return register


def tidy(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Select columns for comparison: doubles rounded, booleans as 0/1, dates as text."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in columns or df.columns:
        kind = fields[name]
        col = F.col(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            col = F.round(col.cast("double"), digits) + F.lit(0.0)
        elif isinstance(kind, (T.BooleanType, T.ByteType)):
            col = col.cast("int")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        out.append(col.alias(name))
    return df.select(*out)


def tidy_sql(body: str, doubles: Sequence[str], others: Sequence[str], digits: int = 6) -> str:
    """The same rounding for check SQL; ``body`` is a full SELECT statement."""
    parts = [f"round({c}, {digits}) + 0.0 AS {c}" for c in doubles]
    parts += list(others)
    return f"SELECT {', '.join(parts)} FROM ({body}) AS t"
