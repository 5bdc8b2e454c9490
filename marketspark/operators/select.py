"""Filters, projections and summaries over bar and feature tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.scans import row_index
from marketspark.schema import NON_FEATURE_COLUMNS, NON_FEATURE_PREFIXES

_NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def midnight(value, days: int = 0) -> dt.datetime | None:
    """The start, in UTC, of the day ``days`` after the one given as ``YYYYMMDD``, date or datetime; None for no bound.

    The day of a zone-aware datetime is that of its own zone.
    """
    if not value or (isinstance(value, str) and value.isspace()):
        return None
    zone = None
    if isinstance(value, str):
        value = dt.datetime.strptime(value.strip(), "%Y%m%d")
    if isinstance(value, dt.datetime):
        zone, value = value.tzinfo, value.date()
    if not isinstance(value, dt.date):
        raise TypeError(f"unsupported bound type {type(value).__name__}")
    start = dt.datetime.combine(value + dt.timedelta(days=days), dt.time(), tzinfo=zone)
    return start.astimezone(dt.UTC).replace(tzinfo=None) if zone else start


def date_range(df: DataFrame, start=None, end=None, column: str = "timestamp") -> DataFrame:
    """Rows from the start day to the end day, both included: [start, end + one day).

    The bounds are literals, so the filter reaches the Parquet scan.
    """
    low, high = midnight(start), midnight(end, days=1)
    if low and high and low >= high:
        raise ValueError(f"the range ends before it starts: {low:%Y-%m-%d} to {midnight(end):%Y-%m-%d}")
    kind = df.schema[column].dataType.simpleString()
    for bound, inside in ((low, F.col(column).__ge__), (high, F.col(column).__lt__)):
        if bound:
            df = df.where(inside(F.lit(bound.isoformat(" ")).cast(kind)))
    return df


def numeric_feature_columns(df: DataFrame, excluded: Sequence[str] | None = None) -> list[str]:
    """Names of the model inputs: numeric columns that are neither price, label nor look-ahead.

    Works on the schema alone. A custom ``excluded`` list replaces the default rule.
    """
    if excluded is not None:
        drop = set(excluded).__contains__
    else:
        def drop(name: str) -> bool:
            return name in NON_FEATURE_COLUMNS or name.startswith(NON_FEATURE_PREFIXES)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and not drop(f.name)]


def label_to_signal(label: str) -> Column:
    """Ordinal label to trade direction; anything else is no signal."""
    col = F.col(label)
    return F.when(col.isin(1, 2), 1).when(col.isin(-1, -2), -1).otherwise(0)


def encode_label(label: str) -> Column:
    return (F.col(label) + 2).cast("int")


def decode_label(encoded: str) -> Column:
    return (F.col(encoded) - 2).cast("byte")


def finite_or_zero(name: str) -> Column:
    """NaN and infinities become zero; null stays null."""
    col = F.col(name)
    return F.when(F.isnan(col) | (F.abs(col) == float("inf")), F.lit(0.0)).otherwise(col)


def bar_shape(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "range": F.col("high") - F.col("low"),
        "body": F.abs(F.col("close") - F.col("open")),
        "is_bullish": F.col("close") > F.col("open"),
    })


def tail(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last ``n`` rows in time order (a bounded top-n, not a sort of the table)."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def chrono_split(
    df: DataFrame, test_size: float = 0.2, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Mark the first ``int(n * (1 - test_size))`` rows of each series as train."""
    indexed = row_index(df, keys, "timestamp")
    cut = F.floor(F.col("n") * (1.0 - test_size))
    return indexed.withColumn(
        "split", F.when(F.col("idx") < cut, "train").otherwise("test")
    ).drop("idx", "n")


def dataset_summary(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Rows, columns, time range and null cells in one aggregate."""
    nulls = [F.count_if(F.col(c).isNull()) for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        sum(nulls[1:], nulls[0]).alias("null_cells"),
    )


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pairwise correlations (``a, b, corr``, upper triangle) over the rows that hold both features.

    Every task adds up the outer products of its rows into one matrix for all pairs, from an origin inside its data, and hands on
    the upper triangle as counts, means and deviations; one aggregate merges those, a row per task and pair.
    """
    names = list(features)
    slim = df.select(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(names)])
    a, b = np.triu_indices(len(names))
    parts = ["n", "ma", "mb", "qa", "qb", "c"]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, len(names), len(names)))  # rows with both, sum of a, of a squared, of a times b
        origin = np.full(len(names), np.nan)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            held = ~np.isnan(x)
            first = x[held.argmax(axis=0), np.arange(len(names))]
            origin = np.where(np.isnan(origin), first, origin)
            x, held = np.where(held, x - origin, 0.0), held.astype(float)
            sums += held.T @ held, x.T @ held, (x * x).T @ held, x.T @ x
        n = sums[0][a, b]
        some = np.maximum(n, 1)
        sa, sb = sums[1][a, b], sums[1][b, a]
        start = np.nan_to_num(origin)
        out = [n, start[a] + sa / some, start[b] + sb / some, sums[2][a, b] - sa * sa / some, sums[2][b, a] - sb * sb / some,
               sums[3][a, b] - sa * sb / some]
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *map(pa.array, out)], names=["a", "b", *parts])

    def merged(x: Column, y: Column) -> Column:
        n = x["n"] + y["n"]
        share = F.when(n > 0, y["n"] / n).otherwise(F.lit(0.0))
        da, db = y["ma"] - x["ma"], y["mb"] - x["mb"]
        cross = x["n"] * share
        return F.struct(
            n.alias("n"), (x["ma"] + da * share).alias("ma"), (x["mb"] + db * share).alias("mb"),
            (x["qa"] + y["qa"] + da * da * cross).alias("qa"), (x["qb"] + y["qb"] + db * db * cross).alias("qb"),
            (x["c"] + y["c"] + da * db * cross).alias("c"))

    of_tasks = slim.mapInArrow(gather, "a long, b long, " + ", ".join(f"{c} double" for c in parts)).groupBy("a", "b").agg(
        F.collect_list(F.struct(*parts)).alias("_parts"))
    total = of_tasks.select("a", "b", F.aggregate("_parts", F.struct(*[F.lit(0.0).alias(c) for c in parts]), merged).alias("t"))
    t = F.col("t")
    corr = F.when(F.col("a") == F.col("b"), F.when(t["n"] > 0, F.lit(1.0))).when(
        (t["n"] > 1) & (t["qa"] > 0) & (t["qb"] > 0), t["c"] / F.sqrt(t["qa"] * t["qb"]))
    name = F.array(*[F.lit(f) for f in names])
    return total.select(F.get(name, F.col("a").cast("int")).alias("a"), F.get(name, F.col("b").cast("int")).alias("b"), corr.alias("corr"))
