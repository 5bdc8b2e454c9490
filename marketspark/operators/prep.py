"""Model inputs: clean matrices, lags, sequence windows and prediction alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.functions.scans import halo_blocks
from marketspark.operators.select import encode_label, finite_or_zero

SERIES = ("symbol",)
NEUTRAL = 2
PREP_BLOCK = 4096


def tabular(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows without nulls, features through single precision with NaN and infinity as 0, label 0..4 as ``y``."""
    complete = df.na.drop(subset=[*features, label])
    single = complete.withColumns({f: F.col(f).cast("float").cast("double") for f in features})
    return single.select(
        *keep, *[finite_or_zero(f).alias(f) for f in features], encode_label(label).alias("y")
    )


def lagged(
    df: DataFrame, lags: Mapping[str, tuple[str, int]], *, keys: Sequence[str] = SERIES,
    block: int = PREP_BLOCK,
) -> DataFrame:
    """Add ``{new name: (column, lag)}`` to an indexed series, block by block."""
    reach = max(k for _, k in lags.values())
    rows = halo_blocks(df, block, before=reach)
    w = W.partitionBy(*keys, "blk").orderBy("idx")
    rows = rows.withColumns({name: F.lag(c, k).over(w) for name, (c, k) in lags.items()})
    return rows.where("core").drop("blk", "core")


def lag_features(
    df: DataFrame, label: str, exogenous: Sequence[str], *, order: int = 5, min_lag: int = 1,
    keys: Sequence[str] = SERIES, block: int = PREP_BLOCK,
) -> DataFrame:
    """``unique_id, ds, y``, the exogenous columns and ``order`` lags of y.

    ``df`` must be indexed after its null rows were dropped. Lags start at
    ``min_lag``: with a label looking h bars ahead only lags >= h are free of
    future prices. Leading rows without a full set are trimmed, so a series no
    longer than the deepest lag has no rows.
    """
    deepest = min_lag + order - 1
    base = df.withColumn("y", encode_label(label).cast("double"))
    lags = {f"y_lag_{k}": ("y", k) for k in range(min_lag, deepest + 1)}
    rows = lagged(base, lags, keys=keys, block=block)
    rows = rows.where(F.col("idx") >= deepest)
    return rows.select(
        F.concat_ws("_", *keys).alias("unique_id"), F.col("timestamp").alias("ds"), "y",
        *exogenous, *lags, "idx", "n",
    )


def sequence_windows(
    df: DataFrame, features: Sequence[str], label: str, length: int, *,
    keys: Sequence[str] = SERIES, block: int = PREP_BLOCK,
) -> DataFrame:
    """The ``length`` feature rows before each labelled row, as an array of arrays.

    The labelled row itself is not part of its window. Series not longer than
    ``length`` yield nothing.
    """
    point = F.array(*[F.col(f).cast("float") for f in features])
    rows = halo_blocks(df.withColumn("_point", point), block, before=length)
    w = W.partitionBy(*keys, "blk").orderBy("idx").rowsBetween(-length, -1)
    rows = rows.withColumn("window", F.collect_list("_point").over(w))
    return rows.where(F.col("core") & (F.col("idx") >= length)).select(
        *keys, "timestamp", "idx", "window", F.col(label).alias("y")
    )


def align_predictions(
    df: DataFrame, predictions: DataFrame, *, keys: Sequence[str] = ("symbol", "timestamp")
) -> DataFrame:
    """Predictions matched to every row by time; rows without one are neutral."""
    return df.join(predictions, list(keys), "left").withColumn(
        "prediction", F.coalesce("prediction", F.lit(NEUTRAL))
    )
