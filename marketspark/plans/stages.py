"""Compositions: ticks to bars, features and labels as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.operators.bars import MIN_TICKS, resample, resample_many
from marketspark.operators.indicators import add_indicators, normalized_distances
from marketspark.operators.labels import add_labels
from marketspark.operators.levels import add_level_features
from marketspark.operators.sessions import MONTHLY, add_session_features
from marketspark.schema import LABEL_HORIZONS


def feature_table(
    bars: DataFrame,
    partition_cols: Sequence[str] = MONTHLY,
    *,
    pivot_kind: str = "traditional",
    pivot_anchor: str = "daily",
    ema_periods: Sequence[int] = (20, 50, 200),
    avg_range_n: int = 5,
    rsi_period: int = 14,
    atr_period: int = 14,
    macd: tuple[int, int, int] = (12, 26, 9),
) -> DataFrame:
    """All features of a bar table: sessions, levels, indicators, distances.

    Every step partitions by the same columns, so the bars are shuffled once.
    """
    df = add_session_features(bars, partition_cols, avg_range_n)
    df = add_level_features(df, partition_cols, pivot_kind, pivot_anchor)
    df = add_indicators(
        df, partition_cols, ema_periods=ema_periods, rsi_period=rsi_period,
        atr_period=atr_period, macd=macd,
    )
    return normalized_distances(df, f"atr_{atr_period}")


def labelled_table(
    bars: DataFrame,
    partition_cols: Sequence[str] = MONTHLY,
    horizons: Sequence[int] = LABEL_HORIZONS,
    *,
    atr_period: int = 14,
    **feature_options,
) -> DataFrame:
    features = feature_table(bars, partition_cols, atr_period=atr_period, **feature_options)
    return add_labels(features, horizons, partition_cols, atr_col=f"atr_{atr_period}")


def ticks_to_labels(
    ticks: DataFrame,
    timeframes: Sequence[str] = ("1H",),
    *,
    min_ticks: int = MIN_TICKS,
    tie_col: str | None = None,
    **options,
) -> DataFrame:
    """Resample, add features and labels for every timeframe asked for (``tf`` column)."""
    if len(timeframes) == 1:
        bars = resample(ticks, timeframes[0], min_ticks=min_ticks, tie_col=tie_col)
        bars = bars.withColumn("tf", F.lit(timeframes[0]))
    else:
        bars = resample_many(ticks, timeframes, min_ticks=min_ticks, tie_col=tie_col)
    return labelled_table(bars, ("symbol", "tf", "month"), **options)


def stage_stats(labelled: DataFrame, label_col: str = "label_10") -> DataFrame:
    """Bars, labelled bars and time range per symbol and timeframe."""
    return labelled.groupBy("symbol", "tf").agg(
        F.count(F.lit(1)).alias("bars"),
        F.count(label_col).alias("labelled"),
        F.count_distinct("month").alias("months"),
        F.min("timestamp").alias("first_bar"),
        F.max("timestamp").alias("last_bar"),
    )
