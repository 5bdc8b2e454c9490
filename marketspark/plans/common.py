"""Derived inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.functions.scans import SHORT, measured, noted
from marketspark.operators.bars import resample
from marketspark.operators.indicators import atr
from marketspark.operators.labels import add_labels
from marketspark.session import stage
from marketspark.sources import views


def bars_1h(spark, sf, *, source=views.ticks_all, min_ticks=5, staged=False):
    df = resample(source(spark, sf), "1H", min_ticks=min_ticks)
    return stage(df, "bars") if staged else df


def bars_4h(spark, sf, *, staged=False):
    df = resample(views.ticks_by_type(spark, sf), "4H")
    return stage(df, "bars") if staged else df


def bars_1d(spark, sf, *, source=views.ticks_long, min_ticks=5, staged=False):
    """Daily bars of the line-item ticks, whose timestamps repeat."""
    df = resample(source(spark, sf), "1D", min_ticks=min_ticks, tie_col="seq")
    return stage(df, "bars") if staged else df


def ranged_1w(spark, sf):
    """Weekly bars of every supplier symbol over seven years, with ATR.

    Whole-series groups: the number of series grows with the tables, a series only with the years. A bar holds about two ticks.
    While no series has too many ticks for one task, bars, ATR and what follows come from one shuffle in one time order.
    """
    ticks, week = views.ticks_many(spark, sf), {"timeframe": "1W", "min_ticks": 1, "tie_col": "seq"}
    found = ticks.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).agg(
        F.max("n").alias("ticks"), F.floor(F.datediff(F.max("last"), F.min("first")) / 7).alias("weeks")).first()
    if (found["ticks"] or 0) <= SHORT:
        bars = resample(ticks, **week, together=True)
        # A series has no more bars than ticks, nor than there are weeks from the first tick to the last, and one of ticks without a time.
        return atr(noted(bars, "timestamp", min(found["ticks"] or 0, (found["weeks"] or 0) + 3)), ("symbol",))
    bars = stage(resample(ticks, **week, combine=False), "bars")
    return atr(measured(bars, ("symbol",), "timestamp"), ("symbol",))


def labelled_1w(spark, sf, *, staged=True):
    """The same bars with labels."""
    df = add_labels(ranged_1w(spark, sf), partition_cols=("symbol",))
    return stage(df, "labelled") if staged else df


def labelled_1h(spark, sf, *, staged=True):
    """Hourly bars with ATR and the three labels; written once because most users read it twice."""
    df = add_labels(atr(bars_1h(spark, sf)))
    return stage(df, "labelled") if staged else df
