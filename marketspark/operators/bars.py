"""Tick to bar aggregation, calendar bars and missing-bar gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.functions.scans import previous_row
from marketspark.functions.timecols import bucket_us, from_micros, micros, month_of, period_start
from marketspark.schema import timeframe_seconds

MIN_TICKS = 5
_PRICES = ("open", "high", "low", "close", "volume", "tick_count")


def tick_order(us: Column, mid: Column, tie: Column | None) -> Column:
    """A total order of ticks: time, then arrival number (those without one last), then price."""
    number = tie.cast("long") if tie is not None else F.lit(None).cast("long")
    return F.struct(us.alias("us"), number.isNull().alias("unnumbered"), number.alias("number"), mid.alias("mid"))


def _slim(ticks: DataFrame, keys: Sequence[str], tie_col: str | None) -> DataFrame:
    """What bars need of ticks: ``keys, _us, _number, _mid, _volume``.

    Without ``tie_col`` a column named ``seq`` numbers the ticks, if there is one.
    """
    tie_col = tie_col or ("seq" if "seq" in ticks.columns else None)
    return ticks.select(
        *keys, micros(F.col("timestamp")).alias("_us"), (F.col(tie_col) if tie_col else F.lit(None)).cast("long").alias("_number"),
        ((F.col("bid") + F.col("ask")) / 2).alias("_mid"), ((F.col("ask_volume") + F.col("bid_volume")) / 2).alias("_volume"))


def _measures(slim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ticks as one-tick bars: ``keys, _us, _at`` and the bar columns; ``_at`` orders them."""
    mid = F.col("_mid")
    return slim.select(
        *keys, "_us", tick_order(F.col("_us"), mid, F.col("_number")).alias("_at"),
        *[mid.alias(c) for c in ("open", "high", "low", "close")],
        F.col("_volume").alias("volume"), F.lit(1).cast("long").alias("tick_count"),
    )


def _roll(fine: DataFrame, groups: Sequence[str], order: str = "_us") -> DataFrame:
    """Merge finer bars into one bar per group; partial bars meet in one shuffle.

    Ticks (ordered by ``_at``) need no price beside their order, which ends with it.
    """
    ticks = order == "_at"
    return fine.groupBy(*groups).agg(
        (F.min("_at")["mid"] if ticks else F.min_by("open", order)).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        (F.max("_at")["mid"] if ticks else F.max_by("close", order)).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("tick_count").cast("int").alias("tick_count"),
    )


def _sane(bars: DataFrame, min_ticks: int) -> DataFrame:
    return bars.where(
        (F.col("tick_count") >= min_ticks)
        & (F.col("high") >= F.col("low"))
        & (F.col("close") > 0)
        & (F.col("open") > 0)
    )


def resample(
    ticks: DataFrame,
    timeframe: str = "1H",
    *,
    keys: Sequence[str] = ("symbol",),
    min_ticks: int = MIN_TICKS,
    tie_col: str | None = None,
    combine: bool = True,
    together: bool = False,
) -> DataFrame:
    """OHLCV bars of the mid price; buckets are left closed and left labelled.

    Equal timestamps are ordered by ``tie_col`` (default ``seq``), then by price,
    so bars never depend on the order of the input. One shuffle on
    ``(keys, bucket)`` after map-side aggregation, so a hot symbol is spread
    over its buckets and never gathers in one task. Where a bar holds only a few
    ticks, ``combine=False`` shuffles the ticks as they are: merging them before
    would sort them twice and hardly make them fewer. ``together`` does so by
    ``keys`` alone, for series of few ticks: their bars then lie where and in the
    order in which windows over the series need them.
    """
    slim, at = _slim(ticks, keys, tie_col), from_micros(bucket_us(F.col("_us"), timeframe_seconds(timeframe)))
    if together:
        slim = slim.repartition(*keys)
    fine = _measures(slim, keys).withColumn("timestamp", at)
    if not combine and not together:
        fine = fine.repartition(*keys, "timestamp")
    bars = _sane(_roll(fine, [*keys, "timestamp"], "_at"), min_ticks)
    return bars.select(*keys, "timestamp", *_PRICES, month_of(F.col("timestamp")).alias("month"))


def resample_many(
    ticks: DataFrame,
    timeframes: Sequence[str],
    *,
    keys: Sequence[str] = ("symbol",),
    min_ticks: int = MIN_TICKS,
    tie_col: str | None = None,
) -> DataFrame:
    """Bars of several timeframes with a ``tf`` column from one pass over the ticks.

    Ticks are reduced to the finest timeframe once (unfiltered, so nothing is
    lost), and only those small bars are expanded to the coarser ones.
    """
    seconds = {tf: timeframe_seconds(tf) for tf in timeframes}
    finest = min(seconds.values())
    odd = [tf for tf, s in seconds.items() if s % finest]
    if odd:
        raise ValueError(f"{odd} cannot be built from bars of {finest} s")
    base = _roll(
        _measures(_slim(ticks, keys, tie_col), keys).withColumn("_base", bucket_us(F.col("_us"), finest)),
        [*keys, "_base"], "_at",
    ).withColumnRenamed("_base", "_us")
    targets = F.array(*[
        F.struct(F.lit(tf).alias("tf"), bucket_us(F.col("_us"), s).alias("_bucket"))
        for tf, s in seconds.items()
    ])
    bars = _sane(_roll(base.select("*", F.inline(targets)), [*keys, "tf", "_bucket"]), min_ticks)
    ts = from_micros(F.col("_bucket"))
    return bars.select(*keys, "tf", ts.alias("timestamp"), *_PRICES, month_of(ts).alias("month"))


def anchor_ohlc(bars: DataFrame, unit: str, *, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """OHLC per calendar day, week (Monday), month, quarter or year."""
    rows = bars.select(
        *keys, period_start(F.col("timestamp"), unit).alias("period"),
        micros(F.col("timestamp")).alias("_us"), "open", "high", "low", "close",
    )
    return rows.groupBy(*keys, "period").agg(
        F.min_by("open", "_us").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "_us").alias("close"),
    )


def detect_gaps(
    bars: DataFrame, timeframe: str, *, keys: Sequence[str] = ("symbol",), block: str = "month"
) -> DataFrame:
    """Stretches of missing bars: neighbours more than one and a half steps apart."""
    step = timeframe_seconds(timeframe) * 1_000_000
    narrow = bars.select(*keys, block, micros(F.col("timestamp")).alias("_us"))
    spans = previous_row(narrow, keys, block, "_us", {"_prev": "_us"})
    diff = F.col("_us") - F.col("_prev")
    return spans.where(diff * 2 > step * 3).select(
        *keys,
        from_micros(F.col("_prev")).alias("gap_start"),
        from_micros(F.col("_us")).alias("gap_end"),
        F.floor(diff / step).alias("gap_bars"),
    )
