"""Tick quality: integrity counts, market gaps, hourly slots, dedupe and merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.functions.timecols import bucket_us, from_micros, micros
from marketspark.session import stage

_HOUR_US = 3_600_000_000
_TICK_COLUMNS = ("timestamp", "ask", "bid", "ask_volume", "bid_volume")


def integrity_counts(ticks: DataFrame, *, keys: Sequence[str] = ("symbol", "month")) -> DataFrame:
    """Rows, null cells, bad prices, crossed quotes and negative volumes per month."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in _TICK_COLUMNS[1:]),
                F.count_if(F.col(_TICK_COLUMNS[0]).isNull()))
    return ticks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("actual_rows"),
        nulls.alias("nulls"),
        F.count_if((F.col("ask") <= 0) | (F.col("bid") <= 0)).alias("negative_price"),
        F.count_if(F.col("ask") < F.col("bid")).alias("negative_spread"),
        F.count_if((F.col("ask_volume") < 0) | (F.col("bid_volume") < 0)).alias("negative_volume"),
    )


def with_manifest(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Attach expected rows (-1 when unknown) and missing hours (0 when unknown).

    Manifest months without a single tick are kept, with NULL counts.
    """
    expected = manifest.select("symbol", "month", F.col("rows").alias("expected_rows"), "missing_hours")
    return counts.join(expected, ["symbol", "month"], "full").fillna(
        {"expected_rows": -1, "missing_hours": 0}
    )


def is_anomalous() -> Column:
    return (
        (F.col("nulls") > 0)
        | (F.col("negative_price") > 0)
        | (F.col("negative_spread") > 0)
        | (F.col("negative_volume") > 0)
        | ((F.col("expected_rows") != -1) & (F.col("actual_rows") != F.col("expected_rows")))
        | (F.col("missing_hours") > 0)
    )


def anomalous_months(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Stored months that fail a test; a month without ticks has nothing stored to test."""
    return with_manifest(counts, manifest).where(F.col("actual_rows").isNotNull() & is_anomalous())


def audit_summary(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Totals per symbol and the overall verdict.

    Missing hours are those of the whole manifest, so a month that was lost
    altogether counts; every other total is over the stored months. Symbols
    without any stored month have no report. Data without null cells, bad
    prices and crossed quotes are ready.
    """
    return (
        with_manifest(counts, manifest)
        .groupBy("symbol")
        .agg(
            F.count("actual_rows").alias("months"),
            F.sum("actual_rows").alias("total_rows"),
            F.sum("nulls").alias("total_nulls"),
            F.sum("negative_price").alias("total_negative_price"),
            F.sum("negative_spread").alias("total_negative_spread"),
            F.sum("negative_volume").alias("total_negative_volume"),
            F.sum("missing_hours").alias("total_missing_hours"),
            F.count_if(F.col("actual_rows").isNotNull() & is_anomalous()).alias("anomalous_months"),
        )
        .where(F.col("months") > 0)
        .withColumn("status", F.when(
            (F.col("total_nulls") == 0) & (F.col("total_negative_price") == 0) & (F.col("total_negative_spread") == 0),
            "READY").otherwise("WARNING"))
    )


def months_with_missing_hours(ticks: DataFrame, manifest: DataFrame) -> DataFrame:
    """The ticks of months whose manifest says hours are missing; the audit lists gaps of these only."""
    return ticks.join(manifest.where(F.col("missing_hours") > 0), ["symbol", "month"], "left_semi")


def significant_gaps(ticks: DataFrame, asset_class: str = "fx") -> DataFrame:
    """Silences of more than one hour inside a month that are not market closures.

    Two ticks in one clock hour are never more than an hour apart, so first and
    last tick per hour decide everything. At most 744 rows per symbol and month
    reach the window, however many ticks there are.
    """
    hourly = (
        ticks.select("symbol", "month", micros(F.col("timestamp")).alias("_us"))
        .groupBy("symbol", "month", bucket_us(F.col("_us"), 3600).alias("_hour"))
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    )
    w = W.partitionBy("symbol", "month").orderBy("_hour")
    start = from_micros(F.col("_prev"))
    diff = F.col("_first") - F.col("_prev")
    gaps = hourly.withColumn("_prev", F.lag("_last").over(w)).where(diff > _HOUR_US)
    if asset_class == "fx":
        weekend = (F.weekday(start) == 5) | ((F.weekday(start) == 4) & (F.hour(start) >= 21))
        gaps = gaps.where(~weekend & (diff > _HOUR_US + 5 * 60_000_000))
    return gaps.select(
        "symbol",
        "month",
        F.date_format(start, "yyyy-MM-dd HH:mm").alias("start"),
        F.date_format(from_micros(F.col("_first")), "yyyy-MM-dd HH:mm").alias("end"),
        F.bround(diff / _HOUR_US, 2).alias("duration_h"),
        F.date_format(start, "E").alias("day"),
    )


def top_gaps(gaps: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` longest gaps (ties by symbol and start)."""
    return gaps.orderBy(F.desc("duration_h"), "symbol", "start").limit(n)


def calendar_slots(months: DataFrame, asset_class: str = "fx", *, repair: bool = False) -> DataFrame:
    """Hourly slots a market should cover, for every ``month`` row given.

    fx trades from Sunday 21:00 and not on Saturday; with ``repair`` only full
    Monday to Friday days count. crypto trades all hours.
    """
    first = F.col("month").cast("timestamp_ntz")
    last = F.add_months(F.col("month"), 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")
    slots = months.withColumn("slot", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))))
    if asset_class == "crypto":
        return slots
    day = F.weekday("slot")
    if repair:
        return slots.where(day < 5)
    return slots.where((day != 5) & ~((day == 6) & (F.hour("slot") < 21)))


def covered_hours(ticks: DataFrame) -> DataFrame:
    us = micros(F.col("timestamp"))
    return ticks.select("symbol", from_micros(bucket_us(us, 3600)).alias("slot")).distinct()


def missing_slots(ticks: DataFrame, asset_class: str = "fx") -> DataFrame:
    """Repair slots without a single tick, for the months each symbol has."""
    months = ticks.select("symbol", "month").distinct()
    expected = calendar_slots(months, asset_class, repair=True)
    return expected.join(covered_hours(ticks), ["symbol", "slot"], "left_anti")


def dedupe_ticks(ticks: DataFrame, *, order: str = "seq", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """One tick per timestamp: the one with the smallest ``order``.

    Ticks without an order come after those with one, and equal orders are told
    apart by the other columns, so the same tick stays however the rows arrive.
    Written as an aggregate so duplicates collapse before the shuffle.
    """
    return _first_ticks(ticks, [F.col(order).isNull(), F.col(order)], keys)


def _first_ticks(ticks: DataFrame, order: Sequence[Column], keys: Sequence[str]) -> DataFrame:
    values = [c for c in ticks.columns if c not in (*keys, "timestamp")]
    rank = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    first = F.min(F.struct(*rank, *values)).alias("_first")
    return ticks.groupBy(*keys, "timestamp").agg(first).select(
        *[F.col(f"_first.{c}").alias(c) if c in values else c for c in ticks.columns])


def union_ticks(*frames: DataFrame) -> DataFrame:
    """Concatenate frames by column name; differing columns are an error."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def merge_patch(base: DataFrame, patch: DataFrame, *, order: str = "seq") -> DataFrame:
    """Add late ticks to a stored month; on equal timestamps the stored tick stays."""
    both = union_ticks(base.withColumn("_late", F.lit(0)), patch.withColumn("_late", F.lit(1)))
    rank = [F.col("_late"), F.col(order).isNull(), F.col(order)]
    return _first_ticks(both, rank, ("symbol",)).drop("_late")


def coverage_after_merge(base: DataFrame, merged: DataFrame, asset_class: str = "fx") -> DataFrame:
    """Rows and missing repair slots per symbol, before and after a merge.

    Each side is reduced once to its rows per symbol and hour, and that small
    table is written out for the three readers.
    """

    def facts(frame: DataFrame, tag: str) -> DataFrame:
        hours = stage(frame.groupBy("symbol", "month", bucket_us(micros(F.col("timestamp")), 3600).alias("_h")).agg(
            F.count(F.lit(1)).alias("n")), "hours")
        rows = hours.groupBy("symbol").agg(F.sum("n").alias(f"rows_{tag}"))
        slots = hours.select("symbol", "month", from_micros(F.col("_h")).alias("timestamp"))
        gaps = missing_slots(slots, asset_class).groupBy("symbol").agg(
            F.count(F.lit(1)).alias(f"missing_{tag}")
        )
        return rows.join(gaps, "symbol", "left").fillna(0)

    return facts(base, "before").join(facts(merged, "after"), "symbol")


