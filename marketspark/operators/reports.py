"""The tables behind the trade report: heat maps, win rates, attribution, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday names of the heat map, Monday first.
DAYS = ("mon", "tue", "wed", "thu", "fri")


def pnl_heatmap(trades: DataFrame) -> DataFrame:
    """Mean profit and trade count per entry hour (all 24) and weekday."""
    per_hour = trades.groupBy("hour").agg(*[
        expr for d, name in enumerate(DAYS) for expr in (
            F.avg(F.when(F.col("weekday") == d, F.col("pnl_r"))).alias(f"{name}_mean"),
            F.count_if(F.col("weekday") == d).alias(f"{name}_count"),
        )
    ])
    hours = trades.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(per_hour, "hour", "left").fillna(0)


def win_rate(trades: DataFrame, by: str) -> DataFrame:
    """Trades, wins and percentage of wins per ``hour`` or ``weekday``."""
    return trades.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("pnl_r") > 0).alias("wins")
    ).withColumn("win_rate", F.col("wins") / F.col("total") * 100)


def entry_session(hour: Column) -> Column:
    """London first, then New York, else Asia, by UTC entry hour."""
    return (
        F.when((hour >= 8) & (hour < 16), "London")
        .when((hour >= 13) & (hour < 21), "New York")
        .otherwise("Asia")
    )


def pnl_attribution(trades: DataFrame) -> DataFrame:
    """Summed profit by signal, weekday, exit reason and session in one pass."""
    rows = trades.withColumn("session", entry_session(F.col("hour")))
    sets = [["signal"], ["weekday"], ["reason"], ["session"]]
    cols = ["signal", "weekday", "reason", "session"]
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(
        F.sum("pnl_r").alias("pnl_r"), F.count(F.lit(1)).alias("trades"),
        F.grouping_id(*cols).alias("_gid"),
    )
    # The grouping id has a zero bit at the one column that is kept.
    kept = F.when(F.col("_gid") == 7, "signal").when(F.col("_gid") == 11, "weekday").when(
        F.col("_gid") == 13, "reason").otherwise("session")
    value = F.coalesce("signal", F.col("weekday").cast("string"), "reason", "session")
    return grouped.select(kept.alias("dimension"), value.alias("value"), "pnl_r", "trades")


def _equal_bins(trades: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins; the last bin is closed on the right."""
    limits = trades.agg(
        F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi")
    )
    # One-row side: a global aggregate.
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(F.col(column) - F.col("_lo"), width)), F.lit(bins - 1))
    )
    return trades.join(F.broadcast(limits)).groupBy(place.cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))


def trade_histograms(trades: DataFrame) -> DataFrame:
    """Profit (30 bins), duration (20 bins), entry hour and exit reason counts."""
    def tagged(df: DataFrame, kind: str, column: str) -> DataFrame:
        return df.select(F.lit(kind).alias("histogram"), F.col(column).cast("string").alias("bin"), "n")

    def counts(column: str) -> DataFrame:
        return trades.groupBy(column).agg(F.count(F.lit(1)).alias("n"))

    return (
        tagged(_equal_bins(trades, "pnl_r", 30), "pnl", "bin")
        .unionByName(tagged(_equal_bins(trades, "bars_held", 20), "duration", "bin"))
        .unionByName(tagged(counts("hour"), "hour", "hour"))
        .unionByName(tagged(counts("reason"), "reason", "reason"))
    )
