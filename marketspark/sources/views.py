"""Tick views over the shared test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.functions.timecols import month_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_ticks(events: DataFrame, symbol) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        symbol.alias("symbol"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("bid"),
        (F.col("value") + 0.02).alias("ask"),
        k.alias("bid_volume"),
        (F.lit(100.0) - k).alias("ask_volume"),
        F.col("event_id").alias("seq"),
        month_of(F.col("ts")).alias("month"),
    )


def ticks_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a tick of one symbol."""
    return _event_ticks(table(spark, sf_dir, "events"), F.lit("ALL"))


def ticks_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks, one symbol per event type."""
    return _event_ticks(table(spark, sf_dir, "events"), F.col("event_type"))


def _line_ticks(lines: DataFrame, symbol) -> DataFrame:
    ts = F.timestamp_seconds(
        F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
        + (F.col("l_orderkey") % 24) * 3600
        + (F.col("l_partkey") % 60) * 60
    ).cast("timestamp_ntz")
    # Quotes have a price step: whole cents, cut rather than rounded.
    mid = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100
    return lines.select(
        symbol.alias("symbol"),
        ts.alias("timestamp"),
        mid.alias("bid"),
        mid.alias("ask"),
        F.col("l_quantity").alias("bid_volume"),
        F.col("l_quantity").alias("ask_volume"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        month_of(ts).alias("month"),
    )


def ticks_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as seven years of ticks of one symbol; timestamps repeat."""
    return _line_ticks(table(spark, sf_dir, "lineitem"), F.lit("L"))


def ticks_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ticks, one symbol per supplier."""
    return _line_ticks(
        table(spark, sf_dir, "lineitem"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    )
