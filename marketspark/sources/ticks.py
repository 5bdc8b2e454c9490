"""Tick sources: canonical tick frames and the hourly binary tick files."""

from __future__ import annotations

import lzma
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.timecols import from_millis, month_of

# One record of an hourly tick file, 20 bytes, big endian.
TICK_RECORD = np.dtype([
    ("offset_ms", ">u4"),
    ("ask_milli", ">u4"),
    ("bid_milli", ">u4"),
    ("ask_volume", ">f4"),
    ("bid_volume", ">f4"),
])

_DECODED = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("offset_ms", T.LongType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("ask_volume", T.DoubleType()),
    T.StructField("bid_volume", T.DoubleType()),
    T.StructField("seq", T.LongType()),
    T.StructField("error", T.StringType()),
])


def to_ticks(
    df: DataFrame,
    *,
    symbol: str | None = None,
    timestamp: str = "timestamp",
    seq: str | None = None,
) -> DataFrame:
    """Canonical tick columns: UTC ``timestamp_ntz`` in microseconds plus ``month``.

    Zone-aware input is converted to UTC, zone-less input is taken as UTC.
    ``symbol`` sets a constant; otherwise the frame must have that column.
    """
    ts = F.col(timestamp).cast("timestamp_ntz")
    return df.select(
        (F.lit(symbol) if symbol is not None else F.col("symbol")).alias("symbol"),
        ts.alias("timestamp"),
        F.col("bid").cast("double").alias("bid"),
        F.col("ask").cast("double").alias("ask"),
        F.col("bid_volume").cast("double").alias("bid_volume"),
        F.col("ask_volume").cast("double").alias("ask_volume"),
        (F.col(seq).cast("long") if seq else F.lit(None).cast("long")).alias("seq"),
        month_of(ts).alias("month"),
    )


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        frames = [_decode_file(p, bytes(c)) for p, c in zip(batch["path"], batch["content"])]
        yield pd.concat([f for f in frames if len(f)] or frames[:1])


def _decode_file(path: str, content: bytes) -> pd.DataFrame:
    error = None
    records = np.empty(0, TICK_RECORD)
    if content:
        try:
            raw = lzma.decompress(content)
            records = np.frombuffer(raw[: len(raw) // 20 * 20], TICK_RECORD)
        except lzma.LZMAError as exc:
            error = str(exc) or "not an LZMA stream"
    if error is not None:
        return pd.DataFrame({
            "path": [path], "offset_ms": [None], "ask": [None], "bid": [None],
            "ask_volume": [None], "bid_volume": [None], "seq": [None], "error": [error],
        })
    return pd.DataFrame({
        "path": path,
        "offset_ms": records["offset_ms"].astype("int64"),
        "ask": records["ask_milli"] / 1000.0,
        "bid": records["bid_milli"] / 1000.0,
        "ask_volume": records["ask_volume"].astype("float64"),
        "bid_volume": records["bid_volume"].astype("float64"),
        "seq": np.arange(len(records), dtype="int64"),
        "error": pd.Series([None] * len(records), dtype=object),
    })


def decode_tick_files(files: DataFrame) -> DataFrame:
    """One row per tick from hourly files given as ``(path, content)`` rows.

    ``files`` is what the ``binaryFile`` reader yields. The hour comes from the
    path ``…/{symbol}/{YYYY}/{MM}/{DD}/{HH}h_ticks.bi5`` where ``MM`` counts
    from 00. A file that cannot be decoded yields one row with ``error`` set
    instead of failing the job; split on that column for the side output.
    """
    pattern = r"([^/]+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})h_ticks\.bi5$"
    rows = files.select("path", "content").mapInPandas(_decode, _DECODED)

    def part(group: int):
        return F.regexp_extract("path", pattern, group)

    hour = F.make_timestamp_ntz(
        part(2).cast("int"), part(3).cast("int") + 1, part(4).cast("int"),
        part(5).cast("int"), F.lit(0), F.lit(0).cast("decimal(16,6)"),
    )
    base_ms = F.unix_millis(hour.cast("timestamp"))
    return rows.select(
        part(1).alias("symbol"),
        from_millis(base_ms + F.col("offset_ms")).alias("timestamp"),
        "bid", "ask", "bid_volume", "ask_volume", "seq", "path", "error",
    )


def read_tick_files(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Decoded ticks below ``root`` and, separately, the files that failed."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.bi5")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    decoded = decode_tick_files(files)
    good = decoded.where(F.col("error").isNull()).drop("error", "path")
    bad = decoded.where(F.col("error").isNotNull()).select("path", "error")
    return good, bad
