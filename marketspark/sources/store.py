"""Month-partitioned tables: write, read, refresh what changed, manifests."""

from __future__ import annotations

import datetime as dt
import lzma
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.timecols import bucket_us, from_micros, micros
from marketspark.session import scratch_path, stage
from marketspark.sources.ticks import TICK_RECORD

PARTITIONS = ("symbol", "tf", "month")
PARTITION_TYPES = {"symbol": T.StringType(), "tf": T.StringType(), "month": T.DateType()}


def new_table_path(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)


def write_table(
    df: DataFrame, path: str, *, partitions: Sequence[str] = PARTITIONS, mode: str = "error",
    rows_per_file: int = 5_000_000,
) -> None:
    """Write a table partitioned by symbol, timeframe and month.

    Rows are clustered by the partition columns first so a month ends up in few
    files; adaptive execution splits clusters that are too large.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode(mode)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*partitions)
        .parquet(path)
    )


def overwrite_months(df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS) -> None:
    """Replace only the partitions present in ``df``."""
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def read_table(
    spark: SparkSession, path: str, *, symbol: str | None = None, tf: str | None = None,
    ignore_corrupt: bool = False,
) -> DataFrame:
    """Read a stored table; symbol and timeframe prune whole directories.

    Folder names say nothing of types (``1D`` looks like a number), so symbol and
    timeframe are read as text and the month as a date. ``ignore_corrupt`` skips
    unreadable files and keeps the rest. Rows carry no order: sort where the
    result is written, not here.
    """
    reader = spark.read
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    fields = [T.StructField(f.name, PARTITION_TYPES.get(f.name, f.dataType)) for f in reader.parquet(path).schema]
    df = reader.schema(T.StructType(fields)).parquet(path)
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    if tf is not None:
        df = df.where(F.col("tf") == tf)
    return df


def month_range(df: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Months ``YYYY-MM`` to ``YYYY-MM``, both included, pruned by directory."""
    def day(text: str) -> dt.date:
        return dt.datetime.strptime(text, "%Y-%m").date()

    if first:
        df = df.where(F.col("month") >= F.lit(day(first)))
    if last:
        df = df.where(F.col("month") <= F.lit(day(last)))
    return df


def fingerprints(df: DataFrame, keys: Sequence[str] = PARTITIONS) -> DataFrame:
    """Row count and order-free content hash per partition.

    Two hashes are combined by xor and sum, so a row repeated twice still counts.
    """
    content = [c for c in sorted(df.columns) if c not in keys]
    row = F.xxhash64(*content)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(row).alias("xor_hash"),
        F.sum(F.pmod(row, F.lit(1 << 31))).alias("sum_hash"),
    )


def changed_partitions(new: DataFrame, old: DataFrame, keys: Sequence[str] = PARTITIONS) -> DataFrame:
    """Partitions whose fingerprint is not the stored one."""
    return new.join(old, [*keys, "rows", "xor_hash", "sum_hash"], "left_anti")


def drop_partitions(keys: DataFrame, path: str) -> None:
    """Remove the folders of the given partitions; those that do not exist are passed over."""
    spark = keys.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in keys.toLocalIterator():
        folder = "/".join(f"{name}={escape(str(value))}" for name, value in row.asDict().items())
        place = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{folder}")
        place.getFileSystem(conf).delete(place, True)


def refresh(
    source: DataFrame,
    out_path: str,
    transform: Callable[[DataFrame], DataFrame],
    *,
    keys: Sequence[str] = PARTITIONS,
    force: bool = False,
) -> DataFrame:
    """Recompute only the months whose source rows changed; returns the counts.

    Partitions of changed months, and of months that left the source, are removed
    before the new ones are written, so a month whose result is empty leaves
    nothing behind. Fingerprints are taken in one scan and stored last: a run
    that dies in between is simply repeated.
    """
    spark = source.sparkSession
    marks = out_path.rstrip("/") + ".fingerprints"
    current = stage(fingerprints(source, keys), "fingerprints")
    try:
        stored = spark.read.parquet(marks)
        stored = stored.where(
            F.col("batch") == stored.agg(F.max("batch")).first()[0]
        ).drop("batch")
    except AnalysisException:
        stored = None
    todo = stage(current if force or stored is None else changed_partitions(current, stored, keys), "changed")
    gone = current.select(*keys).limit(0) if stored is None else stage(
        stored.select(*keys).join(current, list(keys), "left_anti"), "gone")
    total = current.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("rows"), F.lit(0)).alias("source_rows"))
    if not (todo.isEmpty() and gone.isEmpty()):
        drop_partitions(todo.select(*keys).union(gone), out_path)
        work = source.join(todo.select(*keys), list(keys), "left_semi")
        overwrite_months(transform(work), out_path, keys)
        number = dt.datetime.now(dt.UTC).strftime("%Y%m%d%H%M%S%f")
        current.withColumn("batch", F.lit(number)).write.mode("append").parquet(marks)
    return total.join(todo.agg(F.count(F.lit(1)).alias("processed"))).join(
        gone.agg(F.count(F.lit(1)).alias("removed"))).select(
        "processed", (F.col("total") - F.col("processed")).alias("skipped"), "source_rows", "removed"
    )


def parse_manifest(documents: DataFrame, column: str = "value") -> DataFrame:
    """``month, rows, missing_hours`` from manifest JSON documents.

    The old form, a list of months, says nothing about rows: -1 and 0 stand in.
    """
    text = F.col(column)
    is_list = F.ltrim(text).startswith("[")
    legacy = documents.where(is_list).select(
        F.explode(F.from_json(text, "array<string>")).alias("month"),
        F.lit(-1).cast("long").alias("rows"), F.lit(0).alias("missing_hours"),
    )
    current = documents.where(~is_list).select(
        F.explode(F.from_json(text, "map<string,struct<rows:bigint,missing_hours:int>>"))
        .alias("month", "state")
    ).select(
        "month", F.coalesce("state.rows", F.lit(-1)).alias("rows"),
        F.coalesce("state.missing_hours", F.lit(0)).alias("missing_hours"),
    )
    return legacy.unionByName(current)


def infer_manifest(df: DataFrame) -> DataFrame:
    """Manifest rows for stored months that have no recorded state."""
    return df.groupBy("symbol", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.lit(0).alias("missing_hours")
    )


def complete_manifest(manifest: DataFrame, ticks: DataFrame) -> DataFrame:
    """The recorded months, and inferred rows for stored months without a record."""
    inferred = infer_manifest(ticks)
    new = inferred.join(manifest, ["symbol", "month"], "left_anti")
    return manifest.select(*inferred.columns).unionByName(new)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One state document per symbol, ``{month: {rows, missing_hours}}``; a symbol has a few hundred months."""
    state = F.struct("rows", F.col("missing_hours").cast("int").alias("missing_hours"))
    entries = F.collect_list(F.struct(F.date_format("month", "yyyy-MM").alias("month"), state.alias("state")))
    manifest.groupBy("symbol").agg(
        F.to_json(F.map_from_entries(F.array_sort(entries))).alias("value")
    ).write.mode("overwrite").partitionBy("symbol").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``symbol, month, rows, missing_hours`` of all stored state documents."""
    text = spark.read.schema("value string, symbol string").text(path)
    months = F.from_json("value", "map<string,struct<rows:bigint,missing_hours:int>>")
    return text.select("symbol", F.explode(months).alias("month", "state")).select(
        "symbol", F.to_date(F.concat("month", F.lit("-01"))).alias("month"), "state.rows", "state.missing_hours")


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["_us", "seq"])
    records = np.empty(len(pdf), TICK_RECORD)
    records["offset_ms"] = (pdf["_us"] - pdf["_hour"]) // 1000
    records["ask_milli"] = np.rint(pdf["ask"] * 1000)
    records["bid_milli"] = np.rint(pdf["bid"] * 1000)
    records["ask_volume"] = pdf["ask_volume"]
    records["bid_volume"] = pdf["bid_volume"]
    return pd.DataFrame({"path": [pdf["_path"].iloc[0]], "content": [lzma.compress(records.tobytes(), lzma.FORMAT_ALONE, preset=0)]})


def pack_tick_files(ticks: DataFrame, root: str = "ticks") -> DataFrame:
    """Hourly tick files as ``(path, content)`` rows, the inverse of decoding.

    One row per symbol and hour, because that is what the format stores in a file.
    """
    us = micros(F.col("timestamp"))
    rows = ticks.select(
        "symbol", us.alias("_us"), bucket_us(us, 3600).alias("_hour"),
        "bid", "ask", "bid_volume", "ask_volume", "seq",
    )
    hour = from_micros(F.col("_hour"))
    path = F.format_string(
        "%s/%s/%s/%02d/%sh_ticks.bi5", F.lit(root), F.col("symbol"), F.date_format(hour, "yyyy"),
        F.month(hour) - 1, F.date_format(hour, "dd/HH"),
    )
    return rows.withColumn("_path", path).groupBy("_path").applyInPandas(
        _pack, "path string, content binary"
    )
