"""Structured Streaming forms of the tick operators.

Sources are Parquet tick folders; every stream runs with ``availableNow`` so a
scheduled job and a long-running one share the same code. State and checkpoints
live in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.timecols import micros
from marketspark.operators import drift
from marketspark.operators.bars import tick_order
from marketspark.operators.models import OnlineSoftmax
from marketspark.session import scratch_path, stage


def tick_stream(
    spark: SparkSession, path: str, schema: T.StructType, *, files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream over a Parquet table: one file, or a folder to which files are added."""
    reader = spark.readStream.schema(schema)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.getFileStatus(place).isFile():  # streams read folders, so pick the file in its own
        reader, path = reader.option("pathGlobFilter", place.getName()), place.getParent().toString()
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _event_time(ticks: DataFrame) -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone is UTC."""
    return ticks.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def bar_stream(
    ticks: DataFrame, window: str = "1 hour", *, watermark: str = "2 hours", min_ticks: int = 5,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Bars in append mode: a bar is emitted once the watermark passes its end; later ticks are dropped."""
    mid = (F.col("bid") + F.col("ask")) / 2
    at = tick_order(micros(F.col("timestamp")), mid, F.col("seq") if "seq" in ticks.columns else None)
    bars = (
        _event_time(ticks).withWatermark("timestamp", watermark)
        .groupBy(*keys, F.window("timestamp", window).alias("_w"))
        .agg(
            F.min_by(mid, at).alias("open"), F.max(mid).alias("high"), F.min(mid).alias("low"),
            F.max_by(mid, at).alias("close"),
            F.sum((F.col("ask_volume") + F.col("bid_volume")) / 2).alias("volume"),
            F.count(F.lit(1)).cast("int").alias("tick_count"),
        )
    )
    return bars.where(
        (F.col("tick_count") >= min_ticks) & (F.col("close") > 0) & (F.col("open") > 0)
    ).select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("timestamp"), "open", "high", "low", "close", "volume", "tick_count")


def dedupe_stream(
    ticks: DataFrame, *, watermark: str = "2 hours", keys: Sequence[str] = ("symbol", "timestamp")
) -> DataFrame:
    """One tick per key while its watermark lasts; the first to arrive stays."""
    kept = _event_time(ticks).withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(list(keys))
    return kept.select(*[
        F.col(c).cast("timestamp_ntz").alias(c) if c == "timestamp" else c for c in ticks.columns])


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which state with timers needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_to_table(stream: DataFrame, path: str, *, checkpoint: str | None = None) -> DataFrame:
    """Drain an append stream into a Parquet table and read that table back; the next run goes on from its checkpoint."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint or path.rstrip("/") + ".checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], *, checkpoint: str | None = None
) -> None:
    """Drain a stream through ``foreachBatch``."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def drift_batches(
    reference: str, features: Sequence[str], folder: str, **thresholds
) -> Callable[[DataFrame, int], None]:
    """Batch handler that tests every micro-batch against the distribution that ``drift.save_reference`` wrote to ``reference``."""

    def handle(batch: DataFrame, number: int) -> None:
        joint = drift.against_stored(batch.sparkSession, reference, batch, features)
        rows = drift.report(None, None, features, joint=joint, **thresholds)
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return handle


def online_batches(
    folder: str, features: Sequence[str], *, key: str = "symbol", order: str = "timestamp", y: str = "y", **options
) -> Callable[[DataFrame, int], None]:
    """Batch handler that scores each series' new rows with its model, then trains the model on them.

    Models are rows of ``folder/state/batch=<number>`` and predictions go to
    ``folder/scored/batch=<number>``; a repeated batch starts from the batch before
    it and rewrites its own files, so nothing is learned twice or lost.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kind = batch.schema[key].dataType.simpleString()
        state_ddl = f"{key} {kind}, model array<double>"
        rows_ddl = f"{state_ddl}, {y} int, prediction int"
        if number:
            old = spark.read.schema(state_ddl).parquet(f"{folder}/state/batch={number - 1}")
        else:
            old = spark.createDataFrame([], state_ddl)

        def learn(rows: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
            known = list(models["model"])
            if not len(rows):
                return models.assign(**{y: None, "prediction": None})
            width = len(features)
            model = OnlineSoftmax.from_row(known[0], width, **options) if known else OnlineSoftmax(width, **options)
            rows = rows.sort_values(order)
            guess = model.score_and_learn(rows[list(features)].to_numpy(float), rows[y].to_numpy())
            name = rows[key].iloc[0]
            out = [(name, model.to_row(), None, None)]
            if guess is not None:
                out += [(name, None, int(a), int(b)) for a, b in zip(rows[y], guess)]
            return pd.DataFrame(out, columns=[key, "model", y, "prediction"])

        joined = batch.select(key, order, *features, y).groupBy(key).cogroup(old.groupBy(key)).applyInPandas(
            learn, rows_ddl)
        done = stage(joined, "learned")
        done.where("prediction IS NOT NULL").select(key, y, "prediction").write.mode("overwrite").parquet(
            f"{folder}/scored/batch={number}")
        done.where("model IS NOT NULL").select(key, "model").write.mode("overwrite").parquet(
            f"{folder}/state/batch={number}")

    return handle
