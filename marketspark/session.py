"""Spark session helpers and the stage writer used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "marketspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and skew-join handling switched on.

    Sizing knobs (executors, memory, shuffle partitions) are left to the
    cluster; pass them as keyword pairs through ``conf`` when needed.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results depend on, for a session we did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a fresh temporary folder: on a
    cluster the executors cannot see the driver's disk, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="spark-")
    return _local_dirs[app]


_written: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call has used; ``clear_scratch`` removes it."""
    path = f"{shared_dir(spark)}/marketspark/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove every intermediate table this application has written so far; returns how many.

    Call it when the results built on them have been stored: frames that still
    read an intermediate table fail afterwards.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)


def stage(df: DataFrame, label: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a derived table (bars, trades, an indexed series) feeds several
    branches of one plan: without it every branch would scan and aggregate the
    ticks again. The copy survives executor loss, keeps column pruning, and
    gives the optimizer true sizes when it decides about broadcasting.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # The schema also fixes the types of partition columns, which folder names would leave to guesses.
    return spark.read.schema(df.schema).parquet(path)
