"""Model registry, leaderboard and run history as tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

ENTRY_DDL = (
    "backend string, symbol string, tf string, label string, registered_at double, "
    "metrics map<string,double>, feature_columns array<string>, artifact_path string"
)


#: Columns that an entry cannot do without.
REQUIRED = ("backend", "symbol", "tf", "label", "registered_at")


def entry(spark: SparkSession, *, metrics: Mapping[str, object], **facts: object) -> DataFrame:
    """One registry row from the columns of ``ENTRY_DDL``; metrics that are no numbers are left out, columns not given are NULL."""
    missing = [c for c in REQUIRED if facts.get(c) in (None, "")]
    if missing:
        raise ValueError(f"a registry entry needs {missing}")
    plain = spark.createDataFrame([{**facts, "metrics": json.dumps(metrics, default=str)}], ENTRY_DDL.replace("map<string,double>", "string"))
    number = F.transform_values(F.from_json("metrics", "map<string,string>"), lambda _, v: v.try_cast("double"))
    return plain.withColumn("metrics", F.map_filter(number, lambda _, v: v.isNotNull()))


def append(entries: DataFrame, path: str) -> None:
    """Add entries to the stored registry; earlier ones are never rewritten."""
    entries.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENTRY_DDL).parquet(path)


def parse_metric_files(documents: DataFrame, column: str = "value") -> DataFrame:
    """``name, metric, value`` of JSON objects of metrics, one per row; fields that are no numbers are left out."""
    fields = F.explode(F.from_json(column, "map<string,string>")).alias("metric", "text")
    return documents.select("name", fields).select(
        "name", "metric", F.expr("try_cast(text AS double)").alias("value")).where(F.col("value").isNotNull())


def list_models(registry: DataFrame, **equal: object) -> DataFrame:
    """Entries whose columns have the given values; a value of None asks for nothing."""
    asked = {c: v for c, v in equal.items() if v is not None}
    return registry.where(F.struct(*asked) == F.struct(*[F.lit(v).alias(c) for c, v in asked.items()])) if asked else registry


def leaderboard(
    registry: DataFrame, metric: str = "best_cv_f1_macro", by: Sequence[str] = ("symbol", "tf", "label")
) -> DataFrame:
    """Entries that have the metric, ranked per group; the earlier entry wins a tie."""
    scored = registry.withColumn("score", F.try_element_at("metrics", F.lit(metric))).where(
        F.col("score").isNotNull())
    w = W.partitionBy(*by).orderBy(F.desc("score"), "registered_at")
    return scored.withColumn("rank", F.row_number().over(w))


def best_models(registry: DataFrame, metric: str = "best_cv_f1_macro", **kw) -> DataFrame:
    return leaderboard(registry, metric, **kw).where(F.col("rank") == 1)


def run_history(
    log: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("backend",), ties: Sequence[str] = ()
) -> DataFrame:
    """Run-log rows numbered per backend in time order (``ties`` orders equal times), with the chosen metrics."""
    w = W.partitionBy(*by).orderBy("ts", *ties)
    return log.select(*by, "ts", *metrics, (F.row_number().over(w) - 1).alias("run_index"))


def parse_run_log(
    lines: DataFrame, metrics: Sequence[str], column: str = "value", names: Sequence[str] = ()
) -> DataFrame:
    """Run-log JSON lines (``ts, backend``, text fields ``names`` and metrics) as columns; bad lines become null rows."""
    ddl = ", ".join(["ts double", "backend string", *(f"{n} string" for n in names), *(f"{m} double" for m in metrics)])
    return lines.select(F.from_json(column, ddl).alias("r")).select("r.*")


def metrics_long(registry: DataFrame) -> DataFrame:
    """One row per entry and metric."""
    return registry.select(
        "backend", "symbol", "tf", "label", F.explode("metrics").alias("metric", "value"))
