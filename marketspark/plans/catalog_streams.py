"""Queries that drain a stream over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.operators import drift
from marketspark.plans import sqlparts as S
from marketspark.plans.catalog_models import _DF, _MR, FEATURES, SPLIT, _drift_sides, _model_rows, drift_report_sql
from marketspark.plans.registry import query, tidy, tidy_sql
from marketspark.session import scratch_path, stage
from marketspark.sources import views
from marketspark.streaming import streams
from marketspark.streaming.silence import silence_alerts

_PART = "CASE WHEN year(timestamp) < 1994 THEN 0 WHEN year(timestamp) < 1996 THEN 1 ELSE 2 END"
_BAR = ["open", "high", "low", "close", "volume"]


def _events(spark, sf):
    schema = views.table(spark, sf, "events").schema
    return streams.tick_stream(spark, f"{sf}/events.parquet", schema)


def _ticks(spark, sf, symbol=None):
    return views._event_ticks(_events(spark, sf), symbol if symbol is not None else F.lit("ALL"))


@query("stream_resample", "K1", tidy_sql(S.with_ctes(S.BARS_1H) + """
SELECT * FROM b WHERE timestamp + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
    _BAR, ["symbol", "timestamp", "tick_count"]))
def stream_resample(spark, sf):
    bars = streams.bar_stream(_ticks(spark, sf))
    return tidy(streams.run_to_table(bars, scratch_path(spark, "bars")),
                ["symbol", "timestamp", *_BAR, "tick_count"])


@query("stream_dedupe", "K2", S.with_ctes(S.TICKS_BY_TYPE) + """
SELECT DISTINCT symbol, time_bucket(INTERVAL '1 minute', timestamp) AS timestamp FROM ticks_by_type""")
def stream_dedupe(spark, sf):
    # Minute resolution makes timestamps repeat.
    ticks = _ticks(spark, sf, F.col("event_type")).select(
        "symbol", F.window("timestamp", "1 minute")["start"].alias("timestamp"))
    return streams.run_to_table(streams.dedupe_stream(ticks), scratch_path(spark, "ticks"))


_SILENCE_HOURS = 24


@query("stream_gaps", "K3", f"""
WITH t AS (SELECT 'U' || user_id AS symbol, ts AS t, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events),
m AS (SELECT *, (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR FROM events) AS mark FROM t),
s AS (
  SELECT *, epoch_us(t) // ({_SILENCE_HOURS} * 3600000000) AS slot, epoch_us(n) // ({_SILENCE_HOURS} * 3600000000) AS next_slot,
    epoch_us(mark) // ({_SILENCE_HOURS} * 3600000000) AS open_slot
  FROM m WHERE n IS NULL OR n - t > INTERVAL {_SILENCE_HOURS} HOUR)
SELECT symbol, 'silent' AS kind, t AS gap_start, CAST(NULL AS TIMESTAMP) AS gap_end, CAST(NULL AS DOUBLE) AS hours
FROM s WHERE slot < open_slot AND t + INTERVAL {_SILENCE_HOURS} HOUR <= mark
UNION ALL
SELECT symbol, 'returned', t, n, round(epoch_us(n - t) / 3600000000.0, 6) + 0.0 FROM s WHERE next_slot < open_slot""")
def stream_gaps(spark, sf):
    """Users as symbols: some return after a day of silence, some never do. Four deliveries, each drained by a run of its own."""
    ticks = views._event_ticks(views.table(spark, sf, "events"), F.concat(F.lit("U"), F.col("user_id"))).select(
        "symbol", "timestamp")
    source, out = scratch_path(spark, "ticks"), scratch_path(spark, "silences")
    week = F.least(F.floor((F.dayofmonth("timestamp") - 1) / 8), F.lit(3))
    with streams.keyed_state(spark):
        for k in range(4):
            ticks.where(week == k).write.mode("append").parquet(source)
            alerts = silence_alerts(streams.tick_stream(spark, source, ticks.schema), limit_hours=_SILENCE_HOURS)
            found = streams.run_to_table(alerts, out)
    return tidy(found, ["symbol", "kind", "gap_start", "gap_end", "hours"])


#: Three live batches by time; a feature's rows meet the whole reference in each.
_LIVE = "CASE WHEN timestamp < TIMESTAMP '1999-07-01' THEN 0 WHEN timestamp < TIMESTAMP '2000-07-01' THEN 1 ELSE 2 END"
_BATCHED = "lr AS (" + " UNION ALL ".join(
    f"SELECT '{f}#' || b AS feature, CAST({f} AS DOUBLE) AS v, timestamp < {SPLIT} AS ref FROM ba, (VALUES (0), (1), (2)) t(b) "
    f"WHERE {f} IS NOT NULL AND (timestamp < {SPLIT} OR {_LIVE} = b)" for f in _DF) + ")"


@query("stream_drift", "K4", drift_report_sql(
    _BATCHED, "split_part(feature, '#', 1) AS feature, split_part(feature, '#', 2)::INT AS batch"))
def stream_drift(spark, sf):
    reference, live = _drift_sides(spark, sf)
    live = live.select("timestamp", *_DF)
    stored, source, out, checkpoint = (scratch_path(spark, x) for x in ("reference", "live", "drift", "checkpoint"))
    drift.save_reference(reference, _DF, stored)
    part = F.expr(_LIVE.replace("TIMESTAMP", "TIMESTAMP_NTZ"))
    for k in range(3):
        live.where(part == k).write.mode("append").parquet(source)
        stream = streams.tick_stream(spark, source, live.schema)
        streams.run_batches(stream, streams.drift_batches(stored, _DF, out), checkpoint=checkpoint)
    return tidy(spark.read.parquet(out), ["feature", "batch", "ks_stat", "ks_p", "psi", "drifted"])


@query("stream_online", "K5", S.with_ctes(*_MR) + f"""
SELECT symbol, count(*) FILTER (part > first) AS scored, 1 AS sound FROM (
  SELECT symbol, {_PART} AS part, min({_PART}) OVER (PARTITION BY symbol) AS first FROM mr)
GROUP BY symbol HAVING count(*) FILTER (part > first) > 0""")
def stream_online(spark, sf):
    rows = stage(_model_rows(spark, sf).select("symbol", "timestamp", *FEATURES, "y"), "rows")
    source, folder, checkpoint = (scratch_path(spark, x) for x in ("rows", "online", "checkpoint"))
    year = F.year("timestamp")
    part = F.when(year < 1994, 0).when(year < 1996, 1).otherwise(2)
    # Three deliveries, each drained by a scheduled run that resumes the same checkpoint.
    for k in range(3):
        rows.where(part == k).coalesce(1).write.mode("append").parquet(source)
        stream = streams.tick_stream(spark, source, rows.schema)
        streams.run_batches(stream, streams.online_batches(folder, FEATURES), checkpoint=checkpoint)
    scored = spark.read.schema("symbol string, y int, prediction int").parquet(f"{folder}/scored")
    return scored.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("scored"), F.min(F.col("prediction").between(0, 4).cast("int")).alias("sound"))
