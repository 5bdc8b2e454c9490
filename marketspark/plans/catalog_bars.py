"""Queries over sources, filters, bars and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.operators import bars, labels, quality, select
from marketspark.plans import sqlparts as S
from marketspark.plans.common import bars_1d, bars_1h, bars_4h, labelled_1h, labelled_1w
from marketspark.plans.registry import query, tidy, tidy_sql
from marketspark.sources import store, ticks, views

_BAR = ["open", "high", "low", "close", "volume"]
_TICK = ["bid", "ask", "bid_volume", "ask_volume"]


@query("ticks_view", "A5", tidy_sql(
    S.with_ctes(S.TICKS_ALL) + "SELECT * FROM ticks_all", _TICK, ["symbol", "timestamp", "seq"]))
def ticks_view(spark, sf):
    raw = views.ticks_all(spark, sf)
    df = ticks.to_ticks(raw.drop("month"), seq="seq")
    return tidy(df, ["symbol", "timestamp", *_TICK, "seq"])


@query("resample_1h", "C1", tidy_sql(
    S.with_ctes(S.BARS_1H) + "SELECT * FROM b", _BAR, ["symbol", "timestamp", "tick_count"]))
def resample_1h(spark, sf):
    return tidy(bars_1h(spark, sf), ["symbol", "timestamp", *_BAR, "tick_count"])


@query("resample_4h_by_symbol", "C1", tidy_sql(
    S.with_ctes(S.BARS_4H) + "SELECT * FROM b", _BAR, ["symbol", "timestamp", "tick_count"]))
def resample_4h_by_symbol(spark, sf):
    return tidy(bars_4h(spark, sf), ["symbol", "timestamp", *_BAR, "tick_count"])


@query("resample_1d_ties", "C1", tidy_sql(
    S.with_ctes(S.BARS_1D) + "SELECT * FROM b", _BAR, ["symbol", "timestamp", "tick_count"]))
def resample_1d_ties(spark, sf):
    return tidy(bars_1d(spark, sf), ["symbol", "timestamp", *_BAR, "tick_count"])


_MULTI = {"5m": "5 minutes", "15m": "15 minutes", "30m": "30 minutes", "1H": "1 hour",
          "2H": "2 hours", "4H": "4 hours", "1D": "1 day", "1W": "7 days"}
_MULTI_SQL = S.with_ctes(
    S.TICKS_ALL,
    *[S.bars("ticks_all", f"b{i}", step) for i, step in enumerate(_MULTI.values())],
) + " UNION ALL ".join(f"SELECT *, '{tf}' AS tf FROM b{i}" for i, tf in enumerate(_MULTI))


@query("resample_multi_tf", "C2, C3",
       tidy_sql(_MULTI_SQL, _BAR, ["symbol", "tf", "timestamp", "tick_count"]))
def resample_multi_tf(spark, sf):
    df = bars.resample_many(views.ticks_all(spark, sf), list(_MULTI))
    return tidy(df, ["symbol", "tf", "timestamp", *_BAR, "tick_count"])


_ANCHOR_SQL = S.with_ctes(S.BARS_1D) + " UNION ALL ".join(
    f"""SELECT symbol, '{unit}' AS unit, strftime(date_trunc('{unit}', timestamp), '%Y-%m-%d') AS period,
        arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low,
        arg_max(close, timestamp) AS close FROM b GROUP BY ALL"""
    for unit in ("day", "week", "month", "quarter", "year"))


@query("anchor_ohlc", "C4", tidy_sql(_ANCHOR_SQL, _BAR[:4], ["symbol", "unit", "period"]))
def anchor_ohlc(spark, sf):
    base = bars_1d(spark, sf, staged=True)
    parts = [
        bars.anchor_ohlc(base, unit).withColumn("unit", F.lit(unit))
        for unit in ("day", "week", "month", "quarter", "year")
    ]
    return tidy(quality.union_ticks(*parts), ["symbol", "unit", "period", *_BAR[:4]])


@query("detect_gaps", "C5", S.with_ctes(S.TICKS_BY_TYPE, S.bars("ticks_by_type", "b", "1 hour", 1)) + """
SELECT symbol, p AS gap_start, timestamp AS gap_end,
       CAST(floor(epoch(timestamp - p) / 3600) AS BIGINT) AS gap_bars
FROM (SELECT symbol, timestamp, lag(timestamp) OVER (PARTITION BY symbol ORDER BY timestamp) AS p FROM b)
WHERE timestamp - p > INTERVAL 90 MINUTE""")
def detect_gaps(spark, sf):
    hourly = bars_1h(spark, sf, source=views.ticks_by_type, min_ticks=1, staged=True)
    return bars.detect_gaps(hourly, "1H")


_QA = """SELECT symbol, month, count(*) AS actual_rows,
  count(*) FILTER (timestamp IS NULL) + count(*) FILTER (ask IS NULL) + count(*) FILTER (bid IS NULL)
  + count(*) FILTER (ask_volume IS NULL) + count(*) FILTER (bid_volume IS NULL) AS nulls,
  count(*) FILTER (ask <= 0 OR bid <= 0) AS negative_price,
  count(*) FILTER (ask < bid) AS negative_spread,
  count(*) FILTER (ask_volume < 0 OR bid_volume < 0) AS negative_volume
FROM bad GROUP BY 1, 2"""
# Ticks with faults at known places: crossed, non-positive, negative and missing values.
_BAD = """bad AS (SELECT symbol, timestamp, month, seq,
  CASE WHEN seq % 97 = 0 THEN NULL ELSE bid END AS bid,
  CASE WHEN seq % 89 = 0 THEN bid - 1 ELSE ask END AS ask,
  CASE WHEN seq % 83 = 0 THEN -1 ELSE bid_volume END AS bid_volume, ask_volume FROM ticks_many)"""
_MANIFEST = """man AS (SELECT symbol, month, count(*) + CASE WHEN CAST(right(month, 2) AS INT) = 6 THEN 1 ELSE 0 END AS rows,
  CASE WHEN CAST(right(month, 2) AS INT) = 9 THEN 3 ELSE 0 END AS missing_hours
  FROM ticks_many WHERE CAST(right(month, 2) AS INT) <> 12 GROUP BY 1, 2
  UNION ALL SELECT DISTINCT symbol, '1990-01', 5000, 700 FROM ticks_many WHERE seq % 7 = 0)"""


def _bad_ticks(spark, sf):
    t = views.ticks_many(spark, sf)
    seq = F.col("seq")
    return t.withColumns({
        "ask": F.when(seq % 89 == 0, F.col("bid") - 1).otherwise(F.col("ask")),
        "bid": F.when(seq % 97 != 0, F.col("bid")),
        "bid_volume": F.when(seq % 83 == 0, -1.0).otherwise(F.col("bid_volume")),
    })


def _manifest(spark, sf):
    number = F.month("month")
    ticks = views.ticks_many(spark, sf)
    known = ticks.where(number != 12).groupBy("symbol", "month").agg(F.count(F.lit(1)).alias("rows")).select(
        "symbol", "month",
        (F.col("rows") + F.when(number == 6, 1).otherwise(0)).alias("rows"),
        F.when(number == 9, 3).otherwise(0).alias("missing_hours"))
    # A month of which no tick was ever stored.
    lost = ticks.where("seq % 7 = 0").select("symbol").distinct().select(
        "symbol", F.lit("1990-01-01").cast("date").alias("month"), F.lit(5000).cast("long").alias("rows"),
        F.lit(700).alias("missing_hours"))
    return known.unionByName(lost)


def _month_text(df):
    return df.withColumn("month", F.date_format("month", "yyyy-MM"))


@query("qa_integrity", "C6", S.with_ctes(S.TICKS_MANY, _BAD) + _QA)
def qa_integrity(spark, sf):
    return _month_text(quality.integrity_counts(_bad_ticks(spark, sf)))


_JOINED = S.with_ctes(S.TICKS_MANY, _BAD, _MANIFEST, f"qa AS ({_QA})", """j AS (
  SELECT qa.*, coalesce(man.rows, -1) AS expected_rows, coalesce(man.missing_hours, 0) AS missing_hours
  FROM qa LEFT JOIN man USING (symbol, month)),
 hrs AS (SELECT symbol, CAST(sum(missing_hours) AS BIGINT) AS hours FROM man GROUP BY symbol), f AS (SELECT *, (nulls > 0 OR negative_price > 0
  OR negative_spread > 0 OR negative_volume > 0 OR missing_hours > 0
  OR (expected_rows <> -1 AND actual_rows <> expected_rows)) AS odd FROM j)""")


@query("qa_anomalous_months", "C7", _JOINED + "SELECT * EXCLUDE (odd) FROM f WHERE odd")
def qa_anomalous_months(spark, sf):
    counts = quality.integrity_counts(_bad_ticks(spark, sf))
    return _month_text(quality.anomalous_months(counts, _manifest(spark, sf)))


@query("qa_summary", "C9", _JOINED + """
SELECT symbol, count(*) AS months, CAST(sum(actual_rows) AS BIGINT) AS total_rows,
  CAST(sum(nulls) AS BIGINT) AS total_nulls, CAST(sum(negative_price) AS BIGINT) AS total_negative_price,
  CAST(sum(negative_spread) AS BIGINT) AS total_negative_spread,
  CAST(sum(negative_volume) AS BIGINT) AS total_negative_volume,
  coalesce(max(hours), 0) AS total_missing_hours,
  count(*) FILTER (odd) AS anomalous_months,
  CASE WHEN sum(nulls) = 0 AND sum(negative_price) = 0 AND sum(negative_spread) = 0 THEN 'READY' ELSE 'WARNING' END AS status
FROM f LEFT JOIN hrs USING (symbol) GROUP BY symbol""")
def qa_summary(spark, sf):
    counts = quality.integrity_counts(_bad_ticks(spark, sf))
    return quality.audit_summary(counts, _manifest(spark, sf))


def _gap_sql(where: str) -> str:
    return S.with_ctes(S.TICKS_MANY, f"""g AS (SELECT symbol, month, p, timestamp AS e FROM (
  SELECT symbol, month, timestamp,
         lag(timestamp) OVER (PARTITION BY symbol, month ORDER BY timestamp, seq) AS p FROM ticks_many)
  WHERE timestamp - p > INTERVAL 1 HOUR {where})""") + """
SELECT symbol, month, strftime(p, '%Y-%m-%d %H:%M') AS start, strftime(e, '%Y-%m-%d %H:%M') AS "end",
  round_even(epoch(e - p) / 3600, 2) AS duration_h, strftime(p, '%a') AS day FROM g"""


_FX = """AND isodow(p) <> 6 AND NOT (isodow(p) = 5 AND hour(p) >= 21)
  AND timestamp - p > INTERVAL 65 MINUTE"""


@query("qa_gaps_fx", "C8", _gap_sql(_FX))
def qa_gaps_fx(spark, sf):
    return _month_text(quality.significant_gaps(views.ticks_many(spark, sf), "fx"))


@query("qa_gaps_missing_months", "C8", S.with_ctes(S.TICKS_MANY, _MANIFEST, """g AS (
  SELECT symbol, month, p, timestamp AS e FROM (SELECT symbol, month, timestamp,
         lag(timestamp) OVER (PARTITION BY symbol, month ORDER BY timestamp, seq) AS p FROM ticks_many
         SEMI JOIN (SELECT * FROM man WHERE missing_hours > 0) USING (symbol, month))
  WHERE timestamp - p > INTERVAL 1 HOUR)""") + """
SELECT symbol, month, strftime(p, '%Y-%m-%d %H:%M') AS start, strftime(e, '%Y-%m-%d %H:%M') AS "end",
  round_even(epoch(e - p) / 3600, 2) AS duration_h, strftime(p, '%a') AS day FROM g""")
def qa_gaps_missing_months(spark, sf):
    ticks = quality.months_with_missing_hours(views.ticks_many(spark, sf), _manifest(spark, sf))
    return _month_text(quality.significant_gaps(ticks, "crypto"))


@query("qa_gaps_crypto", "C8", _gap_sql(""))
def qa_gaps_crypto(spark, sf):
    return _month_text(quality.significant_gaps(views.ticks_many(spark, sf), "crypto"))


@query("top_gaps", "B9", _gap_sql("") + " ORDER BY duration_h DESC, symbol, start LIMIT 30")
def top_gaps(spark, sf):
    return _month_text(quality.top_gaps(quality.significant_gaps(views.ticks_many(spark, sf), "crypto")))


_SLOTS = """slots AS (SELECT month, unnest(generate_series(CAST(month || '-01' AS TIMESTAMP),
  CAST(month || '-01' AS TIMESTAMP) + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS slot
  FROM (SELECT DISTINCT month FROM {src}))"""


@query("calendar_slots", "C10", S.with_ctes(S.TICKS_LONG, _SLOTS.format(src="ticks_long")) + """
SELECT 'fx' AS asset, month, slot FROM slots
WHERE isodow(slot) <> 6 AND NOT (isodow(slot) = 7 AND hour(slot) < 21)
UNION ALL SELECT 'crypto', month, slot FROM slots""")
def calendar_slots(spark, sf):
    months = views.ticks_long(spark, sf).select("month").distinct()
    return _month_text(quality.union_ticks(*[
        quality.calendar_slots(months, a).withColumn("asset", F.lit(a)) for a in ("fx", "crypto")
    ]))


_MISSING = """miss AS (SELECT m.symbol, m.month, s.slot FROM (SELECT DISTINCT symbol, month FROM {src}) m
  JOIN (SELECT DISTINCT month, slot FROM slots) s USING (month)
  WHERE isodow(s.slot) < 6 AND NOT EXISTS (SELECT 1 FROM {src} t WHERE t.symbol = m.symbol
    AND date_trunc('hour', t.timestamp) = s.slot))"""


@query("missing_slots", "C11, C12", S.with_ctes(
    S.TICKS_BY_TYPE, _SLOTS.format(src="ticks_by_type"), _MISSING.format(src="ticks_by_type"))
    + "SELECT symbol, month, slot FROM miss")
def missing_slots(spark, sf):
    return _month_text(quality.missing_slots(views.ticks_by_type(spark, sf))).select(
        "symbol", "month", "slot")


_DUP = """dup AS (SELECT * FROM ticks_all UNION ALL
  SELECT symbol, timestamp, bid + 1, ask + 1, bid_volume, ask_volume, seq + 1000000000, month
  FROM ticks_all WHERE seq % 3 = 0)"""


def _duplicated(spark, sf):
    t = views.ticks_all(spark, sf)
    again = t.where(F.col("seq") % 3 == 0).withColumns({
        "bid": F.col("bid") + 1, "ask": F.col("ask") + 1, "seq": F.col("seq") + 1_000_000_000})
    return quality.union_ticks(t, again)


@query("dedupe_ticks", "B6", tidy_sql(S.with_ctes(S.TICKS_ALL, _DUP) + """
SELECT * FROM dup QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY seq) = 1""",
    _TICK, ["symbol", "timestamp", "seq"]))
def dedupe_ticks(spark, sf):
    return tidy(quality.dedupe_ticks(_duplicated(spark, sf)), ["symbol", "timestamp", *_TICK, "seq"])


_LOOSE = """loose AS (SELECT symbol, date_trunc('day', timestamp) AS timestamp, bid, ask, bid_volume, ask_volume FROM ticks_by_type)"""


def _unnumbered(spark, sf):
    """Ticks without arrival numbers whose timestamps repeat."""
    t = views.ticks_by_type(spark, sf)
    return ticks.to_ticks(t.withColumn("timestamp", F.date_trunc("day", F.col("timestamp").cast("timestamp"))))


@query("dedupe_no_seq", "B6, A5", tidy_sql(S.with_ctes(S.TICKS_BY_TYPE, _LOOSE) + """
SELECT * FROM loose QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY bid, ask, bid_volume, ask_volume) = 1""",
    _TICK, ["symbol", "timestamp"]))
def dedupe_no_seq(spark, sf):
    return tidy(quality.dedupe_ticks(_unnumbered(spark, sf)), ["symbol", "timestamp", *_TICK])


@query("resample_no_seq", "C1, A5", tidy_sql(S.with_ctes(S.TICKS_BY_TYPE, _LOOSE) + """
SELECT symbol, timestamp, min((bid + ask) / 2) AS open, max((bid + ask) / 2) AS high, min((bid + ask) / 2) AS low,
  max((bid + ask) / 2) AS close, sum((ask_volume + bid_volume) / 2) AS volume, count(*) AS tick_count
FROM loose GROUP BY 1, 2 HAVING count(*) >= 5""", _BAR, ["symbol", "timestamp", "tick_count"]))
def resample_no_seq(spark, sf):
    # Every tick of a day has one timestamp, so the price alone orders them.
    return tidy(bars.resample(_unnumbered(spark, sf), "1D"), ["symbol", "timestamp", *_BAR, "tick_count"])


@query("union_ticks", "B7", tidy_sql(
    S.with_ctes(S.TICKS_ALL, S.TICKS_BY_TYPE)
    + "SELECT * FROM ticks_all UNION ALL SELECT * FROM ticks_by_type", _TICK, ["symbol", "timestamp", "seq"]))
def union_ticks(spark, sf):
    both = quality.union_ticks(views.ticks_all(spark, sf), views.ticks_by_type(spark, sf))
    return tidy(both, ["symbol", "timestamp", *_TICK, "seq"])


_SPLIT_FX = """base AS (SELECT * FROM ticks_all WHERE hour(timestamp) < 20),
 patch AS (SELECT symbol, timestamp, bid + 5 AS bid, ask + 5 AS ask, bid_volume, ask_volume, seq, month
  FROM ticks_all WHERE hour(timestamp) >= 18),
 merged AS (SELECT * EXCLUDE (r) FROM (SELECT *, 0 AS r FROM base UNION ALL SELECT *, 1 FROM patch)
  QUALIFY row_number() OVER (PARTITION BY symbol, timestamp ORDER BY r, seq) = 1)"""


def _base_and_patch(spark, sf):
    t = views.ticks_all(spark, sf)
    hour = F.hour("timestamp")
    patch = t.where(hour >= 18).withColumns({"bid": F.col("bid") + 5, "ask": F.col("ask") + 5})
    return t.where(hour < 20), patch


@query("merge_patch", "C13", tidy_sql(
    S.with_ctes(S.TICKS_ALL, _SPLIT_FX) + "SELECT * FROM merged", _TICK, ["symbol", "timestamp", "seq"]))
def merge_patch(spark, sf):
    return tidy(quality.merge_patch(*_base_and_patch(spark, sf)),
                ["symbol", "timestamp", *_TICK, "seq"])


@query("merge_coverage", "C12, C13", S.with_ctes(
    S.TICKS_ALL, _SPLIT_FX,
    _SLOTS.format(src="ticks_all"),
    _MISSING.format(src="base").replace("miss AS", "m0 AS"),
    _MISSING.format(src="merged").replace("miss AS", "m1 AS")) + """
SELECT 'ALL' AS symbol, (SELECT count(*) FROM base) AS rows_before, (SELECT count(*) FROM m0) AS missing_before,
  (SELECT count(*) FROM merged) AS rows_after, (SELECT count(*) FROM m1) AS missing_after""")
def merge_coverage(spark, sf):
    base, patch = _base_and_patch(spark, sf)
    return quality.coverage_after_merge(base, quality.merge_patch(base, patch))


@query("scan_labelled", "A1, A2, A3", tidy_sql(
    S.with_ctes(*S.LABELLED_1H) + "SELECT * FROM lab WHERE symbol = 'ALL'",
    [*_BAR, "atr_14", "close_ahead_10"], ["symbol", "timestamp", "tick_count", "label_10"]))
def scan_labelled(spark, sf):
    path = store.new_table_path(spark, "labels")
    store.write_table(labelled_1h(spark, sf, staged=False).withColumn("tf", F.lit("1H")), path)
    df = store.read_table(spark, path, symbol="ALL", tf="1H")
    return tidy(df, ["symbol", "timestamp", *_BAR, "tick_count", "atr_14", "close_ahead_10", "label_10"])


@query("month_range_filter", "A8", tidy_sql(
    S.with_ctes(S.BARS_1D) + "SELECT * FROM b WHERE month BETWEEN '1996-03' AND '1997-02'",
    _BAR, ["symbol", "timestamp", "tick_count"]))
def month_range_filter(spark, sf):
    path = store.new_table_path(spark, "bars")
    store.write_table(bars_1d(spark, sf).withColumn("tf", F.lit("1D")), path)
    df = store.month_range(store.read_table(spark, path, tf="1D"), "1996-03", "1997-02")
    return tidy(df, ["symbol", "timestamp", *_BAR, "tick_count"])


@query("changed_partitions", "A11", S.with_ctes(S.TICKS_LONG) + """
SELECT symbol, month, count(*) AS n FROM ticks_long
WHERE CAST(right(month, 2) AS INT) IN (3, 11) GROUP BY 1, 2""")
def changed_partitions(spark, sf):
    old = views.ticks_long(spark, sf)
    number = F.month("month")
    # March has a corrected price, November lost a tick's volume.
    new = old.withColumns({
        "ask": F.when(number == 3, F.col("ask") + 0.5).otherwise(F.col("ask")),
        "ask_volume": F.when(number != 11, F.col("ask_volume")),
    })
    keys = ("symbol", "month")
    done = store.fingerprints(old, keys)
    changed = store.changed_partitions(store.fingerprints(new, keys), done, keys)
    return _month_text(changed.select("symbol", "month", F.col("rows").alias("n")))


@query("manifest_months", "A12", S.with_ctes(S.TICKS_LONG, """m AS (
  SELECT month, count(*) AS n FROM ticks_long GROUP BY 1)""") + """
SELECT month, CASE WHEN CAST(left(month, 4) AS INT) < 1998 THEN -1 ELSE n END AS rows,
  0 AS missing_hours FROM m""")
def manifest_months(spark, sf):
    per_month = views.ticks_long(spark, sf).groupBy(F.date_format("month", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"))
    early = F.substring("month", 1, 4).cast("int") < 1998
    # Two state documents: the old list form and the current map form.
    legacy = per_month.where(early).agg(F.to_json(F.sort_array(F.collect_list("month"))).alias("value"))
    current = per_month.where(~early).agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct("month", F.struct(F.col("n").alias("rows"), F.lit(0).alias("missing_hours")))))).alias("value"))
    return store.parse_manifest(legacy.unionByName(current))


@query("manifest_inferred", "A12", S.with_ctes(S.TICKS_BY_TYPE) + """
SELECT symbol, month, count(*) + CASE WHEN symbol < 'm' THEN 5 ELSE 0 END AS rows,
  CASE WHEN symbol < 'm' THEN 2 ELSE 0 END AS missing_hours FROM ticks_by_type GROUP BY symbol, month""")
def manifest_inferred(spark, sf):
    t = views.ticks_by_type(spark, sf)
    # Some symbols were recorded when they were loaded; the others have ticks only.
    known = store.infer_manifest(t.where("symbol < 'm'")).select(
        "symbol", "month", (F.col("rows") + 5).alias("rows"), F.lit(2).alias("missing_hours"))
    path = store.new_table_path(spark, "manifest")
    store.write_manifest(known, path)
    return _month_text(store.complete_manifest(store.read_manifest(spark, path), t))


@query("decode_tick_files", "A6, A7", S.with_ctes(S.TICKS_ALL) + """
SELECT symbol, date_trunc('millisecond', timestamp) AS timestamp, round(ask, 3) + 0.0 AS ask, round(bid, 3) + 0.0 AS bid,
  ask_volume, bid_volume FROM ticks_all""")
def decode_tick_files(spark, sf):
    files = store.pack_tick_files(views.ticks_all(spark, sf))
    good = ticks.decode_tick_files(files).where(F.col("error").isNull())
    return tidy(good, ["symbol", "timestamp", "ask", "bid", "ask_volume", "bid_volume"], 3)


@query("date_range_filter", "B1", tidy_sql(
    S.with_ctes(S.BARS_1H) + """SELECT * FROM b WHERE timestamp >= TIMESTAMP '2024-01-05'
  AND timestamp < TIMESTAMP '2024-01-13'""", _BAR, ["symbol", "timestamp", "tick_count"]))
def date_range_filter(spark, sf):
    df = select.date_range(bars_1h(spark, sf), "20240105", "20240112")
    return tidy(df, ["symbol", "timestamp", *_BAR, "tick_count"])


@query("feature_columns", "B3", S.with_ctes(*S.LABELLED_1W) + """
SELECT 'volume' AS feature, count(volume) AS n FROM lab UNION ALL SELECT 'atr_14', count(atr_14) FROM lab""")
def feature_columns(spark, sf):
    df = labelled_1w(spark, sf).drop("idx", "n")
    names = select.numeric_feature_columns(df)
    return df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "n")


@query("tail_n", "B8", tidy_sql(
    S.with_ctes(S.TICKS_BY_TYPE) + "SELECT * FROM ticks_by_type ORDER BY timestamp DESC, seq DESC LIMIT 5000",
    _TICK, ["symbol", "timestamp", "seq"]))
def tail_n(spark, sf):
    df = select.tail(views.ticks_by_type(spark, sf), 5000, "timestamp", "seq")
    return tidy(df, ["symbol", "timestamp", *_TICK, "seq"])


@query("chrono_split", "B11", S.with_ctes(S.BARS_1D) + """
SELECT symbol, timestamp, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1
  < CAST(floor(count(*) OVER (PARTITION BY symbol) * (1.0 - 0.2)) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM b""")
def chrono_split(spark, sf):
    return select.chrono_split(bars_1d(spark, sf, staged=True), 0.2).select("symbol", "timestamp", "split")


@query("signal_map", "B12, B13", S.with_ctes(*S.LABELLED_1W) + """
SELECT symbol, timestamp, CASE WHEN label_10 > 0 THEN 1 WHEN label_10 < 0 THEN -1 ELSE 0 END AS signal,
  label_10 + 2 AS encoded FROM lab""")
def signal_map(spark, sf):
    df = labelled_1w(spark, sf).drop("idx", "n")
    return df.select("symbol", "timestamp", select.label_to_signal("label_10").alias("signal"),
                     select.encode_label("label_10").alias("encoded"))


@query("bar_shape", "B15", tidy_sql(S.with_ctes(S.BARS_1H) + """
SELECT symbol, timestamp, high - low AS "range", abs(close - open) AS body,
  CAST(close > open AS INT) AS is_bullish FROM b""", ['"range"', "body"], ["symbol", "timestamp", "is_bullish"]))
def bar_shape(spark, sf):
    return tidy(select.bar_shape(bars_1h(spark, sf)),
                ["symbol", "timestamp", "range", "body", "is_bullish"])


@query("class_balance", "C14", S.with_ctes(*S.LABELLED_1W) + """
SELECT c.label, count(l.label_10) AS n,
  coalesce(round(count(l.label_10) / (SELECT nullif(count(label_10), 0) FROM lab), 4), 0.0) AS ratio
FROM (SELECT unnest([-2, -1, 0, 1, 2]) AS label) c LEFT JOIN lab l ON l.label_10 = c.label GROUP BY 1""")
def class_balance(spark, sf):
    return labels.class_balance(labelled_1w(spark, sf).drop("idx", "n"), "label_10")


@query("dataset_summary", "C15", S.with_ctes(*S.LABELLED_1W) + """
SELECT symbol, count(*) AS rows, 16 AS columns, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
  sum((atr_14 IS NULL)::INT + (a5 IS NULL)::INT + (a10 IS NULL)::INT + (a20 IS NULL)::INT
    + (label_5 IS NULL)::INT + (label_10 IS NULL)::INT + (label_20 IS NULL)::INT)::BIGINT AS null_cells
FROM lab GROUP BY symbol""")
def dataset_summary(spark, sf):
    return select.dataset_summary(labelled_1w(spark, sf).drop("idx", "n"))


_FEATS = ["volume", "tick_count", "atr_14", "close"]


@query("feature_corr", "C16", tidy_sql(S.with_ctes(*S.WITH_ATR_1W) + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, " + (f"CASE WHEN count({a}) > 0 THEN 1.0 END" if a == b else f"corr({a}, {b})") + " AS corr FROM ba"
    for i, a in enumerate(_FEATS) for b in _FEATS[i:]), ["corr"], ["a", "b"]))
def feature_corr(spark, sf):
    return tidy(select.correlations(labelled_1w(spark, sf).drop("idx", "n"), _FEATS))


@query("feature_quantiles", "C17", tidy_sql(S.with_ctes(*S.WITH_ATR_1W) + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS n, quantile_cont({c}, 0.0) AS p0, quantile_cont({c}, 0.25) AS p25,
  quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, quantile_cont({c}, 1.0) AS p100 FROM ba"""
    for c in _FEATS), ["p0", "p25", "p50", "p75", "p100"], ["feature", "n"]))
def feature_quantiles(spark, sf):
    from marketspark.functions.quantiles import feature_quantiles as fq

    return tidy(fq(labelled_1w(spark, sf).drop("idx", "n"), _FEATS, (0.0, 0.25, 0.5, 0.75, 1.0)))
