"""Sources, stored tables, drift, scores and streams."""

import datetime as dt
import lzma
import os
import random
import struct
import tempfile

import numpy as np
import pytest
from helpers import bars_frame
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from marketspark.functions.scans import row_index
from marketspark.operators import backtest, bars, drift, evaluation, models, prep, quality, registry, scoring
from marketspark.functions.quantiles import feature_quantiles
from marketspark.sources import store, ticks
from marketspark.streaming import streams
from marketspark.streaming.silence import silence_alerts

TICK_DDL = ("symbol string, timestamp timestamp_ntz, bid double, ask double, bid_volume double, "
            "ask_volume double, seq long")


def tick_frame(spark, times, symbol="A"):
    rows = [(symbol, t, 10.0 + i, 10.2 + i, 1.0, 3.0, i) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, TICK_DDL).withColumn("month", F.trunc(F.col("timestamp").cast("date"), "month"))


def test_hourly_tick_files(spark):
    root = tempfile.mkdtemp(prefix="spark-")
    folder = f"{root}/EURUSD/2024/00/05"
    os.makedirs(folder)
    raw = struct.pack(">IIIff", 1500, 1100250, 1100000, 2.0, 1.5) + struct.pack(">IIIff", 2000, 1100300, 1100100, 1.0, 1.0)
    with open(f"{folder}/07h_ticks.bi5", "wb") as f:
        f.write(lzma.compress(raw + b"xx", lzma.FORMAT_ALONE))
    with open(f"{folder}/08h_ticks.bi5", "wb") as f:
        f.write(b"broken")
    open(f"{folder}/09h_ticks.bi5", "wb").close()
    good, bad = ticks.read_tick_files(spark, root)
    got = [(r.symbol, r.timestamp, r.ask, r.bid, r.ask_volume) for r in good.orderBy("timestamp").collect()]
    base = dt.datetime(2024, 1, 5, 7)
    assert got == [("EURUSD", base + dt.timedelta(milliseconds=1500), 1100.25, 1100.0, 2.0),
                   ("EURUSD", base + dt.timedelta(milliseconds=2000), 1100.3, 1100.1, 1.0)]
    assert [r.path[-13:] for r in bad.collect()] == ["08h_ticks.bi5"]


def test_resample_rules(spark):
    t0 = dt.datetime(2024, 1, 1, 10)
    df = tick_frame(spark, [t0 + dt.timedelta(minutes=m) for m in (0, 10, 20, 59, 60, 61)])
    assert bars.resample(df, "1H").count() == 0
    rows = bars.resample(df, "1H", min_ticks=1).orderBy("timestamp").collect()
    assert [(r.timestamp.hour, r.open, r.close, r.volume, r.tick_count) for r in rows] == [
        (10, 10.1, 13.1, 8.0, 4), (11, 14.1, 15.1, 4.0, 2)]
    both = bars.resample_many(df, ["1m", "1H"], min_ticks=1)
    hour = both.where("tf = '1H'").select("timestamp", "open", "close", "tick_count").orderBy("timestamp").collect()
    assert [tuple(r) for r in hour] == [(r.timestamp, r.open, r.close, r.tick_count) for r in rows]
    with pytest.raises(ValueError):
        bars.resample(df, "3H")
    assert bars.detect_gaps(tick_frame(spark, [t0, t0 + dt.timedelta(hours=26)]).select(
        "symbol", "timestamp", "month"), "1H").collect()[0].gap_bars == 26


def test_quality_calendar_and_merge(spark):
    months = spark.createDataFrame([(dt.date(2024, 1, 1),)], "month date")
    fx = {r.slot for r in quality.calendar_slots(months, "fx").collect()}
    assert dt.datetime(2024, 1, 6, 12) not in fx and dt.datetime(2024, 1, 7, 12) not in fx
    assert dt.datetime(2024, 1, 7, 21) in fx
    assert quality.calendar_slots(months, "crypto").count() == 744
    t0 = dt.datetime(2024, 1, 2, 3)
    base, patch = tick_frame(spark, [t0]), tick_frame(spark, [t0, t0 + dt.timedelta(hours=1)])
    merged = quality.merge_patch(base, patch.withColumn("bid", F.lit(0.0)))
    assert sorted(r.bid for r in merged.collect()) == [0.0, 10.0]


def test_refresh_only_touches_changed_months(spark):
    out = store.new_table_path(spark, "out")
    df, _ = bars_frame(spark, 48, start=dt.datetime(2024, 1, 31))
    df = df.withColumn("tf", F.lit("1H"))
    run = lambda d: d.withColumn("twice", F.col("close") * 2)
    assert tuple(store.refresh(df, out, run).first())[:2] == (2, 0)
    assert tuple(store.refresh(df, out, run).first())[:2] == (0, 2)
    changed = df.withColumn("close", F.when(F.month("month") == 2, 1.0).otherwise(F.col("close")))
    assert tuple(store.refresh(changed, out, run).first())[:2] == (1, 1)
    assert tuple(store.refresh(changed, out, run, force=True).first())[:2] == (2, 0)
    rows = store.read_table(spark, out, symbol="A", tf="1H")
    assert rows.count() == 48 and rows.where("twice = 2").count() == 24


def test_corrupt_files_can_be_skipped(spark):
    path = store.new_table_path(spark, "corrupt")
    df, _ = bars_frame(spark, 10)
    store.write_table(df.withColumn("tf", F.lit("1H")), path)
    with open(f"{path}/symbol=A/tf=1H/month=2024-01-01/zz.parquet", "wb") as f:
        f.write(b"not parquet at all")
    schema_ok = spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "false")
    assert schema_ok.schema(df.schema).parquet(path).count() == 10


def test_exact_quantiles_with_ties(spark):
    values = [1.0, 2.0, 2.0, 2.0, 9.0, 4.0, 7.5]
    df = spark.createDataFrame([(v, 5.0) for v in values] + [(None, 5.0)], "a double, b double")
    got = {r.feature: r for r in feature_quantiles(df, ["a", "b"], (0.05, 0.5, 0.95)).collect()}
    for p in (5, 50, 95):
        assert abs(got["a"][f"p{p}"] - np.percentile(values, p)) < 1e-12
        assert got["b"][f"p{p}"] == 5.0


def test_drift_verdicts(spark):
    ref = spark.createDataFrame([(i, float(i), float(i % 7)) for i in range(80)], "idx long, x double, y double")
    live = ref.withColumn("x", F.col("x") + 50)
    rows = {r.feature: r for r in drift.report(ref, live, ["x", "y"]).collect()}
    assert rows["x"].drifted and not rows["y"].drifted and rows["y"].ks_stat == 0
    assert drift.report(ref, live.limit(10), ["x", "y"]).count() == 0
    calls = []
    drift.retrain_on_drift(drift.report(ref, live, ["y"]), lambda: calls.append(1))
    assert not calls
    drift.retrain_on_drift(drift.report(ref, live, ["x"]), lambda: calls.append(1))
    assert calls == [1]


def test_macro_f1_cases(spark):
    def f1(pairs):
        df = spark.createDataFrame(pairs, "y int, prediction int")
        return scoring.macro_f1(df).first()["macro_f1"]

    assert abs(f1([(0, 0), (1, 2), (2, 1)]) - 1 / 3) < 1e-12
    assert f1([(0, 0), (1, 1)]) == 1.0
    assert f1(spark.createDataFrame([], "y int, prediction int").collect()) == 0.0


def test_registry_prefers_metric_then_age(spark):
    def add(backend, when, metrics):
        return registry.entry(spark, backend=backend, symbol="A", tf="1H", label="label_10", metrics=metrics, registered_at=when)

    table = add("a", 2.0, {"best_cv_f1_macro": 0.4, "note": "x"}).unionByName(
        add("b", 1.0, {"best_cv_f1_macro": 0.4})).unionByName(add("c", 0.0, {"other": 1.0}))
    assert registry.best_models(table).first()["backend"] == "b"
    assert registry.leaderboard(table).count() == 2
    with pytest.raises(ValueError):
        registry.entry(spark, backend="a", symbol="A", tf="1H", label="", metrics={}, registered_at=0.0)


def test_failed_backend_is_reported(spark):
    def broken():
        raise RuntimeError("no data")

    rows = {r.backend: r for r in models.compare_backends(
        spark, {"x": lambda: {"best_cv_f1_macro": 0.3}, "y": broken}).collect()}
    assert rows["x"].status == "ok" and rows["y"].status == "error" and rows["y"].error == "RuntimeError: no data"


def test_scoring_needs_every_feature(spark):
    df = spark.createDataFrame([(1.0, 2.0, float(i % 2)) for i in range(20)], "a double, b double, y double")
    model = models.tree_pipeline(["b", "a"], {"numTrees": 2, "maxDepth": 2}, 1).fit(df)
    assert set(models.score_table(model, df, ["b", "a"]).select("prediction").distinct().toPandas()["prediction"]) <= {-2, -1}
    with pytest.raises(ValueError):
        models.score_table(model, df.drop("a"), ["b", "a"])


def silences(spark, deliveries, **options):
    """Alerts after each delivery of (symbol, hour) ticks, drained by one run each."""
    t0 = dt.datetime(2024, 1, 1)
    source, out = store.new_table_path(spark, "ticks"), store.new_table_path(spark, "silences")
    seen = []
    with streams.keyed_state(spark):
        for ticks_of in deliveries:
            frame = spark.createDataFrame([(s, t0 + dt.timedelta(hours=h)) for s, h in ticks_of], "symbol string, timestamp timestamp_ntz")
            frame.repartition(2).write.mode("append").parquet(source)
            found = streams.run_to_table(silence_alerts(streams.tick_stream(spark, source, frame.schema), **options), out)
            hour = lambda t: None if t is None else (t - t0).total_seconds() / 3600
            seen.append(sorted((r.symbol, r.kind, hour(r.gap_start), hour(r.gap_end)) for r in found.collect()))
    return seen


def test_a_symbol_that_never_returns_is_reported(spark):
    seen = silences(spark, [
        [("A", 0.1), ("B", 0.2), ("B", 0.9)],
        [("B", 1.5), ("B", 2.6), ("B", 4.0)],  # B is silent from 2.6 on for 1.4 hours; A does not come back
        [("B", 4.5), ("B", 5.2), ("B", 6.0)],
    ], watermark="30 minutes")
    gone = ("A", "silent", 0.1, None)
    assert seen[0] == [] and gone in seen[1]
    assert seen[2] == sorted([gone, ("B", "silent", 1.5, None), ("B", "silent", 2.6, None), ("B", "returned", 1.5, 2.6),
                              ("B", "returned", 2.6, 4.0)])


def test_silence_alerts_do_not_depend_on_deliveries(spark):
    draw = random.Random(9)
    rows, hour = [], {s: 0.0 for s in "ABC"}
    for _ in range(120):
        s = draw.choice("AAAAABC")
        hour[s] = round(max(hour[s], max(hour.values()) - 3) + draw.choice([0.05, 0.2, 0.7, 1.3, 3.1]), 3)
        rows.append((s, hour[s]))
    rows = sorted((r for r in rows if r[1] < 40), key=lambda r: r[1]) + [("D", 50.0)]
    thirds = [rows[:40], rows[40:80], rows[80:]]
    at_once = silences(spark, [rows[::-1]])[-1]
    assert silences(spark, thirds)[-1] == at_once
    mark, want = 50.0 - 2, []
    for s in "ABC":
        mine = [h for t, h in rows if t == s]
        for a, b in zip(mine, [*mine[1:], None]):
            if (b is None or b - a > 1) and a + 1 <= mark:
                want.append((s, "silent", a, None))
            if b is not None and b - a > 1:
                want.append((s, "returned", a, b))
    assert [(s, k, round(a, 3), b and round(b, 3)) for s, k, a, b in at_once] == sorted(want, key=lambda r: (r[0], r[1], r[2]))


def test_drift_against_a_stored_reference(spark):
    rng = random.Random(3)
    cells = lambda n, shift: [(rng.choice([None, float("nan"), round(rng.gauss(shift, 1), 1), rng.gauss(shift, 1), 0.5]),
                               float(rng.randrange(4)), None) for _ in range(n)]
    ddl = "x double, y double, z double"
    reference, path = spark.createDataFrame(cells(3000, 0), ddl), store.new_table_path(spark, "reference")
    drift.save_reference(reference, ["x", "y", "z"], path, block_rows=64)
    assert {r.feature: r.n for r in drift.stored_profile(spark, path).collect()}.keys() == {"x", "y"}
    narrow = [(0.123, 1.0, 1.0)] * 40
    for live in (cells(400, 0), cells(300, 2), narrow, [(99.0, -5.0, None)] * 50, cells(20, 0)):
        batch = spark.createDataFrame(live, ddl)
        joint = drift.against_stored(spark, path, batch, ["x", "y", "z"])
        got = drift.report(None, None, ["x", "y", "z"], joint=joint).orderBy("feature").collect()
        assert got == drift.report(reference, batch, ["x", "y", "z"]).orderBy("feature").collect()
    opened = drift.against_stored(spark, path, spark.createDataFrame(narrow, ddl), ["x"])
    assert opened.count() < drift.compare(reference, spark.createDataFrame(narrow, ddl), ["x"]).count() / 2


def test_drift_opens_only_blocks_that_may_hold_the_greatest_distance(spark):
    rng = random.Random(5)
    ddl, path = "x double, y double", store.new_table_path(spark, "reference")
    reference = spark.createDataFrame([(rng.gauss(0, 1), None) for _ in range(20_000)], ddl)
    drift.save_reference(reference, ["x", "y"], path, block_rows=20)
    profiles = [df.orderBy("feature").collect() for df in (drift.stored_profile(spark, path), drift.profile(reference, ["x", "y"]))]
    assert profiles[0] == profiles[1] and len(profiles[0]) == 1
    for shift, scale in ((0.3, 1), (0, 3), (0, 0.5), (0, 1)):
        batch = spark.createDataFrame([(rng.gauss(shift, scale), 1.0) for _ in range(5_000)], ddl)
        joint, whole = drift.against_stored(spark, path, batch, ["x", "y"]), drift.compare(reference, batch, ["x", "y"])
        assert drift.report(None, None, ["x", "y"], joint=joint).collect() == drift.report(None, None, ["x", "y"], joint=whole).collect()
        assert joint.count() < whole.count() / (10 if scale != 1 or shift else 2)
    drift.save_reference(reference, ["y"], path)
    assert not drift.against_stored(spark, path, batch, ["y"]).count() and not drift.stored_profile(spark, path).count()


def test_evaluation_of_a_registered_model(spark):
    df, _ = bars_frame(spark, 400)
    other, _ = bars_frame(spark, 60, seed=2, symbol="FLAT")
    rows = df.unionByName(other).withColumns({
        "atr_14": F.lit(2.0), "move": F.when(F.col("symbol") == "A", F.col("close") - F.col("open")).otherwise(0.0)})
    indexed = row_index(rows, ["symbol"], "timestamp")
    root, folder = store.new_table_path(spark, "models"), store.new_table_path(spark, "evaluation")
    entries = None
    for backend, sign, score in (("up", "", 0.5), ("down", "-", 0.4)):
        rule = SQLTransformer(statement=f"SELECT *, CASE WHEN {sign}move > 1 THEN 4.0D WHEN {sign}move < -1 THEN 0.0D ELSE 2.0D END "
                                        "AS prediction FROM __THIS__")
        Pipeline(stages=[rule]).fit(indexed).write().save(f"{root}/{backend}")
        one = registry.entry(spark, backend=backend, symbol="ALL", tf="1H", label="label_10", metrics={"best_cv_f1_macro": score},
                             registered_at=1.0, feature_columns=["move"], artifact_path=f"{root}/{backend}")
        entries = one if entries is None else entries.union(one)
    ask = dict(symbol="ALL", tf="1H", label="label_10")
    assert evaluation.evaluate_registered(indexed, entries, folder, symbol="ALL", tf="4H", label="label_10") is None
    found = {r.symbol: r for r in evaluation.evaluate_registered(indexed, entries, folder, **ask, tp_r=2.0, commission=0.1).collect()}
    signals = indexed.withColumn("signal", F.when(F.col("move") > 1, 1).when(F.col("move") < -1, -1).otherwise(0))
    want = backtest.simulate_trades(signals, tp_r=2.0, commission=0.1)
    assert found["A"].total_trades == want.count() > 5 and found["FLAT"].total_trades == 0
    key = lambda df: sorted((r.symbol, r.entry_time, r.exit_time, r.signal, r.reason, r.pnl_r) for r in df.collect())
    assert key(evaluation.read_trades(spark, f"{folder}/trades", "up:label_10")) == key(want)
    assert evaluation.read_trades(spark, f"{folder}/trades", "down:label_10").count() == 0
    again = store.new_table_path(spark, "evaluation")
    evaluation.evaluate_registered(indexed, entries, again, **ask, backend="down")
    assert evaluation.read_trades(spark, f"{again}/trades", "down:label_10").count() > 5


def test_ticks_without_numbers_keep_their_values(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("A", t0, 2.0, 2.2), ("A", t0, 1.0, 1.2), ("A", t0 + dt.timedelta(minutes=1), 3.0, 3.2)]
    df = ticks.to_ticks(spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, bid double, ask double").withColumns(
        {"bid_volume": F.lit(1.0), "ask_volume": F.lit(1.0)}))
    kept = quality.dedupe_ticks(df).orderBy("timestamp").collect()
    assert [(r.bid, r.ask_volume) for r in kept] == [(1.0, 1.0), (3.0, 1.0)]
    merged = quality.merge_patch(df.where("bid = 2"), df.where("bid < 2")).collect()
    assert [r.bid for r in merged] == [2.0]
    for tie in (None, "seq"):
        bar = bars.resample(df, "1H", min_ticks=1, tie_col=tie).first()
        assert (bar.open, bar.close, bar.tick_count) == (1.1, 3.1, 3)


def test_lost_month_counts_in_the_audit(spark):
    counts = spark.createDataFrame([("A", dt.date(2024, 1, 1), 10, 0, 0, 0, 0)],
                                   "symbol string, month date, actual_rows long, nulls long, negative_price long, "
                                   "negative_spread long, negative_volume long")
    manifest = spark.createDataFrame([("A", dt.date(2024, 2, 1), 5, 700)], "symbol string, month date, rows long, missing_hours int")
    row = quality.audit_summary(counts, manifest).first()
    assert (row.months, row.total_missing_hours, row.total_rows, row.status) == (1, 700, 10, "READY")


def test_partition_types_and_removed_months(spark):
    out = store.new_table_path(spark, "typed")
    df, _ = bars_frame(spark, 48, start=dt.datetime(2024, 1, 31))
    df = df.withColumn("tf", F.lit("1D")).withColumn("symbol", F.lit("007"))
    store.refresh(df, out, lambda d: d.where("close > 0"))
    first = store.read_table(spark, out)
    assert {(r.symbol, r.tf, r.month) for r in first.collect()} == {
        ("007", "1D", dt.date(2024, 1, 1)), ("007", "1D", dt.date(2024, 2, 1))}
    emptied = df.withColumn("close", F.when(F.month("month") == 2, -1.0).otherwise(F.col("close")))
    assert store.refresh(emptied, out, lambda d: d.where("close > 0")).first()["processed"] == 1
    assert {r.month for r in store.read_table(spark, out).collect()} == {dt.date(2024, 1, 1)}
    counts = store.refresh(emptied.where(F.month("month") == 2), out, lambda d: d.where("close > 0")).first()
    assert (counts["processed"], counts["removed"]) == (0, 1)


def test_short_series_are_trimmed_and_scored(spark):
    rows = [("A", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), i, 60, i % 5) for i in range(60)]
    rows += [("S", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), i, 6, i % 5) for i in range(6)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, idx long, n long, y int")
    lags = prep.lag_features(df.withColumn("label", F.col("y") - 2).drop("y"), "label", [], min_lag=10)
    assert {r.unique_id for r in lags.collect()} == {"A"} and lags.where("y_lag_10 IS NULL").count() == 0
    preds = models.seasonal_naive_predictions(df)
    assert preds.where("symbol = 'A'").count() == 50 and preds.where("prediction IS NULL").count() == 0


def test_online_model_scores_all_but_the_first_batch(spark):
    rows = [(s, i, float(i % 5), i % 5) for s, n in (("A", 130), ("B", 20), ("C", 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, idx long, x double, y int")
    preds = models.online_predictions(df, ["x"], batch=20, steps=20)
    got = {r.symbol: r["count"] for r in preds.groupBy("symbol").count().collect()}
    assert got == {"A": 110}
    late = preds.where("idx >= 80").collect()
    assert sum(r.prediction == r.y for r in late) / len(late) > 0.5
