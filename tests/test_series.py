"""Scans, indicators, labels, trades and folds against slow models."""

import datetime as dt
import math
import random
import time

import numpy as np
import pandas as pd
import pytest
from helpers import bars_frame, ema_model, trades_model
from pyspark.sql import functions as F

from marketspark import session
from marketspark.functions import scans
from marketspark.functions.scans import Ewm, ewm_scan, halo_blocks, last_known, ordered, previous_row, row_index, running_total
from marketspark.operators import backtest, indicators, labels, levels, models, select, sessions
from marketspark.operators.folds import assign_folds, fold_part, fold_table, usable_folds
from marketspark.session import stage
from marketspark.streaming.silence import SilenceWatch


def close_to(got, want, tol=1e-8):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert (a is None) == (b is None), (a, b)
        assert a is None or abs(a - b) <= tol * max(1.0, abs(b)), (a, b)


def column(df, name, order="timestamp"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


@pytest.mark.parametrize("across", ["window", "join"])
@pytest.mark.parametrize("period,alpha", [(3, 0.5), (20, 2 / 21)])
def test_block_scan_equals_plain_recursion(spark, across, period, alpha):
    df, rows = bars_frame(spark, 700)
    indexed = row_index(df, ("symbol",), "timestamp")
    out = ewm_scan(indexed, [Ewm("y", "close", period, alpha, start=2)], ("symbol",), block=128, across=across)
    close_to(column(out, "y"), ema_model([r[5] for r in rows], period, alpha, 2))


def test_block_scan_rejects_blocks_that_overflow(spark):
    df, _ = bars_frame(spark, 5)
    with pytest.raises(ValueError):
        ewm_scan(row_index(df, ("symbol",), "timestamp"), [Ewm("y", "close", 2, 0.9)], ("symbol",), block=2048)


def test_indicators_by_hand(spark):
    df, rows = bars_frame(spark, 120)
    out = indicators.add_indicators(df, ema_periods=(3,), rsi_period=3, atr_period=3, macd=(2, 4, 3)).orderBy("timestamp")
    closes = [r[5] for r in rows]
    moves = [0.0] + [b - a for a, b in zip(closes, closes[1:])]
    gain = ema_model([max(m, 0) for m in moves], 3, 1 / 3, 1)
    loss = ema_model([max(-m, 0) for m in moves], 3, 1 / 3, 1)
    close_to(column(out, "rsi_3"), [None if g is None else 100 * g / (g + l) for g, l in zip(gain, loss)])
    tr = [0.0] + [max(r[3] - r[4], abs(r[3] - p[5]), abs(r[4] - p[5])) for p, r in zip(rows, rows[1:])]
    close_to(column(out, "atr_3"), ema_model(tr, 3, 1 / 3, 1))
    close_to(column(out, "ema_3"), ema_model(closes, 3, 0.5))
    fast, slow = ema_model(closes, 2, 2 / 3, 2), ema_model(closes, 4, 2 / 5)
    line = [None if s is None else f - s for f, s in zip(fast, slow)]
    signal = ema_model([0.0 if v is None else v for v in line], 3, 0.5, 3)
    close_to(column(out, "macd_signal"), signal)
    close_to(column(out, "macd"), [v if s is not None else None for v, s in zip(line, signal)])


def test_months_restart_and_whole_series_does_not(spark):
    df, rows = bars_frame(spark, 60, start=dt.datetime(2024, 1, 31, 0), step=dt.timedelta(hours=1))
    monthly = column(indicators.ema(df, periods=(5,)), "ema_5")
    whole = column(indicators.ema(df, ("symbol",), periods=(5,)), "ema_5")
    closes = [r[5] for r in rows]
    close_to(monthly, ema_model(closes[:24], 5, 1 / 3) + ema_model(closes[24:], 5, 1 / 3))
    close_to(whole, ema_model(closes, 5, 1 / 3))
    lab = labels.add_labels(indicators.atr(df, period=3), (5,), atr_col="atr_3")
    got = column(lab, "close_ahead_5")
    assert got[18] == closes[23] and got[19:24] == [None] * 5 and got[24] == closes[29]
    whole_lab = labels.add_labels(indicators.atr(df, ("symbol",), period=3), (5,), ("symbol",), atr_col="atr_3")
    assert column(whole_lab, "close_ahead_5") == closes[5:] + [None] * 5


def test_labels_need_atr_and_use_both_thresholds(spark):
    df, _ = bars_frame(spark, 5)
    with pytest.raises(ValueError):
        labels.add_labels(df)
    flat = df.withColumns({"atr_14": F.lit(2.0), "close": F.element_at(
        F.array(*[F.lit(x) for x in (10.0, 11.5, 13.6, 12.5, 10.0)]), F.hour("timestamp") + 1)})
    out = labels.add_labels(flat, (1,))
    assert column(out, "label_1") == [1, 2, -1, -2, None]
    balance = {r["label"]: r["n"] for r in labels.class_balance(out, "label_1").collect()}
    assert balance == {-2: 1, -1: 1, 0: 0, 1: 1, 2: 1}


@pytest.mark.parametrize("block,seed", [(12, 1), (50, 2)])
def test_trades_equal_a_state_machine(spark, block, seed, monkeypatch):
    monkeypatch.setattr(backtest, "CHAIN", 3)  # several levels of composed blocks
    n = 400
    df, rows = bars_frame(spark, n, seed)
    rng = random.Random(seed)
    signals = [rng.choice([0, 1, -1]) for _ in range(n)]
    atr = [None if i < 3 else 1.5 + rng.random() for i in range(n)]
    side = spark.createDataFrame([(r[1], s, a) for r, s, a in zip(rows, signals, atr)],
                                 "timestamp timestamp_ntz, signal int, atr_14 double")
    bars = backtest.indexed_bars(df.join(side, "timestamp"))
    got = backtest.simulate_trades(bars, tp_r=2.0, sl_r=1.0, commission=0.05, block=block).orderBy("entry_time").collect()
    want = trades_model(rows, atr, signals, 2.0, 1.0, 10, 0.05)
    assert [(r.entry_time, r.exit_time, r.reason, round(r.pnl_r, 9)) for r in got] == want
    if block != 12:
        return
    curve = backtest.equity_curve(spark.createDataFrame(got), block=16)
    total, peak = 0.0, None
    for r, w in zip(curve.orderBy("i").collect(), want):
        total += w[3]
        peak = total if peak is None else max(peak, total)
        assert abs(r.equity - total) < 1e-6 and abs(r.peak - peak) < 1e-6


def test_metrics_without_losses_and_without_trades(spark):
    ddl = "symbol string, entry_time timestamp_ntz, pnl_r double"
    day = dt.datetime(2024, 1, 1)
    trades = spark.createDataFrame([("A", day, 1.0), ("A", day + dt.timedelta(1), 2.0)], ddl)
    row = backtest.backtest_metrics(trades, all_keys=spark.createDataFrame([("A",), ("B",)], "symbol string"))
    got = {r.symbol: r for r in row.collect()}
    assert got["A"].profit_factor is None and got["A"].no_losses and got["A"].max_drawdown_r == 0
    assert got["B"].total_trades == 0 and got["B"].final_capital == 10_000 and got["B"].profit_factor == 0


def test_drawdown_open_at_the_end(spark):
    ddl = "symbol string, entry_time timestamp_ntz, pnl_r double"
    steps = [1.0, -1.0, 2.0, -1.0, -1.0, 0.5]
    trades = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1) + dt.timedelta(i), p) for i, p in enumerate(steps)], ddl)
    curve = backtest.equity_curve(trades)
    events = backtest.drawdown_events(curve, block=2).orderBy("start_idx").collect()
    assert [(e.start_idx, e.trough_idx, e.end_idx, e.magnitude, e.ongoing) for e in events] == [
        (1, 1, 2, 1.0, False), (3, 4, 5, 2.0, True)]
    assert events[1].total_bars == 3 and events[1].recovery == 1


def test_positions_previous_rows_and_totals_cross_blocks(spark):
    df, rows = bars_frame(spark, 40, start=dt.datetime(2023, 12, 30, 12))
    indexed = row_index(df, ("symbol",), "timestamp", previous={"prev": "close"})
    assert column(indexed, "idx") == list(range(40)) and set(column(indexed, "n")) == {40}
    closes = [r[5] for r in rows]
    assert column(indexed, "prev") == [None] + closes[:-1]
    assert column(previous_row(df, ("symbol",), "month", "timestamp", {"p": "close"}), "p") == [None] + closes[:-1]
    total = running_total(df, ("symbol",), "month", "timestamp", {"t": F.col("tick_count")})
    assert column(total, "t") == [7 * (i + 1) for i in range(40)]
    cores = halo_blocks(indexed, 8, before=3, after=2).where("core")
    assert cores.count() == 40


def test_sessions_on_clock_changes(spark):
    # 10 March 2024 02:00 does not exist in New York, 3 November 01:00 occurs twice.
    for start, london in ((dt.datetime(2024, 3, 10), [7, 8]), (dt.datetime(2024, 11, 3), [7, 8, 9])):
        df, _ = bars_frame(spark, 24, start=start)
        flags = sessions.session_flags(df).where("in_london").orderBy("timestamp")
        assert [t.hour for t in column(flags, "timestamp")] == london


def test_week_key_at_new_year(spark):
    df, rows = bars_frame(spark, 3, start=dt.datetime(2024, 12, 29, 12), step=dt.timedelta(days=1))
    calendar = column(sessions.period_running(df), "w_open")
    assert calendar == [rows[0][2], rows[1][2], rows[1][2]]


@pytest.mark.parametrize("causal", [False, True])
def test_sessions_against_a_walk_over_bars(spark, causal):
    full, rows = bars_frame(spark, 24 * 31, seed=5)
    rng = random.Random(7)
    gone = {r[1] for r in rows if rng.random() < 0.3}  # sessions lose bars, some all of them
    gaps = {r[1] for r in rows if rng.random() < 0.1}
    times = lambda ts: F.col("timestamp").isin([F.lit(t).cast("timestamp_ntz") for t in sorted(ts)])
    df = full.where(~times(gone)).withColumn("low", F.when(~times(gaps), F.col("low"))).withColumn(
        "high", F.when(~times(gaps), F.col("high")))
    chained = sessions.session_levels(sessions.session_ids(sessions.session_flags(df)))
    got = sessions.session_average_range(chained, n=3, causal=causal).orderBy("timestamp").collect()
    for s in ("asia", "london", "nyam"):
        ids, high, low, number = [], None, None, None
        for i, r in enumerate(got):
            opened = i > 0 and r[f"in_{s}"] and not got[i - 1][f"in_{s}"]
            number = None if i == 0 else (number or 0) + int(opened)
            if i == 1 or opened:
                high = low = None
            high = r["high"] if high is None else high if r["high"] is None else max(high, r["high"])
            low = r["low"] if low is None else low if r["low"] is None else min(low, r["low"])
            assert (r[f"kz_{s}_session_id"], r[f"kz_{s}_high"], r[f"kz_{s}_low"]) == (number, high, low)
            ids.append(number)
        ranges = {}
        for i, r in enumerate(got):
            if (r[f"in_{s}"] or i == len(got) - 1) and r[f"kz_{s}_range"] is not None:
                ranges[ids[i]] = max(ranges.get(ids[i], 0.0), r[f"kz_{s}_range"])
        known = sorted(ranges, key=lambda k: -1 if k is None else k)
        want = []
        for k in ids:
            end = known.index(k) + (0 if causal else 1) if k is not None and k in ranges else 0
            last = [ranges[j] for j in known[max(0, end - 3):end]]
            want.append(sum(last) / len(last) if last else None)
        close_to([r[f"kz_{s}_avg_range"] for r in got], want)


def test_iso_weeks_take_the_same_levels_as_windows_of_their_own(spark):
    df, rows = bars_frame(spark, 60, start=dt.datetime(2024, 12, 20, 12), step=dt.timedelta(hours=9))
    df = df.withColumn("month", F.lit(1))
    got = sessions.period_previous(sessions.period_running(df, iso_year=True), iso_year=True).orderBy("timestamp").collect()
    weeks = [(r["timestamp"] - dt.timedelta(hours=5)).isocalendar()[:2] for r in got]
    for i, r in enumerate(got):
        same = [x for x, w in zip(got[:i + 1], weeks) if w == weeks[i]]
        before = max((w for w in weeks if w < weeks[i]), default=None)
        past = [x["high"] for x, w in zip(got, weeks) if w == before]
        assert (r["w_open"], r["w_high"], r["w_low"]) == (same[0]["open"], max(x["high"] for x in same), min(x["low"] for x in same))
        assert r["pw_high"] == (max(past) if past else None)


def test_folds_by_filter_equal_the_memberships(spark):
    df = spark.range(130).select(F.lit("A").alias("symbol"), F.col("id").alias("idx"), F.lit(130).alias("n"))
    for method in ("purged_kfold", "purged_timeseries", "rolling_origin", "timeseries"):
        members = assign_folds(df, method, n_splits=4)
        for fold in range(4):
            for role in ("train", "test"):
                want = column(members.where((F.col("fold") == fold) & (F.col("role") == role)), "idx", "idx")
                assert column(fold_part(df, method, fold, role, n_splits=4), "idx", "idx") == want
    assert usable_folds(df, "rolling_origin", 4) == [0, 1, 2, 3] and usable_folds(df.where("idx > 60"), "purged_kfold", 4) == [1, 2, 3]


def test_tree_search_halves_and_scores_every_fold(spark):
    df = spark.range(200).select(F.lit("A").alias("symbol"), F.col("id").alias("idx"), F.lit(200).alias("n"),
                                 (F.col("id") % 5).cast("double").alias("a"), (F.col("id") % 5).cast("int").alias("y"))
    _, metrics = models.train_tree(df, ["a"], n_trials=4, n_splits=4)
    assert metrics["cv_rows"] == 20 and metrics["train_rows"] == 200 and metrics["folds"] == 4
    assert metrics["best_cv_f1_macro"] == 1.0


def test_fits_over_many_rows_do_not_run_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_AT_ONCE", 100)
    running, most = [], []

    def fit(item):
        running.append(item)
        time.sleep(0.05)
        most.append(len(running))
        running.remove(item)
        return item

    for rows, expected in ((60, 1), (50, 2), (1, models.PARALLEL)):
        most.clear()
        assert models._side_by_side(fit, range(8), rows) == list(range(8))
        assert max(most) == expected


def test_wrapping_window(spark):
    df = spark.createDataFrame([(m,) for m in (0, 90, 600, 1350)], "m int")
    assert [r[0] for r in df.select(sessions.in_window(F.col("m"), 1320, 120)).collect()] == [True, True, False, True]


def test_pivots_modes_agree_inside_one_month(spark):
    df, _ = bars_frame(spark, 200)
    for kind in ("traditional", "woodie", "camarilla", "dm", "demark", "classic", "fibonacci"):
        monthly = levels.pivot_points(df, kind).select("timestamp", "pp_p", "pp_r1", "pp_s5")
        whole = levels.pivot_points(df, kind, partition_cols=("symbol",)).select("timestamp", "pp_p", "pp_r1", "pp_s5")
        assert set(monthly.collect()) == set(whole.collect())
    with pytest.raises(ValueError):
        levels.pivot_points(df, "unknown")
    with pytest.raises(ValueError):
        levels.pivot_points(df, anchor="hourly")


def test_folds_never_leak(spark):
    df, _ = bars_frame(spark, 500)
    indexed = row_index(df, ("symbol",), "timestamp").select("symbol", "idx", "n")
    for method in ("purged_kfold", "purged_timeseries", "walk_forward", "timeseries", " Rolling_Origin "):
        rows = assign_folds(indexed, method, n_splits=4, min_train_size=100, refit_frequency=150).collect()
        for fold in {r.fold for r in rows}:
            train = {r.idx for r in rows if r.fold == fold and r.role == "train"}
            test = {r.idx for r in rows if r.fold == fold and r.role == "test"}
            assert train and test and not train & test
            if method.startswith("purged"):
                first = min(test)
                assert not [t for t in train if first - 10 <= t < first]
    assert fold_table(indexed, "timeseries", n_splits=4).count() == 4
    with pytest.raises(ValueError):
        assign_folds(indexed, "purged_kfold", n_splits=1)


def test_date_range_bounds(spark):
    df, _ = bars_frame(spark, 72)
    assert select.date_range(df, "20240102", "20240102").count() == 24
    for bad in (("20240103", "20240101"), ("2024-01-01", None)):
        with pytest.raises(ValueError):
            select.date_range(df, *bad)


def test_feature_columns_skip_prices_labels_and_flags(spark):
    df = spark.sql("SELECT 1.0D AS open, 2.0D AS rsi_14, CAST(1 AS TINYINT) AS label_7, 1.0D AS close_ahead_7, true AS flag, 3 AS m")
    assert select.numeric_feature_columns(df) == ["rsi_14", "m"]


def test_one_busy_day_is_many_blocks(spark):
    # A session with more tasks than this machine's cores; AQE would join its small partitions again.
    names = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        def day(n):
            return spark.range(n).select(
                F.lit("A").alias("symbol"), F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 8_000).cast(
                    "timestamp_ntz").alias("timestamp"), F.when(F.col("id") % 100_003 == 0, F.col("id")).alias("mark"))

        n = 10_000_000
        sizes = [r["count"] for r in ordered(day(n), ["symbol"], ["timestamp"]).groupBy("_block").count().collect()]
        assert len(sizes) >= 16 and max(sizes) < n / 8 and sum(sizes) == n
        n = 500_000
        at = (F.unix_micros(F.col("timestamp").cast("timestamp")) - 1_704_067_200_000_000) / 8_000
        seen = last_known(row_index(day(n), ["symbol"], "timestamp"), ["symbol"], ["timestamp"], "mark", "last")
        wrong = (F.col("last") != F.floor(at / 100_003) * 100_003) | (F.col("idx") != at) | (F.col("n") != n)
        assert seen.count() == n and seen.where(wrong).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_asof_by_brute_force(spark):
    draw = random.Random(8)
    t0 = dt.datetime(2024, 1, 1)
    when = lambda: t0 + dt.timedelta(minutes=draw.randrange(3000))
    left = [(draw.choice("AAAB"), when(), i) for i in range(400)] + [("C", when(), 999), (None, when(), 1000)]
    right = [(draw.choice("AAAB"), when(), draw.choice([None, 1, 2, 3]), i) for i in range(300)]
    got = levels.asof_backward(
        spark.createDataFrame(left, "symbol string, timestamp timestamp_ntz, id int"),
        spark.createDataFrame(right, "symbol string, timestamp timestamp_ntz, v int, w int"), values=["v", "w"]).collect()
    key = lambda r: (r[1], r[2] is not None, r[2] or 0, r[3])
    want = {}
    for s, t, i in left:
        found = max((r for r in right if r[0] == s and r[1] <= t), key=key, default=(None,) * 4)
        want[i] = found[2:]
    assert {r.id: (r.v, r.w) for r in got} == want


def test_moments_survive_a_high_level(spark):
    draw = random.Random(5)
    rows = [("A" if i % 3 else "B", i // 3 if i % 3 == 0 else i - i // 3 - 1, draw.gauss(0, 1) + (i % 5) * 0.8, draw.random(), i % 5)
            for i in range(900)]
    df = spark.createDataFrame(rows, "symbol string, idx long, a double, b double, y int")
    low = models.prequential_bayes(df, ["a", "b"], batch=20).collect()
    high = models.prequential_bayes(df.withColumns({"a": F.col("a") + 1e9, "b": F.col("b") + 1e9}), ["a", "b"], batch=20).collect()
    pick = lambda rs: sorted((r.symbol, r.idx, r.prediction) for r in rs)
    same = sum(x == y for x, y in zip(pick(low), pick(high)))
    assert len(low) == len(high) and same >= 0.999 * len(low)  # inputs keep about seven digits of their own at 1e9


def test_moments_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(models, "SCAN", 3)
    draw = random.Random(6)
    rows = [("A", i, draw.gauss(0, 1) + (i % 5), i % 5 if i % 7 else 0) for i in range(400)]
    got = models.prequential_bayes(spark.createDataFrame(rows, "symbol string, idx long, a double, y int"), ["a"], batch=10).collect()
    want = {}
    for b in range(1, 40):
        past = {c: [a for _, i, a, y in rows if i < b * 10 and y == c] for c in range(5)}
        model = {c: (len(v), sum(v) / len(v)) for c, v in past.items() if len(v) > 1}
        for _, i, a, _ in rows[b * 10:b * 10 + 10]:
            def ll(c):
                n, mean = model[c]
                var = max(sum((x - mean) ** 2 for x in past[c]) / n, 1e-6)
                return math.log(n / sum(m[0] for m in model.values())) - 0.5 * (math.log(var) + (a - mean) ** 2 / var)
            want[i] = max(model, key=lambda c: (ll(c), -c))
    assert {r.idx: r.prediction for r in got} == want


def test_seventy_features_are_one_aggregate(spark):
    draw = np.random.default_rng(2)
    names = [f"f{i}" for i in range(70)]
    cells = draw.normal(size=(500, 70)) + np.arange(70) * 1e6
    cells[:, 1] = cells[:, 0] * 2
    cells[:, 2] = 7.0
    cells[draw.random(cells.shape) < 0.1] = np.nan
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in cells]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(4)
    found = select.correlations(df, names)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    got = {(r.a, r.b): r["corr"] for r in found.collect()}
    want = pd.DataFrame(cells - np.nanmean(cells, axis=0), columns=names).corr()
    assert len(got) == 70 * 71 // 2
    for (a, b), c in got.items():
        if "f2" in (a, b):
            assert c == (1.0 if a == b else None)
        else:
            assert c == pytest.approx(want.loc[a, b], abs=1e-7)


def test_bootstrap_in_many_blocks(spark):
    draw = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(s, t0 + dt.timedelta(hours=i), draw.uniform(-1, 2)) for s, n in (("A", 50), ("B", 7), ("C", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, entry_time timestamp_ntz, pnl_r double")
    got = {(r.symbol, r.step): r for r in backtest.bootstrap_bands(df, n_paths=40, block=8).collect()}
    assert len(got) == len(rows)
    for s in "ABC":
        pnl = [r[2] for r in rows if r[0] == s]
        paths = np.zeros(40)
        for step in range(len(pnl)):
            h = [(p * 73856093 + step * 19349663 + 42 * 83492791) % 2147483647 for p in range(40)]
            for _ in range(2):
                h = [(x * x + x * 48271 + 11) % 2147483647 for x in h]
            paths += [pnl[x % len(pnl)] for x in h]
            r = got[s, step]
            assert r.equity_mean == pytest.approx(paths.mean())
            assert [r.lower_95, r.lower_68, r.upper_68, r.upper_95] == pytest.approx(np.percentile(paths, [2.5, 16, 84, 97.5]).tolist())


def test_a_sweep_reads_bars_in_one_window(spark):
    df, _ = bars_frame(spark, 300)
    bars = stage(row_index(df.withColumns({"atr_14": F.lit(1.0), "signal": F.hour("timestamp") % 3 - 1}), ["symbol"], "timestamp"))
    settings = lambda k: F.array(*[F.struct(F.lit(i).alias("param_id"), F.lit(1.0 + i).alias("param_tp")) for i in range(k)])
    plans = [backtest.trade_candidates(bars, settings=settings(k), tp_r=F.col("param_tp"))._jdf.queryExecution().optimizedPlan().toString()
             for k in (1, 9)]
    assert plans[0].count("Window [") == plans[1].count("Window [") == 1
    swept = backtest.simulate_trades(bars, settings=settings(3), tp_r=F.col("param_tp")).collect()
    for i in range(3):
        alone = backtest.simulate_trades(bars, tp_r=1.0 + i).collect()
        assert sorted((r.entry_time, r.exit_time, r.pnl_r) for r in swept if r.param_id == i) == sorted(
            (r.entry_time, r.exit_time, r.pnl_r) for r in alone)


def test_short_series_are_windows_and_long_ones_blocks(spark, monkeypatch):
    one, _ = bars_frame(spark, 400, seed=3, symbol="A")
    two, _ = bars_frame(spark, 250, seed=4, symbol="B")
    bars = one.union(two)

    def run(df):
        written = len(session._written[spark.sparkContext.applicationId])
        rows = labels.add_labels(indicators.atr(df, ("symbol",)), partition_cols=("symbol",))
        rows = rows.withColumn("signal", select.label_to_signal("label_10"))
        curve = backtest.equity_curve(backtest.simulate_trades(rows, tp_r=1.5, commission=0.1), peak_floor=0.0, block=64)
        events = backtest.drawdown_events(curve, block=64)
        found = [sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()) for df in (
            curve.select("symbol", "i", "entry_time", "exit_time", "pnl_r", "equity", "peak", "drawdown"), events)]
        plan = curve._jdf.queryExecution().executedPlan().toString()
        return found, len(session._written[spark.sparkContext.applicationId]) - written, plan.count("Exchange ")

    session.scratch_path(spark, "none")
    blocks, tables, _ = run(bars)
    noted = scans.measured(bars, ("symbol",), "timestamp")
    assert scans.longest(noted) == 400 and scans.short(noted) and not scans.short(noted, 399) and not scans.short(bars)
    windows, none, shuffles = run(noted)
    assert windows == blocks and blocks[0] and blocks[1]
    assert tables > 5 and none == 0 and shuffles == 1
    monkeypatch.setattr(scans, "SHORT", 100)  # now both are long
    assert run(noted)[0] == blocks
    assert scans.longest(scans.without_notes(noted)) is None


def test_silence_state_is_read_and_written_once_a_call():
    calls, held, timers = [], {}, set()

    class Value:
        def get(self):
            calls.append("get")
            return held.get("v")

        def update(self, v):
            calls.append("update")
            held["v"] = v

    class Handle:
        def getValueState(self, *_):
            return Value()

        def registerTimer(self, t):
            timers.add(t)

        def deleteTimer(self, t):
            timers.discard(t)

    class Clock:
        now = 0

        def getCurrentWatermarkInMs(self):
            return self.now

    hour = 3_600_000_000
    watch, clock = SilenceWatch(hour), Clock()
    watch.init(Handle())

    def feed(*times):
        rows = pd.DataFrame({"slot": [t // hour for t in times], "first_us": times, "last_us": times})
        return [tuple(r)[1:3] for f in watch.handleInputRows(("A",), iter([rows]), clock) for r in f.itertuples(index=False)]

    assert feed(*(k * hour // 2 for k in range(20)), 14 * hour) == [] and calls == ["get", "update"]
    clock.now = 16 * 3_600_000
    assert feed(16 * hour + 5) == [("silent", 9 * hour + hour // 2), ("returned", 9 * hour + hour // 2), ("silent", 14 * hour)]
    assert calls == ["get", "update"] * 2 and timers == {17 * 3_600_000}
