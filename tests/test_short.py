"""Short series: one shuffle, one order, the results of the block forms."""

import pytest
from helpers import bars_frame
from pyspark.sql import functions as F

from marketspark.functions.scans import Ewm, ewm_scan, noted, row_index, short
from marketspark.operators import backtest, models
from marketspark.operators.bars import resample
from marketspark.operators.folds import assign_folds
from marketspark.operators.indicators import atr
from marketspark.operators.labels import add_labels
from marketspark.sources import views


def column(df, name, order="timestamp"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def _nodes(df, name):
    return df._jdf.queryExecution().executedPlan().toString().count(name)


def test_weekly_rows_lie_in_one_order(spark):
    from marketspark.plans.common import labelled_1w

    rows = row_index(labelled_1w(spark, "/root/testdata/sf0.001", staged=False).where("label_10 IS NOT NULL"), ("symbol",), "timestamp")
    assert _nodes(rows, "Exchange hashpartitioning") == 1 and _nodes(rows, "Sort [") == 1


def test_bars_without_combining_are_the_same(spark):
    ticks = views.ticks_many(spark, "/root/testdata/sf0.001")
    plain, merged = (resample(ticks, "1W", min_ticks=1, tie_col="seq", combine=c) for c in (False, True))
    assert plain.exceptAll(merged).isEmpty() and merged.exceptAll(plain).isEmpty()
    assert _nodes(plain, "Sort [") == 1


def test_short_series_have_the_averages_of_blocks(spark):
    df, _ = bars_frame(spark, 300)
    scans = [ewm_scan(row_index(df, ("symbol",), "timestamp", most=most), [Ewm("e", "close", 20, 2 / 21, start=1)], ("symbol",), block=block)
             for most, block in ((None, 128), (300, 512))]
    assert short(scans[1]) and _nodes(scans[1], "Sort [") <= 2
    for a, b in zip(*[column(s, "e", "idx") for s in scans]):
        assert (a is None and b is None) or a == pytest.approx(b, rel=1e-12)


def test_short_trades_are_those_of_blocks(spark):
    df, _ = bars_frame(spark, 300)
    bars = add_labels(atr(row_index(df, ("symbol",), "timestamp", most=300), ("symbol",)), partition_cols=("symbol",)).withColumn(
        "signal", F.signum("label_10").cast("int"))
    few, blocks = (backtest.simulate_trades(frame, tp_r=1.5, block=block) for frame, block in ((bars, 1024), (bars, 64)))
    columns = ["entry_time", "exit_time", "reason", "bars_held", "pnl_r"]
    assert few.select(columns).collect() and sorted(few.select(columns).collect()) == sorted(blocks.select(columns).collect())
    assert "lambdafunction" not in backtest.trade_candidates(bars)._jdf.queryExecution().optimizedPlan().toString()


def test_folds_are_opened_without_lambdas(spark):
    df = spark.range(130).select(F.lit("A").alias("symbol"), F.col("id").alias("idx"), F.lit(130).alias("n"), (F.col("id") % 5).alias("y"))
    assert "lambda" not in assign_folds(df, "timeseries")._jdf.queryExecution().optimizedPlan().toString()
    predictions = models.seasonal_naive_predictions(df)
    assert predictions._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    found = models.mean_fold_f1(predictions).first()
    assert (found["folds"], found["scored"]) == (5, 105)


def test_online_scores_a_series_without_a_name(spark):
    df = spark.range(120).select(F.when(F.col("id") < 60, "A").alias("symbol"), (F.col("id") % 60).alias("idx"),
                                 F.col("id").cast("double").alias("a"), (F.col("id") % 5).cast("int").alias("y"))
    found = models.online_predictions(df, ["a"], batch=25).groupBy("symbol").agg(F.count("*"), F.max("batch")).collect()
    assert sorted(map(tuple, found), key=str) == [("A", 35, 2), (None, 35, 2)]


def test_few_ticks_reach_their_bars_and_windows_in_one_shuffle(spark):
    ticks = views.ticks_many(spark, "/root/testdata/sf0.001")
    plain, whole = (resample(ticks, "1W", min_ticks=1, tie_col="seq", combine=False, together=t) for t in (False, True))
    assert whole.count() > 1000 and not plain.exceptAll(whole).count() and plain.count() == whole.count()


def test_bayes_of_short_series_is_one_shuffle(spark):
    from marketspark.plans.catalog_models import prequential_nb

    found = prequential_nb(spark, "/root/testdata/sf0.001")
    assert _nodes(found, "Exchange hashpartitioning") == 1 and _nodes(found, "Sort [") == 1 and found.count()


def test_bayes_of_short_series_is_that_of_merged_moments(spark):
    df = spark.range(700).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"), F.floor(F.col("id") / 3).alias("idx"),
        F.when(F.col("id") % 11 > 0, F.sin(F.col("id") * 1.7) * 3 + 1e6).alias("a"), F.cos(F.col("id") * 0.3).alias("b"),
        F.when(F.col("id") % 13 > 0, F.pmod(F.col("id") * F.col("id"), F.lit(5))).cast("int").alias("y"))
    merged, running = (models.prequential_bayes(frame, ["a", "b"], batch=20) for frame in (df, noted(df, "idx", 234)))
    assert _nodes(running, "Join") == 0
    assert merged.count() > 600 and sorted(map(repr, merged.collect())) == sorted(map(repr, running.collect()))


def test_trades_of_a_registered_model_are_windows_of_short_series(spark):
    from marketspark.plans.catalog_trades import evaluate_registered

    found = evaluate_registered(spark, "/root/testdata/sf0.001")
    assert _nodes(found, "Join") == 1 and _nodes(found, "_block") == 0 and found.count()


def test_fits_need_not_look_for_the_classes(spark):
    df = spark.range(60).select(F.col("id").cast("double").alias("a"), (F.col("id") % 3).cast("int").alias("y"))
    fit = models.tree_pipeline(["a"], {"numTrees": 2, "maxDepth": 2}, 1).fit
    assert fit(df).stages[-1].numClasses == 3 and fit(models.with_classes(df)).stages[-1].numClasses == 5
