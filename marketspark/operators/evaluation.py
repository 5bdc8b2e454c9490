"""Evaluation of a registered model: entry, stored model, stored predictions, stored trades, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.functions.scans import longest, noted
from marketspark.operators import backtest, models, registry
from marketspark.operators.select import label_to_signal
from marketspark.schema import TRADE_COLUMNS
from marketspark.sources.store import write_table

#: What a trades table is partitioned by; ``source`` names what gave the signals.
TRADE_PARTITIONS = ("source", "month")


def write_trades(trades: DataFrame, path: str, source: str, *, keys: Sequence[str] = ("symbol",)) -> None:
    """Add trades to the table at ``path``, partitioned by source and month of entry."""
    write_table(
        trades.select(*keys, *TRADE_COLUMNS, "idx", "exit_idx", F.lit(source).alias("source"),
                      F.trunc(F.col("entry_time").cast("date"), "month").alias("month")),
        path, partitions=TRADE_PARTITIONS, mode="append")


def read_trades(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The stored trades of one source; only its folders are read."""
    ddl = ", ".join(f"{c} {t}" for c, t in {
        "symbol": "string", "entry_time": "timestamp_ntz", "exit_time": "timestamp_ntz", "signal": "string",
        "entry_price": "double", "exit_price": "double", "bars_held": "int", "pnl_r": "double", "reason": "string",
        "weekday": "int", "hour": "int", "idx": "long", "exit_idx": "long", "source": "string", "month": "date"}.items())
    return spark.read.schema(ddl).parquet(path).where(F.col("source") == source)


def evaluate_registered(
    bars: DataFrame, entries: DataFrame, folder: str, *, symbol: str, tf: str, label: str, backend: str | None = None,
    metric: str = "best_cv_f1_macro", initial_capital: float = 10_000.0, risk_pct: float = 1.0, **rules,
) -> DataFrame | None:
    """Backtest of the best registered model of (symbol, tf, label); None if there is none.

    ``bars`` are indexed bars of any number of series with ATR and the model's feature columns. Predictions go to
    ``folder/predictions`` and trades to ``folder/trades`` under the source ``backend:label``; the metrics are those of the trades
    as read back, with a zero row for a series without trades.
    """
    found = registry.best_models(registry.list_models(entries, symbol=symbol, tf=tf, label=label, backend=backend), metric).first()
    if found is None:
        return None
    spark = bars.sparkSession
    keep = ["symbol", "timestamp", "month", "idx", "n", "open", "high", "low", "close", "atr_14"]
    stored = models.score_to_table(found, bars, f"{folder}/predictions", keep)
    signals = stored.withColumn("signal", label_to_signal("prediction"))
    source = f"{found['backend']}:{label}"
    write_trades(backtest.simulate_trades(signals, **rules), f"{folder}/trades", source)
    trades, most = read_trades(spark, f"{folder}/trades", source), longest(bars)
    if most is not None:  # a series has no more trades than bars
        trades = noted(trades, "entry_time", most)
    return backtest.backtest_metrics(
        trades, initial_capital=initial_capital, risk_pct=risk_pct,
        all_keys=bars.select("symbol"))
