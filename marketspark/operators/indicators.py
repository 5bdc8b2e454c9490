"""EMA, RSI, MACD, ATR and ATR-normalised distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.functions.scans import Ewm, bounded, ewm_scan, row_index, short
from marketspark.operators.sessions import MONTHLY
from marketspark.session import stage


def _positioned(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Add ``idx`` and the previous close ``_prev_close``.

    Whole-series groups are numbered block by block and written once, because
    the scans read them several times; short series are windows like months.
    """
    if bounded(partition_cols):
        w = W.partitionBy(*partition_cols).orderBy("timestamp")
        return df.withColumns({
            "idx": F.row_number().over(w).cast("long") - 1,
            "_prev_close": F.lag("close").over(w),
        })
    numbered = row_index(df, partition_cols, "timestamp", previous={"_prev_close": "close"})
    return numbered if short(df) else stage(numbered, "series")


def _ema_specs(periods: Sequence[int]) -> list[Ewm]:
    return [Ewm(f"ema_{p}", "close", p, 2.0 / (p + 1)) for p in periods]


def _move_columns() -> dict[str, Column]:
    move = F.col("close") - F.col("_prev_close")
    return {"_gain": F.greatest(move, F.lit(0.0)), "_loss": F.greatest(-move, F.lit(0.0))}


def _true_range() -> Column:
    prev = F.col("_prev_close")
    return F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev)
    )


def _rsi(avg_gain: Column, avg_loss: Column) -> Column:
    total = avg_gain + avg_loss
    return F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(avg_gain * 100, total))


def add_indicators(
    df: DataFrame,
    partition_cols: Sequence[str] = MONTHLY,
    *,
    ema_periods: Sequence[int] = (20, 50, 200),
    rsi_period: int | None = 14,
    atr_period: int | None = 14,
    macd: tuple[int, int, int] | None = (12, 26, 9),
    across: str | None = None,
) -> DataFrame:
    """Any selection of the indicators in one or two shared scans.

    Values are null until an indicator's seed is complete. Whole-series results
    keep the row position ``idx`` and series length ``n``. All first-level
    averages run in one scan; only the MACD signal needs a second one.
    """
    columns = list(df.columns)
    if not bounded(partition_cols):
        columns += [c for c in ("idx", "n") if c not in columns]
    across = across or ("window" if bounded(partition_cols) or short(df) else "join")
    df = _positioned(df, partition_cols)
    specs = _ema_specs(ema_periods)
    helpers: dict[str, Column] = {}
    if rsi_period:
        helpers |= _move_columns()
        specs += [Ewm(f"_{x}s", f"_{x}", rsi_period, 1.0 / rsi_period, start=1)
                  for x in ("gain", "loss")]
    if atr_period:
        helpers["_tr"] = _true_range()
        specs.append(Ewm(f"atr_{atr_period}", "_tr", atr_period, 1.0 / atr_period, start=1))
    if macd:
        fast, slow, signal = macd
        # Both averages produce their first value at the same bar.
        specs += [
            Ewm("_fast", "close", fast, 2.0 / (fast + 1), start=slow - fast),
            Ewm("_slow", "close", slow, 2.0 / (slow + 1)),
        ]
    # Short series lie in time order from their numbering on.
    order = None if bounded(partition_cols) else "timestamp"
    df = ewm_scan(df.withColumns(helpers) if helpers else df, specs, partition_cols, across=across, order=order)
    out: list[str] = []
    if rsi_period:
        df = df.withColumn(f"rsi_{rsi_period}", _rsi(F.col("_gains"), F.col("_losss")))
        out.append(f"rsi_{rsi_period}")
    if macd:
        df = df.withColumn("_line", F.col("_fast") - F.col("_slow"))
        df = ewm_scan(
            df, [Ewm("macd_signal", "_line", signal, 2.0 / (signal + 1), start=slow - 1)],
            partition_cols, across=across, order=order,
        )
        ready = F.col("macd_signal").isNotNull()
        df = df.withColumns({
            "macd": F.when(ready, F.col("_line")),
            "macd_hist": F.col("_line") - F.col("macd_signal"),
        })
        out += ["macd", "macd_signal", "macd_hist"]
    if atr_period:
        out.append(f"atr_{atr_period}")
    out += [f"ema_{p}" for p in ema_periods]
    return df.select(*columns, *out)


def ema(df, partition_cols=MONTHLY, periods=(20, 50, 200), **kw) -> DataFrame:
    return add_indicators(df, partition_cols, ema_periods=periods, rsi_period=None,
                          atr_period=None, macd=None, **kw)


def rsi(df, partition_cols=MONTHLY, period=14, **kw) -> DataFrame:
    return add_indicators(df, partition_cols, ema_periods=(), rsi_period=period,
                          atr_period=None, macd=None, **kw)


def macd(df, partition_cols=MONTHLY, fast=12, slow=26, signal=9, **kw) -> DataFrame:
    return add_indicators(df, partition_cols, ema_periods=(), rsi_period=None,
                          atr_period=None, macd=(fast, slow, signal), **kw)


def atr(df, partition_cols=MONTHLY, period=14, **kw) -> DataFrame:
    return add_indicators(df, partition_cols, ema_periods=(), rsi_period=None,
                          atr_period=period, macd=None, **kw)


def normalized_distances(df: DataFrame, atr_col: str = "atr_14") -> DataFrame:
    """Every distance column divided by ATR; a zero ATR gives null.

    Without the ATR column the frame is returned unchanged.
    """
    if atr_col not in df.columns:
        return df
    distances = [c for c in df.columns if c.startswith(("dist_to_", "pp_dist_"))]
    return df.withColumns({f"{c}_atr": F.try_divide(c, atr_col) for c in distances})
