"""Trade simulation, equity, drawdowns, bootstrap bands and performance metrics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.functions.scans import UNBOUNDED, halo_blocks, longest, row_index, running_total, short
from marketspark.session import stage

SERIES = ("symbol",)
TRADE_BLOCK = 1024
#: Block tables composed in one row.
CHAIN = 64


def indexed_bars(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Bars with their position ``idx`` and series length ``n``, written once unless they have them already."""
    if {"idx", "n"} <= set(df.columns):
        return df
    return stage(row_index(df, keys, "timestamp"), "indexed")


def trade_candidates(
    bars: DataFrame,
    signal_col: str = "signal",
    *,
    keys: Sequence[str] = SERIES,
    tp_r: float | Column = 2.0,
    sl_r: float | Column = 1.0,
    horizon_limit: int = 10,
    atr_col: str = "atr_14",
    atr_mult: float = 0.5,
    commission: float | Column = 0.0,
    slippage: float | Column = 0.0,
    block: int = TRADE_BLOCK,
    settings: Column | None = None,
) -> DataFrame:
    """What would happen to a trade opened at every signal, each on its own.

    ``settings``, an array of structs of ``param_`` fields, is opened per signal once its future bars are known: rules may name
    the fields, and the windows over bars are the same for one setting and for many.

    ``bars`` must carry ``idx`` and ``n``. A signal at bar s enters at the open
    of s+1; bar s+2 is the first that can hit a stop or target, the stop is
    looked at first, and after ``horizon_limit`` bars the trade ends at the
    close. ``exit_idx`` is ``n`` (and the exit columns null) when the data ends
    before the trade does. Bars are cut into runs with a short overlap, so no
    task ever holds a whole series.
    """
    signal = F.col(signal_col)
    rows = bars.select(*keys, "idx", "n", "timestamp", "open", "high", "low", "close",
                       signal.alias("signal"), F.col(atr_col).alias("_atr"))
    if short(bars, block):
        # One block a series, in the order in which it was numbered.
        rows, w = rows.withColumn("core", F.lit(True)), W.partitionBy(*keys).orderBy("timestamp")
    else:
        rows, w = halo_blocks(rows, block, after=horizon_limit + 1), W.partitionBy(*keys, "blk").orderBy("idx")
    held = range(1, horizon_limit + 1)
    rows = rows.withColumns({
        "_entry_time": F.lead("timestamp").over(w),
        "entry_price": F.lead("open").over(w),
        "_last_close": F.lead("close", horizon_limit + 1).over(w),
        **{f"_{name}_{k}": F.lead(name, k + 1).over(w) for k in held for name in ("timestamp", "high", "low")},
    }).where(
        F.col("core") & signal_is_open() & F.col("_atr").isNotNull() & (F.col("_atr") > 0)
        & (F.col("idx") < F.col("n") - 1)
    )
    if settings is not None:
        rows = rows.select("*", F.inline(settings))
    params = [c for c in rows.columns if c.startswith("param_")]
    risk = F.col("_atr") * atr_mult
    side = F.col("signal")

    def number(value: float | Column) -> Column:
        return value if isinstance(value, Column) else F.lit(float(value))

    rows = rows.withColumns({
        "_risk": risk,
        "_sl": F.col("entry_price") - side * risk * number(sl_r),
        "_tp": F.col("entry_price") + side * risk * number(tp_r),
    })
    is_long = side == 1

    def outcome(k: int) -> Column:
        """Bars held and how the trade ends (1: stop, 2: target, 3: time) as one number; null while it goes on."""
        low, high = F.col(f"_low_{k}"), F.col(f"_high_{k}")
        stopped = F.when(is_long, low <= F.col("_sl")).otherwise(high >= F.col("_sl"))
        reached = F.when(is_long, high >= F.col("_tp")).otherwise(low <= F.col("_tp"))
        end = F.when(stopped, 4 * k + 1).when(reached, 4 * k + 2)
        return end.when(F.col(f"_timestamp_{k}").isNotNull(), 4 * k + 3) if k == horizon_limit else end

    rows = rows.withColumn("_end", F.coalesce(*[outcome(k) for k in held]))
    rows = rows.withColumns({"_held": F.shiftright("_end", 2), "_how": F.col("_end").bitwiseAND(3)})
    reason = F.when(F.col("_how") == 1, "SL").when(F.col("_how") == 2, "TP").when(F.col("_how") == 3, "TIME")
    exit_price = F.when(F.col("_how") == 1, F.col("_sl")).when(F.col("_how") == 2, F.col("_tp")).otherwise(F.col("_last_close"))
    exit_time = F.get(F.array(*[F.col(f"_timestamp_{k}") for k in held]), F.col("_held") - 1)
    gross = (
        F.when(F.col("_how") == 1, -number(sl_r))
        .when(F.col("_how") == 2, number(tp_r))
        .otherwise(side * (exit_price - F.col("entry_price")) / F.col("_risk"))
    )
    cost = (number(commission) + number(slippage) * 2) / F.col("_risk")
    return rows.select(
        *keys, *params, "idx", "n",
        F.col("_entry_time").alias("entry_time"),
        exit_time.alias("exit_time"),
        F.when(is_long, "LONG").otherwise("SHORT").alias("signal"),
        "entry_price",
        exit_price.alias("exit_price"),
        F.col("_held").alias("bars_held"),
        (gross - cost).alias("pnl_r"),
        reason.alias("reason"),
        F.weekday("_entry_time").alias("weekday"),
        F.hour("_entry_time").alias("hour"),
        F.coalesce(F.col("idx") + 1 + F.col("_held"), F.col("n")).cast("long").alias("exit_idx"),
    )


def signal_is_open(column: str = "signal") -> Column:
    return F.col(column).isin(1, -1)


def _after(position: Column, table: Column) -> Column:
    """Where a block that is reached at ``position`` is left."""
    return table["_ends"][F.greatest(position - table["_first"], F.lit(0)).cast("int")]


def _block_starts(tables: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """``keys, _blk, _start``: the position at which each block is reached.

    ``tables`` say where a block is left for each of ``width`` ways to reach it.
    ``CHAIN`` neighbouring blocks compose to a table of the same shape, and those
    compose again, until a series is one table; then the positions go down level
    by level. No row ever holds more than ``CHAIN`` tables. Blocks without
    candidates leave the position alone, so only listed blocks matter.
    """
    highest = tables.agg(F.max("_blk")).first()[0]
    packed = tables.groupBy(*keys, F.floor(F.col("_blk") / CHAIN).alias("_up")).agg(
        F.array_sort(F.collect_list(F.struct("_blk", "_first", "_ends"))).alias("_tables"))
    if highest is None or highest < CHAIN:
        above = packed.withColumn("_start", F.lit(0).cast("long"))
    else:
        packed = stage(packed, "chain")
        origin = F.col("_tables")[0]["_first"]
        ends = F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda s: F.aggregate("_tables", (origin + s).cast("long"), _after))
        up = stage(packed.select(*keys, F.col("_up").alias("_blk"), origin.alias("_first"), ends.alias("_ends")), "chain")
        above = packed.join(
            _block_starts(up, keys, width).withColumnRenamed("_blk", "_up"), [*keys, "_up"])
    walk = F.aggregate(
        "_tables",
        F.struct(F.col("_start").alias("position"),
                 F.array().cast("array<struct<_blk:bigint,_start:bigint>>").alias("starts")),
        lambda acc, t: F.struct(
            _after(acc["position"], t).alias("position"),
            F.concat(acc["starts"], F.array(F.struct(
                t["_blk"].alias("_blk"), F.greatest(acc["position"], t["_first"]).alias("_start")))).alias("starts")),
        lambda acc: acc["starts"],
    )
    return above.select(*keys, F.inline(walk))


def select_non_overlapping(
    candidates: DataFrame,
    *,
    keys: Sequence[str] = SERIES,
    horizon_limit: int = 10,
    block: int = TRADE_BLOCK,
) -> DataFrame:
    """Keep the trades a trader holding one position at a time would take.

    The chain "take the first signal at or after the last exit" is sequential,
    but at a block border its whole state is how many of the next block's bars
    are still taken: at most ``horizon_limit + 1`` values. So every block works
    out, in parallel, where it would end for each possible start; those short
    tables are composed level by level; then every block replays its one true start.
    """
    width = horizon_limit + 1
    if block <= width:
        raise ValueError("the block must be longer than a trade can last")
    cand = candidates.withColumn("_blk", F.floor(F.col("idx") / block))
    # At most `block` candidates fall into a block, so the arrays are small.
    grouped = cand.groupBy(*keys, "_blk").agg(
        F.array_sort(F.collect_list(F.struct("idx", "exit_idx"))).alias("_cands"),
        F.max("n").alias("_n"),
    )
    first = F.col("_blk") * block

    def advance(position: Column, c: Column) -> Column:
        return F.when(c["idx"] >= position, c["exit_idx"]).otherwise(position)

    tables = grouped.withColumn(
        "_ends",
        F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda start: F.aggregate("_cands", (first + start).cast("long"), advance),
        ),
    )
    tables = stage(tables, "blocks")
    # A trade that never closes ends at position n; it was opened fewer than
    # `width` bars before the end, so even then the lookup stays inside the table.
    starts = _block_starts(tables.select(*keys, "_blk", first.alias("_first"), "_ends"), keys, width)
    replayed = tables.join(starts, [*keys, "_blk"]).select(
        *keys, F.explode(
            F.aggregate(
                "_cands",
                F.struct(F.col("_start").alias("position"), F.array().cast("array<bigint>").alias("taken")),
                lambda acc, c: F.when(
                    c["idx"] >= acc["position"],
                    F.struct(c["exit_idx"].alias("position"),
                             F.concat(acc["taken"], F.array(c["idx"])).alias("taken")),
                ).otherwise(acc),
                lambda acc: acc["taken"],
            )
        ).alias("idx")
    )
    return candidates.join(replayed, [*keys, "idx"], "left_semi")


def _non_overlapping_of_one_block(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same choice where every series is a single block: one walk over its candidates, without tables of borders."""
    rest = [c for c in candidates.columns if c not in (*keys, "idx")]
    series = candidates.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", *rest))).alias("_cands"))
    taken = F.aggregate(
        "_cands", F.struct(F.lit(0).cast("long").alias("position"), F.slice("_cands", 1, 0).alias("taken")),
        lambda acc, c: F.when(
            c["idx"] >= acc["position"],
            F.struct(c["exit_idx"].alias("position"), F.concat(acc["taken"], F.array(c)).alias("taken")),
        ).otherwise(acc),
        lambda acc: acc["taken"])
    return series.select(*keys, F.inline(taken)).select(*candidates.columns).withMetadata("idx", candidates.schema["idx"].metadata)


def simulate_trades(
    bars: DataFrame,
    signal_col: str = "signal",
    *,
    keys: Sequence[str] = SERIES,
    horizon_limit: int = 10,
    block: int = TRADE_BLOCK,
    settings: Column | None = None,
    **rules,
) -> DataFrame:
    """Sequential, non-overlapping trades per series (``bars`` carry ``idx`` and ``n``), and per ``param_id`` of ``settings``."""
    candidates = trade_candidates(
        bars, signal_col, keys=keys, horizon_limit=horizon_limit, block=block, settings=settings, **rules)
    if settings is not None:
        keys = (*keys, "param_id")
    if short(bars, block):
        taken = _non_overlapping_of_one_block(candidates, keys)
    else:
        taken = select_non_overlapping(stage(candidates, "candidates"), keys=keys, horizon_limit=horizon_limit, block=block)
    return taken.where(F.col("reason").isNotNull()).drop("n")


def equity_curve(
    trades: DataFrame, *, keys: Sequence[str] = SERIES, peak_floor: float | None = None,
    block: int = 4096,
) -> DataFrame:
    """Running profit, running peak and drawdown in trade order (``i`` from 0).

    ``peak_floor=None``: the peak starts at the first equity value. With a
    floor of 0 the peak starts at 0. Blocks of trades are summed on their own
    and joined with the totals and peaks of the blocks before them; short series are windows.
    """
    numbered = _trade_numbers(trades, keys)
    if short(trades):
        whole = W.partitionBy(*keys).orderBy("i").rowsBetween(UNBOUNDED, 0)
        curve = numbered.withColumn("equity", F.sum("pnl_r").over(whole))
        top = F.max("equity").over(whole)
        peak = top if peak_floor is None else F.greatest(top, F.lit(float(peak_floor)))
        return curve.withColumn("peak", peak).withColumn("drawdown", F.col("peak") - F.col("equity"))
    numbered = numbered.withColumn("_blk", F.floor(F.col("i") / block))
    inside = W.partitionBy(*keys, "_blk").orderBy("i").rowsBetween(UNBOUNDED, 0)
    local = numbered.withColumn("_sum", F.sum("pnl_r").over(inside))
    local = stage(local.withColumn("_max", F.max("_sum").over(inside)), "equity")
    per_block = local.groupBy(*keys, "_blk").agg(
        F.max_by("_sum", "i").alias("_total"), F.max("_sum").alias("_top")
    )
    before = W.partitionBy(*keys).orderBy("_blk").rowsBetween(UNBOUNDED, -1)
    carried = per_block.withColumn("_pre", F.coalesce(F.sum("_total").over(before), F.lit(0.0)))
    carried = carried.withColumn("_peak", F.max(F.col("_pre") + F.col("_top")).over(before))
    joined = local.join(carried.select(*keys, "_blk", "_pre", "_peak"), [*keys, "_blk"])
    peak = [F.col("_pre") + F.col("_max"), F.col("_peak")]
    if peak_floor is not None:
        peak.append(F.lit(float(peak_floor)))
    return (
        joined.withColumns({"equity": F.col("_pre") + F.col("_sum"), "peak": F.greatest(*peak)})
        .withColumn("drawdown", F.col("peak") - F.col("equity"))
        .drop("_blk", "_sum", "_max", "_pre", "_peak")
    )


def _trade_numbers(trades: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number trades per series in exit order (which is entry order: they do not overlap)."""
    numbered = row_index(trades.drop("idx", "exit_idx"), keys, "entry_time", most=longest(trades))
    return numbered.withColumnRenamed("idx", "i").drop("n")


def backtest_metrics(
    trades: DataFrame,
    *,
    keys: Sequence[str] = SERIES,
    initial_capital: float = 10_000.0,
    risk_pct: float = 1.0,
    all_keys: DataFrame | None = None,
) -> DataFrame:
    """The performance row of each series.

    Without losses ``profit_factor`` is null and ``no_losses`` true. Series in
    ``all_keys`` that made no trade get the zero row.
    """
    curve = equity_curve(trades, keys=keys)
    pnl = F.col("pnl_r")
    loss = F.when(pnl < 0, pnl)
    sums = curve.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.count_if(pnl > 0).alias("_wins"),
        F.sum(pnl).alias("total_r"),
        F.max("drawdown").alias("max_drawdown_r"),
        F.coalesce(F.sum(F.when(pnl > 0, pnl)), F.lit(0.0)).alias("_profit"),
        F.coalesce(-F.sum(loss), F.lit(0.0)).alias("_loss"),
        F.avg(pnl).alias("_mean"),
        F.stddev_pop(pnl).alias("_std"),
        F.coalesce(F.stddev_pop(loss), F.lit(0.0)).alias("_down"),
    )
    if all_keys is not None:
        sums = all_keys.select(*keys).distinct().join(sums, list(keys), "left").fillna(0)
    stake = initial_capital * risk_pct / 100.0

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.try_divide(a, b)).otherwise(F.lit(0.0))

    return sums.select(
        *keys,
        "total_trades",
        F.coalesce(F.try_divide(F.col("_wins") * 100.0, F.col("total_trades")), F.lit(0.0)).alias("win_rate"),
        "total_r",
        "max_drawdown_r",
        F.when(F.col("total_trades") == 0, F.lit(0.0)).otherwise(F.try_divide("_profit", "_loss"))
        .alias("profit_factor"),
        ((F.col("total_trades") > 0) & (F.col("_loss") == 0)).alias("no_losses"),
        (F.col("total_r") * stake).alias("net_profit_dollar"),
        (F.col("total_r") * stake + initial_capital).alias("final_capital"),
        ratio("_mean", "_std").alias("sharpe_ratio"),
        ratio("_mean", "_down").alias("sortino_ratio"),
        ratio("total_r", "max_drawdown_r").alias("calmar_ratio"),
    )


def rolling_sharpe(
    trades: DataFrame, *, keys: Sequence[str] = SERIES, window: int = 20,
    annualization: float = 252.0, block: int = 4096,
) -> DataFrame:
    """Annualised mean over deviation of the last ``window`` trades; null before that."""
    numbered = _trade_numbers(trades, keys)
    rows = halo_blocks(numbered, block, before=window - 1, idx="i")
    w = W.partitionBy(*keys, "blk").orderBy("i").rowsBetween(-(window - 1), 0)
    std = F.stddev_pop("pnl_r").over(w)
    rows = rows.withColumn(
        "rolling_sharpe",
        F.when(
            (F.col("i") >= window - 1) & (std > 0),
            F.try_divide(F.avg("pnl_r").over(w), std) * (annualization ** 0.5),
        ),
    )
    return rows.where("core").drop("blk", "core")


def drawdown_events(curve: DataFrame, *, keys: Sequence[str] = SERIES, block: int = 4096) -> DataFrame:
    """Drawdown episodes of an equity curve.

    An episode runs from the first value under the peak to the recovery. One
    still open at the end counts only if its lowest point is not its first.
    """
    at_peak = (F.col("drawdown") == 0).cast("long")
    if short(curve):
        islands = curve.withColumns({
            "_island": F.sum(at_peak).over(W.partitionBy(*keys).orderBy("i").rowsBetween(UNBOUNDED, 0)),
            "_last": F.max("i").over(W.partitionBy(*keys))})
    else:
        curve = stage(curve.withColumn("_blk", F.floor(F.col("i") / block)), "curve")
        islands = running_total(curve, keys, "_blk", "i", {"_island": at_peak}).join(
            curve.groupBy(*keys).agg(F.max("i").alias("_last")), list(keys))
    events = islands.where(F.col("drawdown") > 0).groupBy(*keys, "_island").agg(
        F.min("i").alias("start_idx"),
        F.max("i").alias("_end"),
        F.min(F.struct("equity", "i")).alias("_low"),
        F.max("peak").alias("_peak"),
        F.max("_last").alias("_last"),
    ).withColumn("ongoing", F.col("_end") == F.col("_last"))
    trough = F.col("_low.i")
    events = events.where(~F.col("ongoing") | (trough > F.col("start_idx")))
    end = F.when(F.col("ongoing"), F.col("_last")).otherwise(F.col("_end") + 1)
    return events.select(
        *keys,
        "start_idx",
        trough.alias("trough_idx"),
        end.alias("end_idx"),
        (F.col("_peak") - F.col("_low.equity")).alias("magnitude"),
        (trough - F.col("start_idx")).alias("duration"),
        (end - trough).alias("recovery"),
        F.when(F.col("ongoing"), F.col("_last") + 1 - F.col("start_idx"))
        .otherwise(end - F.col("start_idx")).alias("total_bars"),
        "ongoing",
    )


def drawdown_summary(curve: DataFrame, events: DataFrame, *, keys: Sequence[str] = SERIES) -> DataFrame:
    """Largest and mean drawdown, and mean recovery of closed episodes."""
    under = F.when(F.col("drawdown") > 0, F.col("drawdown"))
    depth = curve.groupBy(*keys).agg(
        F.max("drawdown").alias("max_drawdown"),
        F.coalesce(F.avg(under), F.lit(0.0)).alias("avg_drawdown"),
    )
    closed = F.when((F.col("recovery") > 0) & ~F.col("ongoing"), F.col("recovery"))
    healing = events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_events"), F.avg(closed).alias("avg_recovery")
    )
    return depth.join(healing, list(keys), "left").fillna(0, ["n_events", "avg_recovery"])


def bootstrap_draw(path: Column, step: Column, seed: int) -> Column:
    """A 31-bit pseudo-random number from integer arithmetic, repeatable anywhere."""
    prime = F.lit(2147483647).cast("long")

    def mix(h: Column) -> Column:
        return F.pmod(h * h + h * 48271 + 11, prime)

    start = F.pmod(path * 73856093 + step * 19349663 + F.lit(seed * 83492791), prime)
    return mix(mix(start))


def _draw(path: np.ndarray, step: np.ndarray, seed: int) -> np.ndarray:
    """``bootstrap_draw`` on 64-bit integers: products stay below 2**63."""
    prime = np.int64(2147483647)
    h = (path * 73856093 + step * 19349663 + np.int64(seed * 83492791)) % prime
    for _ in range(2):
        h = (h * h + h * 48271 + 11) % prime
    return h


def bootstrap_bands(
    trades: DataFrame, *, keys: Sequence[str] = SERIES, n_paths: int = 1000, seed: int = 42,
    block: int = 1024,
) -> DataFrame:
    """Mean and 68 % / 95 % bands of resampled equity curves, per step.

    A block of steps is one group with all paths as vectors: it fetches the returns of its series, block by block, and draws in
    memory. The first pass keeps the total of each path per block; totals are summed over the blocks before; the second pass draws
    again from there and reduces each step to its bands. So what is shuffled are the packed returns, one row per pair of blocks,
    and one total per path and block, never a row per path and step.
    """
    numbered = row_index(trades.select(*keys, "entry_time", "pnl_r"), keys, "entry_time").select(
        *keys, "n", F.floor(F.col("idx") / block).alias("src"), "idx", "pnl_r")
    packed = stage(numbered.groupBy(*keys, "n", "src").agg(
        F.array_sort(F.collect_list(F.struct("idx", "pnl_r"))).alias("_held")), "returns")
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block))
    asked = packed.select(*keys, "n", "src", F.col("_held.pnl_r").alias("pnl"), F.explode(blocks).alias("blk"))
    kinds = ", ".join(f"{k} {trades.schema[k].dataType.simpleString()}" for k in keys)
    group = [*keys, "blk"]
    paths = np.arange(n_paths, dtype=np.int64)

    def drawn(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(steps, returns by path and step) of one block."""
        pnl = np.concatenate(rows.sort_values("src")["pnl"].to_list())
        n, blk = int(rows["n"].iloc[0]), int(rows["blk"].iloc[0])
        steps = np.arange(blk * block, min(n, (blk + 1) * block), dtype=np.int64)
        return steps, pnl[_draw(paths[:, None], steps[None], seed) % n]

    def totals(rows: pd.DataFrame) -> pd.DataFrame:
        _, found = drawn(rows)
        return rows[group].iloc[:1].assign(totals=[found.sum(axis=1)])

    def bands(rows: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        steps, found = drawn(rows)
        start = np.zeros(n_paths)
        start[before["path"].to_numpy(np.int64)] = before["start"]
        equity = start[:, None] + np.cumsum(found, axis=1)
        cuts = np.percentile(equity, [2.5, 16, 84, 97.5], axis=0)
        one = {k: rows[k].iloc[0] for k in keys}
        return pd.DataFrame({**{k: [v] * len(steps) for k, v in one.items()}, "step": steps, "equity_mean": equity.mean(axis=0),
                             "lower_95": cuts[0], "lower_68": cuts[1], "upper_68": cuts[2], "upper_95": cuts[3]})

    by_block = asked.groupBy(*group).applyInPandas(totals, f"{kinds}, blk long, totals array<double>")
    earlier = W.partitionBy(*keys, "path").orderBy("blk").rowsBetween(UNBOUNDED, -1)
    starts = by_block.select(*group, F.posexplode("totals").alias("path", "total")).select(
        *group, "path", F.coalesce(F.sum("total").over(earlier), F.lit(0.0)).alias("start"))
    return asked.groupBy(*group).cogroup(starts.groupBy(*group)).applyInPandas(
        bands, f"{kinds}, step long, equity_mean double, lower_95 double, lower_68 double, upper_68 double, upper_95 double")


def sweep(
    bars: DataFrame, settings: Sequence[tuple[float, float, float]], signal_col: str = "signal",
    *, keys: Sequence[str] = SERIES, **rules,
) -> DataFrame:
    """Metrics for several (tp_r, sl_r, commission) settings in one job."""
    table = F.array(*[
        F.struct(F.lit(i).alias("param_id"), F.lit(float(tp)).alias("param_tp"),
                 F.lit(float(sl)).alias("param_sl"), F.lit(float(c)).alias("param_commission"))
        for i, (tp, sl, c) in enumerate(settings)
    ])
    series = (*keys, "param_id")
    trades = simulate_trades(
        bars, signal_col, keys=keys, settings=table, tp_r=F.col("param_tp"), sl_r=F.col("param_sl"),
        commission=F.col("param_commission"), **rules,
    )
    every = bars.select(*keys).distinct().select(*keys, F.inline(table)).select(*series)
    return backtest_metrics(trades, keys=series, all_keys=every)
