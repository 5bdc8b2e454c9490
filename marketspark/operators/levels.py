"""Support/resistance patterns and zones, pivot levels and the as-of join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.functions.scans import UNBOUNDED, bounded, last_known
from marketspark.functions.timecols import micros, period_start
from marketspark.operators.bars import anchor_ohlc
from marketspark.operators.sessions import MONTHLY
from marketspark.schema import ANCHOR_UNITS

PATTERNS = ("sr_resist_1bar", "sr_resist_2bar", "sr_support_1bar", "sr_support_2bar")
LEVELS = ("p", "r1", "r2", "r3", "r4", "r5", "s1", "s2", "s3", "s4", "s5")


def sr_patterns(df: DataFrame, partition_cols: Sequence[str] = MONTHLY, quiet: int = 4) -> DataFrame:
    """Breakout patterns against the bar two ago and the pair three and four ago.

    A pattern counts only when its raw condition did not hold in the ``quiet``
    bars before.
    """
    w = W.partitionBy(*partition_cols).orderBy("timestamp")

    def back(column: str, k: int) -> Column:
        return F.lag(column, k).over(w)

    one = {"hi": back("high", 2), "lo": back("low", 2)}
    two = {
        "hi": F.greatest(back("high", 3), back("high", 4)),
        "lo": F.least(back("low", 3), back("low", 4)),
    }
    df = df.withColumns({
        "_hi1": one["hi"], "_lo1": one["lo"], "_hi2": two["hi"], "_lo2": two["lo"],
        "_move1": F.abs(back("close", 1) - back("open", 1)),
        "_move2": F.abs(back("close", 1) - back("open", 2)),
    })
    rng1, rng2 = F.col("_hi1") - F.col("_lo1"), F.col("_hi2") - F.col("_lo2")
    strong1, strong2 = F.col("_move1") > rng1 * 2, F.col("_move2") > rng2 * 2
    raw = {
        "sr_resist_1bar": (F.col("high") < F.col("_lo1") - rng1) & strong1,
        "sr_resist_2bar": (F.col("high") < F.col("_lo2") - rng2) & strong2,
        "sr_support_1bar": (F.col("low") > F.col("_hi1") - rng1) & strong1,
        "sr_support_2bar": (F.col("low") > F.col("_hi2") + rng2) & strong2,
    }
    df = df.withColumns({f"_raw_{name}": cond for name, cond in raw.items()})
    recent = w.rowsBetween(-quiet, -1)
    return df.withColumns({
        name: F.col(f"_raw_{name}")
        & ~F.coalesce(F.max(f"_raw_{name}").over(recent), F.lit(False))
        for name in raw
    }).drop("_hi1", "_lo1", "_hi2", "_lo2", "_move1", "_move2", *[f"_raw_{n}" for n in raw])


def sr_zones(df: DataFrame, partition_cols: Sequence[str] = MONTHLY) -> DataFrame:
    """Latest resistance and support zone, distances and role reversal."""
    w = W.partitionBy(*partition_cols).orderBy("timestamp")
    sides = {
        "resist": F.col("sr_resist_1bar") | F.col("sr_resist_2bar"),
        "support": F.col("sr_support_1bar") | F.col("sr_support_2bar"),
    }
    df = df.withColumns({
        f"_{side}_{edge}": F.when(hit, F.lag(edge, 2).over(w))
        for side, hit in sides.items() for edge in ("high", "low")
    })
    so_far = w.rowsBetween(UNBOUNDED, 0)
    df = df.withColumns({
        f"nearest_{side}_{edge}": F.last(f"_{side}_{edge}", ignorenulls=True).over(so_far)
        for side in sides for edge in ("high", "low")
    }).drop(*[f"_{side}_{edge}" for side in sides for edge in ("high", "low")])
    close = F.col("close")
    r_hi, r_lo = F.col("nearest_resist_high"), F.col("nearest_resist_low")
    s_hi, s_lo = F.col("nearest_support_high"), F.col("nearest_support_low")
    return df.withColumns({
        "in_resist_zone": (close >= r_lo) & (close <= r_hi),
        "in_support_zone": (close >= s_lo) & (close <= s_hi),
        "dist_to_nearest_resist": close - r_lo,
        "dist_to_nearest_support": s_hi - close,
        "sr_role_reversal": F.when(close > r_hi, 1).when(close < s_lo, -1).otherwise(0).cast("byte"),
    })


def _floor_pivots(p: Column, h: Column, lo: Column) -> dict[str, Column]:
    """Levels shared by the floor-trader family, from a central price ``p``."""
    rng = h - lo
    up3, down3 = h + (p - lo) * 2, lo - (h - p) * 2
    return {
        "p": p, "r1": p * 2 - lo, "s1": p * 2 - h, "r2": p + rng, "s2": p - rng,
        "r3": up3, "s3": down3, "r4": up3 + rng, "s4": down3 - rng,
        "r5": up3 + rng + rng, "s5": down3 - rng - rng,
    }


def pivot_levels(kind: str, o: Column, h: Column, lo: Column, c: Column) -> dict[str, Column]:
    """Pivot levels of one period; levels a formula does not define are null."""
    kind = kind.lower()
    kind = {"classic": "traditional", "demark": "dm"}.get(kind, kind)
    rng = h - lo
    if kind == "traditional":
        levels = _floor_pivots((h + lo + c) / 3, h, lo)
    elif kind == "woodie":
        levels = _floor_pivots((h + lo + c * 2) / 4, h, lo)
        del levels["r5"], levels["s5"]
    elif kind == "fibonacci":
        p = (h + lo + c) / 3
        levels = {"p": p}
        for k, ratio in ((1, 0.382), (2, 0.618), (3, 1.0)):
            levels[f"r{k}"], levels[f"s{k}"] = p + rng * ratio, p - rng * ratio
    elif kind == "dm":
        x = (
            F.when(c < o, h + lo * 2 + c)
            .when(c > o, h * 2 + lo + c)
            .otherwise(h + lo + c * 2)
        )
        levels = {"p": x / 4, "r1": x / 2 - lo, "s1": x / 2 - h}
    elif kind == "camarilla":
        levels = {"p": (h + lo + c) / 3}
        for k, part in ((1, 12), (2, 6), (3, 4), (4, 2)):
            step = rng * 1.1 / part
            levels[f"r{k}"], levels[f"s{k}"] = c + step, c - step
        levels["r5"] = F.try_divide(h, lo) * c
        levels["s5"] = c - (levels["r5"] - c)
    else:
        raise ValueError(f"unknown pivot type {kind!r}")
    return {name: levels.get(name, F.lit(None).cast("double")) for name in LEVELS}


def pivot_points(
    df: DataFrame,
    kind: str = "traditional",
    anchor: str = "daily",
    partition_cols: Sequence[str] = MONTHLY,
    prefix: str = "pp",
) -> DataFrame:
    """Give each bar the pivot levels of the last completed anchor period.

    A period's levels become valid at the start of the next period that has
    bars, so "last completed" is simply the previous present period. In
    month-sized groups that is a range frame; over whole series it is an
    aggregate per period, a ``lag`` over those few rows, and an equi-join.
    """
    try:
        unit = ANCHOR_UNITS[anchor.lower()]
    except KeyError:
        raise ValueError(f"unknown anchor {anchor!r}; choose from {sorted(ANCHOR_UNITS)}") from None
    names = {"open": "_po", "high": "_ph", "low": "_pl", "close": "_pc"}
    df = df.withColumn("_period", period_start(F.col("timestamp"), unit))
    if bounded(partition_cols):
        df = df.withColumn(
            "_rank", F.dense_rank().over(W.partitionBy(*partition_cols).orderBy("_period"))
        ).withColumn("_us", micros(F.col("timestamp")))
        before = W.partitionBy(*partition_cols).orderBy("_rank").rangeBetween(-1, -1)
        df = df.withColumns({
            "_po": F.min_by("open", "_us").over(before),
            "_ph": F.max("high").over(before),
            "_pl": F.min("low").over(before),
            "_pc": F.max_by("close", "_us").over(before),
        }).drop("_rank", "_us")
    else:
        ohlc = anchor_ohlc(df, unit, keys=partition_cols)
        w = W.partitionBy(*partition_cols).orderBy("period")
        previous = ohlc.select(
            *partition_cols, F.col("period").alias("_period"),
            *[F.lag(c).over(w).alias(n) for c, n in names.items()],
        )
        df = df.join(previous, [*partition_cols, "_period"])
    levels = pivot_levels(kind, *[F.col(n) for n in names.values()])
    df = df.withColumns({f"{prefix}_{k}": v for k, v in levels.items()}).drop(
        "_period", *names.values()
    )
    close = F.col("close")
    return df.withColumns({
        f"{prefix}_dist_to_p": close - F.col(f"{prefix}_p"),
        f"{prefix}_above_p": close > F.col(f"{prefix}_p"),
        f"{prefix}_dist_to_r1": close - F.col(f"{prefix}_r1"),
        f"{prefix}_dist_to_s1": close - F.col(f"{prefix}_s1"),
    })


def add_level_features(
    df: DataFrame,
    partition_cols: Sequence[str] = MONTHLY,
    kind: str = "traditional",
    anchor: str = "daily",
    prefix: str = "pp",
) -> DataFrame:
    df = sr_zones(sr_patterns(df, partition_cols), partition_cols)
    return pivot_points(df, kind, anchor, partition_cols, prefix)


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str] = ("symbol",),
    on: str = "timestamp",
    values: Sequence[str],
) -> DataFrame:
    """Latest right row at or before each left row, per key.

    Both sides are stacked in time order, right rows first, and the last right row is carried forward. Blocks of that order hold
    like many rows, so one busy day of one key is many tasks. Ties on the right side are resolved by the largest value tuple.
    """
    payload = F.struct(*values)
    rest = [c for c in left.columns if c not in (*keys, on)]
    left_rows = left.select(
        *keys, on, F.lit(1).alias("_side"),
        F.struct(*rest).alias("_left"), F.lit(None).cast(right.select(payload).schema[0].dataType).alias("_right"),
    )
    right_rows = right.select(
        *keys, on, F.lit(0).alias("_side"),
        F.lit(None).cast(left_rows.schema["_left"].dataType).alias("_left"), payload.alias("_right"),
    )
    seen = last_known(left_rows.unionByName(right_rows), keys, [on, "_side", "_right"], "_right", "_match")
    return seen.where(F.col("_side") == 1).select(
        *keys, on, *[F.col("_left")[c].alias(c) for c in rest], *[F.col("_match")[v].alias(v) for v in values])
