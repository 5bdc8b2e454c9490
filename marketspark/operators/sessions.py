"""Trading-session levels and day/week/month levels in New York time.

Groups are calendar months (``symbol, tf, month``), so every window below holds
at most a month of bars. All windows share one hash partitioning, and nearly all of them
the order by time: a number that only grows with time (a session's, a day's) need
not be a partition key, since the running maximum of (number, value) already is
that of the newest number. Calendar weeks jump back at the turn of the year, so
they alone keep windows of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec

from marketspark.functions.scans import UNBOUNDED
from marketspark.functions.timecols import eastern, minute_of_day
from marketspark.schema import SESSIONS

MONTHLY = ("symbol", "month")


def et_parts(df: DataFrame) -> DataFrame:
    et = eastern(F.col("timestamp"))
    return df.withColumns({
        "et_hour": F.hour(et),
        "et_minute": F.minute(et),
        "et_weekday": F.weekday(et) + 1,
        "et_date": et.cast("date"),
    })


def in_window(minute: Column, start: int, end: int) -> Column:
    """Half-open minute window; one that ends before it starts wraps midnight."""
    if start < end:
        return (minute >= start) & (minute < end)
    return (minute >= start) | (minute < end)


def session_flags(df: DataFrame) -> DataFrame:
    minute = minute_of_day(eastern(F.col("timestamp")))
    return df.withColumns({
        f"in_{name}": in_window(minute, *bounds) for name, bounds in SESSIONS.items()
    })


def session_ids(df: DataFrame, partition_cols: Sequence[str] = MONTHLY) -> DataFrame:
    """Number of sessions opened so far; null on a group's first row."""
    ordered = W.partitionBy(*partition_cols).orderBy("timestamp")
    opened = df.withColumns({
        f"_open_{s}": F.greatest(
            F.col(f"in_{s}").cast("int") - F.lag(F.col(f"in_{s}").cast("int")).over(ordered),
            F.when(F.lag(F.lit(1)).over(ordered).isNotNull(), F.lit(0)),
        )
        for s in SESSIONS
    })
    so_far = ordered.rowsBetween(UNBOUNDED, 0)
    return opened.withColumns({
        f"kz_{s}_session_id": F.sum(f"_open_{s}").over(so_far) for s in SESSIONS
    }).drop(*[f"_open_{s}" for s in SESSIONS])


def _newest(number: str, value: Column, over: WindowSpec) -> Column:
    """Largest value so far among the rows of the newest number."""
    return F.max(F.struct(F.col(number), value.alias("v"))).over(over)["v"]


def session_levels(df: DataFrame, partition_cols: Sequence[str] = MONTHLY) -> DataFrame:
    """Running high and low since each session opened, with distances.

    Levels keep moving after the session closes, until the next one opens.
    """
    so_far = W.partitionBy(*partition_cols).orderBy("timestamp").rowsBetween(UNBOUNDED, 0)
    levels = {}
    for s in SESSIONS:
        sid = f"kz_{s}_session_id"
        levels[f"kz_{s}_high"] = _newest(sid, F.col("high"), so_far)
        levels[f"kz_{s}_low"] = -_newest(sid, -F.col("low"), so_far)
    df = df.withColumns(levels)
    derived = {}
    for s in SESSIONS:
        high, low = F.col(f"kz_{s}_high"), F.col(f"kz_{s}_low")
        derived[f"kz_{s}_mid"] = (high + low) / 2
        derived[f"kz_{s}_range"] = high - low
        derived[f"dist_to_{s}_high"] = F.col("close") - high
        derived[f"dist_to_{s}_low"] = F.col("close") - low
    return df.withColumns(derived)


def session_average_range(
    df: DataFrame, partition_cols: Sequence[str] = MONTHLY, n: int = 5, *, causal: bool = False
) -> DataFrame:
    """Mean range of the last ``n`` sessions.

    By default the current session counts with its final range, which looks
    ahead inside that session; ``causal`` uses finished sessions only.

    A session's range is the largest of its own bars, and of the group's last bar if no later session opened. Seen from the end of
    the group it is known on the bars of the session, seen from its start on those after it.
    """
    group = W.partitionBy(*partition_cols)
    ordered = group.orderBy("timestamp")
    so_far = ordered.rowsBetween(UNBOUNDED, 0)
    to_come = group.orderBy(F.col("timestamp").desc()).rowsBetween(UNBOUNDED, 0)
    helpers = ["_last_row", "_first_row"]
    df = df.withColumns({
        "_last_row": F.lead(F.lit(1)).over(ordered).isNull(),
        "_first_row": F.lag(F.lit(1)).over(ordered).isNull(),
        **{f"_before_{s}": F.lag(f"kz_{s}_session_id").over(ordered) for s in SESSIONS},
    })
    counted = {s: F.when(F.col(f"in_{s}") | F.col("_last_row"), F.col(f"kz_{s}_range")) for s in SESSIONS}
    df = df.withColumns({f"_past_{s}": _newest(f"kz_{s}_session_id", counted[s], so_far) for s in SESSIONS})
    # Downwards the group's first row (NULL) comes after every number.
    df = df.withColumns({f"_down_{s}": -F.coalesce(F.col(f"kz_{s}_session_id"), F.lit(-1)) for s in SESSIONS})
    df = df.withColumns({f"_future_{s}": _newest(f"_down_{s}", counted[s], to_come) for s in SESSIONS})
    ranges = {s: F.coalesce(f"_future_{s}", f"_past_{s}") for s in SESSIONS}
    heads = {
        s: F.col("_first_row") | ~F.col(f"kz_{s}_session_id").eqNullSafe(F.col(f"_before_{s}")) for s in SESSIONS
    }
    # The ranges of the group's sessions so far: a session a day at most.
    df = df.withColumns({f"_known_{s}": F.collect_list(F.when(heads[s], ranges[s])).over(so_far) for s in SESSIONS})
    means = {}
    for s in SESSIONS:
        known = F.col(f"_known_{s}")
        until = F.size(known) - (1 if causal else 0)
        start = F.greatest(until - n, F.lit(0))
        recent = F.slice(known, start + 1, until - start)
        mean = F.aggregate(recent, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(recent), F.lit(0))
        means[f"kz_{s}_avg_range"] = F.when(F.col(f"kz_{s}_session_id").isNotNull() & ranges[s].isNotNull(), mean)
        helpers += [f"_{part}_{s}" for part in ("before", "past", "down", "future", "known")]
    return df.withColumns(means).drop(*helpers)


def _period_keys(*, iso_year: bool) -> dict[str, Column]:
    et = eastern(F.col("timestamp"))
    year = F.extract(F.lit("YEAROFWEEK"), et) if iso_year else F.year(et)
    return {
        "d": et.cast("date"),
        "w": year * 100 + F.weekofyear(et),
        "m": F.year(et) * 100 + F.month(et),
    }


def _growing(iso_year: bool) -> str:
    """The periods whose keys never fall in time."""
    return "dwm" if iso_year else "dm"


def _with_heads(df: DataFrame, partition_cols: Sequence[str], iso_year: bool) -> DataFrame:
    """``df`` with the period keys, and for growing ones whether a row is the first of its period."""
    ordered = W.partitionBy(*partition_cols).orderBy("timestamp")
    df = df.withColumns({f"_{p}": key for p, key in _period_keys(iso_year=iso_year).items()})
    return df.withColumns({
        f"_head_{p}": ~F.col(f"_{p}").eqNullSafe(F.lag(f"_{p}").over(ordered)) for p in _growing(iso_year)
    })


def period_running(
    df: DataFrame, partition_cols: Sequence[str] = MONTHLY, *, iso_year: bool = False
) -> DataFrame:
    """Open, running high and running low of the current ET day, week and month.

    The week key is calendar year * 100 + ISO week unless ``iso_year`` is set.
    """
    so_far = W.partitionBy(*partition_cols).orderBy("timestamp").rowsBetween(UNBOUNDED, 0)
    df = _with_heads(df, partition_cols, iso_year)
    out = {}
    for p in "dwm":
        if p in _growing(iso_year):
            first = F.when(F.col(f"_head_{p}"), F.struct(F.col("open").alias("v")))
            out[f"{p}_open"] = F.last(first, ignorenulls=True).over(so_far)["v"]
            out[f"{p}_high"] = _newest(f"_{p}", F.col("high"), so_far)
            out[f"{p}_low"] = -_newest(f"_{p}", -F.col("low"), so_far)
        else:
            w = W.partitionBy(*partition_cols, f"_{p}").orderBy("timestamp").rowsBetween(UNBOUNDED, 0)
            out[f"{p}_open"] = F.first("open").over(w)
            out[f"{p}_high"] = F.max("high").over(w)
            out[f"{p}_low"] = F.min("low").over(w)
    return df.withColumns(out).drop("_d", "_w", "_m", *[f"_head_{p}" for p in "dwm"])


def period_previous(
    df: DataFrame, partition_cols: Sequence[str] = MONTHLY, *, iso_year: bool = False
) -> DataFrame:
    """High and low of the previous ET day, week and month that has bars."""
    group = W.partitionBy(*partition_cols)
    ordered = group.orderBy("timestamp")
    so_far = ordered.rowsBetween(UNBOUNDED, 0)
    growing = _growing(iso_year)
    df = _with_heads(df, partition_cols, iso_year)
    df = df.withColumns({
        f"_run_{p}": F.struct(_newest(f"_{p}", F.col("high"), so_far).alias("high"),
                              (-_newest(f"_{p}", -F.col("low"), so_far)).alias("low")) for p in growing
    })
    df = df.withColumns({f"_ended_{p}": F.lag(f"_run_{p}").over(ordered) for p in growing})
    # What a period's first row saw before it holds for all its rows.
    ended = {p: F.last(F.when(F.col(f"_head_{p}"), F.struct(F.col(f"_ended_{p}").alias("v"))), ignorenulls=True).over(so_far)["v"]
             for p in growing}
    df = df.withColumns({f"p{p}_{side}": ended[p][side] for p in growing for side in ("high", "low")})
    for p in set("dwm") - set(growing):
        before = group.orderBy("_rank").rangeBetween(-1, -1)
        df = df.withColumn("_rank", F.dense_rank().over(group.orderBy(f"_{p}")))
        df = df.withColumns({f"p{p}_high": F.max("high").over(before), f"p{p}_low": F.min("low").over(before)})
    return df.drop("_rank", *[f"_{part}{p}" for part in ("", "head_", "run_", "ended_") for p in "dwm"])


def add_session_features(
    df: DataFrame, partition_cols: Sequence[str] = MONTHLY, avg_range_n: int = 5
) -> DataFrame:
    df = session_flags(df)
    df = session_ids(df, partition_cols)
    df = session_levels(df, partition_cols)
    df = session_average_range(df, partition_cols, avg_range_n)
    df = period_running(df, partition_cols)
    return period_previous(df, partition_cols)
