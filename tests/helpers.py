"""Small frames and slow row-by-row models used only by the tests."""

import datetime as dt
import random

from pyspark.sql import functions as F

BAR_DDL = ("symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, "
           "volume double, tick_count int")


def bars_frame(spark, n, seed=1, start=dt.datetime(2024, 1, 1), step=dt.timedelta(hours=1), symbol="A"):
    rng = random.Random(seed)
    rows, price = [], 100.0
    for i in range(n):
        o = price
        c = round(o + rng.uniform(-2, 2), 2)
        hi, lo = round(max(o, c) + rng.random(), 2), round(min(o, c) - rng.random(), 2)
        rows.append((symbol, start + i * step, o, hi, lo, c, 10.0, 7))
        price = c
    df = spark.createDataFrame(rows, BAR_DDL).withColumn("month", F.trunc(F.col("timestamp").cast("date"), "month"))
    return df, rows


def ema_model(values, period, alpha, start=0):
    out = [None] * len(values)
    seed = start + period - 1
    if seed >= len(values):
        return out
    y = sum(values[start:seed + 1]) / period
    out[seed] = y
    for i in range(seed + 1, len(values)):
        y += alpha * (values[i] - y)
        out[i] = y
    return out


def trades_model(rows, atr, signals, tp, sl, limit, fee, mult=0.5):
    """One position at a time, written as a state machine over bars."""
    free_from, out, n = 0, [], len(rows)
    for s in range(n - 1):
        if s < free_from or signals[s] == 0 or atr[s] is None:
            continue
        side, entry, risk = signals[s], rows[s + 1][2], atr[s] * mult
        stop, target = entry - side * risk * sl, entry + side * risk * tp
        done = None
        for e in range(s + 2, n):
            hi, lo, close = rows[e][3], rows[e][4], rows[e][5]
            held = e - s - 1
            if (lo <= stop) if side == 1 else (hi >= stop):
                done = (e, -sl, "SL")
            elif (hi >= target) if side == 1 else (lo <= target):
                done = (e, tp, "TP")
            elif held >= limit:
                done = (e, side * (close - entry) / risk, "TIME")
            if done:
                break
        if done is None:
            break
        out.append((rows[s + 1][1], rows[done[0]][1], done[2], round(done[1] - fee / risk, 9)))
        free_from = done[0]
    return out
