"""Exact distributions of many features without gathering one feature in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here equal values are counted first (map-side), the counts are put in order by a
range partitioning, and exact ranks come from running counts inside its ranges
plus an offset per range. Where the ranges are cut does not change a result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window as W

from marketspark.functions.scans import UNBOUNDED, ordered


def _usable(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def value_counts(sides: Mapping[str, DataFrame], features: Sequence[str]) -> DataFrame:
    """``feature, value, c_<side>…``: how often each value occurs on each side."""
    stacked = None
    for name, df in sides.items():
        rows = df.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot(
            [], list(features), "feature", "value"
        )
        rows = rows.select(
            "feature", "value",
            *[F.lit(1 if other == name else 0).cast("long").alias(f"c_{other}") for other in sides],
        )
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return (
        stacked.where(_usable(F.col("value")))
        .groupBy("feature", "value")
        .agg(*[F.sum(f"c_{s}").alias(f"c_{s}") for s in sides])
    )


def cumulative(sides: Mapping[str, DataFrame], features: Sequence[str]) -> DataFrame:
    """Value counts with exact cumulative counts ``cum_<side>`` and totals ``n_<side>``."""
    return running(value_counts(sides, features), list(sides))


def running(counts: DataFrame, sides: Sequence[str]) -> DataFrame:
    """Cumulative counts of ``feature, value, c_<side>…`` rows, one row per feature and value."""
    placed = ordered(counts.select("feature", "value", *[f"c_{s}" for s in sides]), ["feature"], ["value"])
    per_block = placed.groupBy("feature", "_block").agg(
        *[F.sum(f"c_{s}").alias(f"_b_{s}") for s in sides]
    )
    upto = W.partitionBy("feature").orderBy("_block").rowsBetween(UNBOUNDED, 0)
    offsets = per_block.select(
        "feature", "_block",
        *[(F.sum(f"_b_{s}").over(upto) - F.col(f"_b_{s}")).alias(f"_pre_{s}") for s in sides],
        *[F.sum(f"_b_{s}").over(W.partitionBy("feature")).alias(f"n_{s}") for s in sides],
    )
    inside = W.partitionBy("feature", "_block").orderBy("_at").rowsBetween(UNBOUNDED, 0)
    local = placed.withColumns({f"_run_{s}": F.sum(f"c_{s}").over(inside) for s in sides})
    return local.join(offsets, ["feature", "_block"]).select(
        "feature", "value",
        *[f"c_{s}" for s in sides],
        *[(F.col(f"_pre_{s}") + F.col(f"_run_{s}")).alias(f"cum_{s}") for s in sides],
        *[f"n_{s}" for s in sides],
    )


def rank_quantiles(
    dist: DataFrame, probs: Sequence[float], names: Sequence[str], *, cum: Column, total: Column
) -> DataFrame:
    """Linear-interpolated quantiles per feature from cumulative counts."""
    rows = dist.select("feature", "value", cum.alias("_cum"), total.alias("_n"))
    parts = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        parts += [
            F.min(F.when(F.col("_cum") > F.floor(pos), F.col("value"))).alias(f"_lo{i}"),
            F.min(F.when(F.col("_cum") > F.ceil(pos), F.col("value"))).alias(f"_hi{i}"),
        ]
    found = rows.groupBy("feature").agg(F.max("_n").alias("n"), *parts)
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        pos = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((low + (high - low) * (pos - F.floor(pos))).alias(name))
    return found.select("feature", "n", *out)


def feature_quantiles(df: DataFrame, features: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of every feature column, one row per feature (``p25`` and so on)."""
    dist = cumulative({"all": df}, features)
    names = [f"p{round(p * 100)}" for p in probs]
    return rank_quantiles(dist, probs, names, cum=F.col("cum_all"), total=F.col("n_all"))
