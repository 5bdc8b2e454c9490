"""Feature drift between a reference and a live table: profile, KS, PSI, verdict.

The reference can be stored as a distribution: its values in order, with counts, in blocks. A live batch is then counted by block;
only blocks that may hold the greatest distance or hold a bin edge are opened, every other block stands as one row for all of its
values on both sides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.functions.quantiles import cumulative, rank_quantiles, running, value_counts
from marketspark.functions.scans import UNBOUNDED
from marketspark.session import stage

PROFILE_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)
#: Blocks of a feature's stored reference, so its index stays small; fewer where values repeat or a block would be under LEAST_BLOCK rows.
BLOCKS, LEAST_BLOCK = 4096, 64
#: Bins of the stability index.
BINS = 10


def _per_feature(df: DataFrame, features: Sequence[str], **aggs: Callable[[str], Column]) -> DataFrame:
    """One global aggregate turned into one row per feature."""
    row = df.agg(*[fn(f).alias(f"{name}__{f}") for f in features for name, fn in aggs.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), *[F.col(f"{name}__{f}").alias(name) for name in aggs])
        for f in features
    ])))


def _moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return _per_feature(df, features, mean=lambda f: F.avg(f), std=lambda f: F.stddev_pop(f))


def profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, mean, deviation and exact p5, p25, p50, p75, p95 per feature."""
    moments = _moments(df, features)
    names = [f"p{round(p * 100)}" for p in PROFILE_PROBS]
    quantiles = rank_quantiles(
        cumulative({"ref": df}, features), PROFILE_PROBS, names,
        cum=F.col("cum_ref"), total=F.col("n_ref"))
    return quantiles.join(moments, "feature")


def compare(reference: DataFrame, live: DataFrame, features: Sequence[str]) -> DataFrame:
    """Joint value distribution of both sides, written once for the tests below."""
    return stage(cumulative({"ref": reference, "live": live}, features), "distribution")


def _holds(probs: Sequence[float], start: Column, upto: Column, total: Column) -> Column:
    """Whether the ranks from ``start`` to before ``upto`` hold one that a quantile of ``probs`` is read from."""
    found = F.lit(False)
    for p in probs:
        at = (total - 1) * F.lit(float(p))
        for place in (F.floor(at), F.ceil(at)):
            found = found | ((place >= start) & (place < upto))
    return found


def save_reference(df: DataFrame, features: Sequence[str], path: str, *, block_rows: int | None = None) -> None:
    """Write the distribution of every feature to ``path/blocks`` and its profile to ``path/profile``.

    A block holds ``block_rows`` rows, by default so many that there are ``BLOCKS``; more where one value repeats more often.
    """
    dist = running(value_counts({"ref": df}, features), ["ref"])
    size = F.lit(block_rows) if block_rows else F.greatest(F.ceil(F.col("n_ref") / BLOCKS), F.lit(LEAST_BLOCK))
    blocks = dist.withColumn("blk", F.floor((F.col("cum_ref") - F.col("c_ref")) / size)).groupBy("feature", "blk").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("c_ref").alias("total"),
        F.array_sort(F.collect_list(F.struct("value", F.col("c_ref").alias("c")))).alias("held"))
    blocks.write.mode("overwrite").parquet(f"{path}/blocks")
    # The profile's quantiles are read from the few blocks that hold them.
    stored, series = df.sparkSession.read.parquet(f"{path}/blocks"), W.partitionBy("feature")
    ranks = stored.select("feature", "blk", "total").withColumns({
        "_upto": F.sum("total").over(series.orderBy("blk").rowsBetween(UNBOUNDED, 0)), "n_ref": F.sum("total").over(series)})
    start = F.col("_upto") - F.col("total")
    opened = stored.select("feature", "blk", "held").join(
        ranks.where(_holds(PROFILE_PROBS, start, F.col("_upto"), F.col("n_ref"))).select("feature", "blk", start.alias("_from"), "n_ref"),
        ["feature", "blk"]).select("feature", "blk", "_from", "n_ref", F.inline("held"))
    inside = W.partitionBy("feature", "blk").orderBy("value").rowsBetween(UNBOUNDED, 0)
    ranked = opened.withColumn("cum_ref", F.col("_from") + F.sum("c").over(inside))
    names = [f"p{round(p * 100)}" for p in PROFILE_PROBS]
    quantiles = rank_quantiles(ranked, PROFILE_PROBS, names, cum=F.col("cum_ref"), total=F.col("n_ref"))
    quantiles.join(_moments(df, features), "feature").write.mode("overwrite").parquet(f"{path}/profile")


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/profile")


def _placer() -> Callable[[pd.Series, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A function that goes to the tasks with what calls it, so they need not have this module."""
    def placed(column: pd.Series, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``column``, without NULL and NaN, and the place of the block of each."""
        values = column.to_numpy(dtype=float, na_value=np.nan)
        values = values[~np.isnan(values)]
        return values, np.maximum(np.searchsorted(starts, values, side="right") - 1, 0)

    return placed


def _live_blocks(live: DataFrame, features: Sequence[str], starts: dict[str, np.ndarray]) -> DataFrame:
    """(feature, blk, c_live): how many live values lie in each block; one row per block from a task. Values before the first count to it."""
    placed = _placer()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = {f: np.zeros(len(lows), dtype=np.int64) for f, lows in starts.items()}
        for part in parts:
            for f, lows in starts.items():
                _, at = placed(part[f], lows)
                found[f] += np.bincount(at, minlength=len(lows))
        for f, counts in found.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"feature": f, "blk": at, "c_live": counts[at]})

    return _doubles(live, features).mapInPandas(run, "feature string, blk long, c_live long").groupBy("feature", "blk").agg(
        F.sum("c_live").alias("c_live"))


def _live_values(
    live: DataFrame, features: Sequence[str], starts: dict[str, np.ndarray], opened: dict[str, np.ndarray],
) -> DataFrame:
    """(feature, value): the live values that lie in blocks marked in ``opened``."""
    placed = _placer()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for f, lows in starts.items():
                values, at = placed(part[f], lows)
                kept = values[opened[f][at]]
                if len(kept):
                    yield pd.DataFrame({"feature": f, "value": kept})

    return _doubles(live, features).mapInPandas(run, "feature string, value double")


def _doubles(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f).cast("double").alias(f) for f in features])


def against_stored(spark: SparkSession, path: str, live: DataFrame, features: Sequence[str]) -> DataFrame:
    """Joint distribution of a stored reference and a live table, for the tests below; features without reference are left out.

    The live table is counted by block first. Inside a block the distance of the two distribution functions is no more than that
    of the one at its end from the other at its start, so a block where this does not pass the greatest distance at a block's end
    is one row at its last value, unless it holds a bin edge. The live values of the others are read again. So the greatest
    distance stays exact, and so do bin edges and the counts below them.
    """
    blocks = spark.read.parquet(f"{path}/blocks").where(F.col("feature").isin(list(features)))
    index = blocks.select("feature", "blk", "lo", "hi", "total")  # the values themselves are not read
    known = index.select("feature", "blk", "lo").toPandas().sort_values(["feature", "lo"])  # BLOCKS rows a feature
    starts = {f: part["lo"].to_numpy(float) for f, part in known.groupby("feature")}
    numbers = {f: part["blk"].to_numpy(np.int64) for f, part in known.groupby("feature")}
    series = W.partitionBy("feature")
    place = F.row_number().over(series.orderBy("lo")) - 1
    counts = _live_blocks(live, features, starts).withColumnRenamed("blk", "_place")
    upto, before = series.orderBy("blk").rowsBetween(UNBOUNDED, 0), F.coalesce("c_live", F.lit(0).cast("long"))
    ranks = index.withColumn("_place", place).join(counts, ["feature", "_place"], "left").withColumn("c_live", before).withColumns({
        "_ref": F.sum("total").over(upto), "_live": F.sum("c_live").over(upto),
        "_refs": F.sum("total").over(series), "_lives": F.sum("c_live").over(series)})
    ref, lives = F.col("_ref"), F.col("_live")
    at_ref, at_live = (lambda x: F.try_divide(x, F.col("_refs"))), (lambda x: F.try_divide(x, F.col("_lives")))
    ranks = ranks.withColumns({
        "_gap": F.max(F.abs(at_ref(ref) - at_live(lives))).over(series),
        "_most": F.greatest(at_ref(ref) - at_live(lives - F.col("c_live")), at_live(lives) - at_ref(ref - F.col("total")))})
    pooled, total = ref + lives, F.col("_refs") + F.col("_lives")
    holds_edge = _holds([i / BINS for i in range(1, BINS)], pooled - F.col("total") - F.col("c_live"), pooled, total)
    marked = stage(ranks.select("feature", "blk", "hi", "total", "c_live", (
        F.coalesce(F.col("_most") > F.col("_gap"), F.lit(False)) | holds_edge).alias("open")), "blocks")
    open_ = marked.where("open").select("feature", "blk").toPandas()
    opened = {f: np.isin(at, open_.loc[open_["feature"] == f, "blk"].to_numpy(np.int64)) for f, at in numbers.items()}
    none = F.lit(0).cast("long")
    held = blocks.select("feature", "blk", "held").join(F.broadcast(marked.where("open").select("feature", "blk")), ["feature", "blk"]).select(
        "feature", F.inline("held")).select("feature", "value", F.col("c").alias("c_ref"), none.alias("c_live"))
    closed = marked.where("NOT open").select("feature", F.col("hi").alias("value"), F.col("total").alias("c_ref"), "c_live")
    values = _live_values(live, features, starts, opened).select("feature", "value", none.alias("c_ref"), F.lit(1).cast("long").alias("c_live"))
    joined = held.union(closed).union(values).groupBy("feature", "value").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_live").alias("c_live"))
    return stage(running(joined, ["ref", "live"]), "distribution")


def ks_statistic(joint: DataFrame) -> DataFrame:
    """Largest distance between the two empirical distribution functions."""
    gap = F.abs(F.col("cum_ref") / F.col("n_ref") - F.col("cum_live") / F.col("n_live"))
    return joint.where((F.col("n_ref") > 0) & (F.col("n_live") > 0)).groupBy("feature").agg(
        F.max(gap).alias("ks_stat"), F.max("n_ref").alias("n_ref"), F.max("n_live").alias("n_live"))


def ks_p_value(ks: DataFrame, terms: int = 100) -> DataFrame:
    """Asymptotic two-sided p-value (Kolmogorov's alternating series)."""
    en = F.col("n_ref") * F.col("n_live") / (F.col("n_ref") + F.col("n_live"))
    z2 = F.col("ks_stat") * F.col("ks_stat") * en
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(z2 * k * k * -2.0))
    p = F.when(z2 < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(series * 2, F.lit(0.0)), F.lit(1.0)))
    return ks.withColumn("ks_p", p)


def psi(joint: DataFrame, features: Sequence[str], *, bins: int = BINS, epsilon: float = 1e-6) -> DataFrame:
    """Population stability index over quantile bins of the pooled values."""
    cum = F.col("cum_ref") + F.col("cum_live")
    total = F.col("n_ref") + F.col("n_live")
    probs = [i / bins for i in range(1, bins)]
    names = [f"_e{i}" for i in range(1, bins)]
    edges = rank_quantiles(joint, probs, names, cum=cum, total=total).drop("n")
    below = {
        side: [F.sum(F.when(F.col("value") < F.col(e), F.col(f"c_{side}")).otherwise(0)).alias(f"_{side}{i}")
               for i, e in enumerate(names)]
        for side in ("ref", "live")
    }
    sums = joint.join(edges, "feature").groupBy("feature").agg(
        F.max("n_ref").alias("n_ref"), F.max("n_live").alias("n_live"), *below["ref"], *below["live"])

    def shares(side: str) -> list[Column]:
        marks = [F.lit(0), *[F.col(f"_{side}{i}") for i in range(bins - 1)], F.col(f"n_{side}")]
        return [(b - a + epsilon) / (F.col(f"n_{side}") + epsilon * bins) for a, b in zip(marks, marks[1:])]

    terms = [(q - p) * F.ln(q / p + epsilon) for p, q in zip(shares("ref"), shares("live"))]
    return sums.select("feature", F.greatest(sum(terms[1:], terms[0]), F.lit(0.0)).alias("psi"))


def report(
    reference: DataFrame | None, live: DataFrame | None, features: Sequence[str], *, threshold_ks: float = 0.1,
    threshold_psi: float = 0.2, min_samples: int = 30, joint: DataFrame | None = None,
) -> DataFrame:
    """Drift verdict per feature that has enough live values; ``joint`` stands in for both tables."""
    joint = joint if joint is not None else compare(reference, live, features)
    rows = ks_p_value(ks_statistic(joint)).where(F.col("n_live") >= min_samples)
    rows = rows.join(psi(joint, features), "feature")
    return rows.select(
        "feature", F.round("ks_stat", 4).alias("ks_stat"), F.round("ks_p", 4).alias("ks_p"),
        F.round("psi", 4).alias("psi"),
        ((F.col("ks_stat") > threshold_ks) | (F.col("psi") > threshold_psi)).alias("drifted"),
    )


def summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n_tested"), F.count_if("drifted").alias("n_drifted"))


def retrain_on_drift(rows: DataFrame, retrain: Callable[[], object]) -> object | None:
    """Call ``retrain`` only if at least one feature drifted."""
    return retrain() if summary(rows).first()["n_drifted"] > 0 else None
