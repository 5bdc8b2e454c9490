"""Classification scores and feature selection statistics from plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(y).alias("y"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def class_scores(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 per class seen on either side; 0 where undefined."""
    y, p, n = F.col("y"), F.col("prediction"), F.col("n")
    hit = y == p
    zero = F.lit(0).cast("long")
    # A hit is one row, a miss one for each of its classes.
    parts = confusion.select(*by, F.inline(F.array(
        F.struct(y.cast("int").alias("class"), F.when(hit, n).otherwise(zero).alias("tp"),
                 zero.alias("fp"), F.when(hit, zero).otherwise(n).alias("fn")),
        F.when(~hit, F.struct(p.cast("int").alias("class"), zero.alias("tp"), n.alias("fp"),
                              zero.alias("fn"))),
    ))).where(F.col("tp").isNotNull())
    sums = parts.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.withColumns({
        "precision": share(tp, tp + fp), "recall": share(tp, tp + fn),
        "f1": share(tp * 2, tp * 2 + fp + fn),
    })


def macro_f1(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean F1 over the union of true and predicted classes; 0 without rows."""
    scores = class_scores(confusion_counts(df, y, pred, by), by)
    return scores.groupBy(*by).agg(
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"), F.count(F.lit(1)).alias("classes"))


def label_distribution(df: DataFrame, columns: Sequence[str] = ("y", "prediction")) -> DataFrame:
    """How often each value occurs per column, as ``kind, value, n``."""
    return df.select(*[F.col(c).cast("int").alias(c) for c in columns]).unpivot(
        [], list(columns), "kind", "value"
    ).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


def feature_variance(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Population variance per feature and whether it may stay (not constant)."""
    row = df.agg(*[F.var_pop(f).alias(f) for f in features])
    return row.unpivot([], list(features), "feature", "variance").withColumn(
        "keep", F.coalesce(F.col("variance") > 0, F.lit(False)))


def anova_f(df: DataFrame, features: Sequence[str], y: str = "y") -> DataFrame:
    """One-way ANOVA F per feature, from per-class moments (one small row per class)."""
    per_class = df.groupBy(y).agg(
        F.count(F.lit(1)).alias("n"),
        *[e for f in features for e in (F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}"))],
    )
    rows = per_class.select("n", F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"m_{f}").alias("m"), F.col(f"v_{f}").alias("v"))
        for f in features
    ])))
    n, m, v = F.col("n"), F.col("m"), F.col("v")
    sums = rows.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum(n).alias("total"), F.sum(n * v).alias("within"),
        # Between-class sum of squares: n times the weighted variance of class means.
        F.sum(n * m).alias("_nm"), F.collect_list(F.struct(n.alias("n"), m.alias("m"))).alias("_cells"),
    )
    grand = F.col("_nm") / F.col("total")
    between = F.aggregate(
        "_cells", F.lit(0.0), lambda acc, c: acc + c["n"] * (c["m"] - grand) * (c["m"] - grand))
    return sums.select(
        "feature",
        F.try_divide(between / (F.col("k") - 1), F.col("within") / (F.col("total") - F.col("k"))).alias("f_score"),
    )


def top_features(df: DataFrame, features: Sequence[str], k: int, y: str = "y") -> DataFrame:
    """The ``k`` features with the largest F among those that are not constant."""
    usable = feature_variance(df, features).where("keep").select("feature")
    return anova_f(df, features, y).join(usable, "feature", "left_semi").orderBy(
        F.desc_nulls_last("f_score"), "feature").limit(k)
