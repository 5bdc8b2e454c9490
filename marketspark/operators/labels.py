"""Forward ordinal labels and class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.functions.scans import bounded, halo_blocks, row_index, short
from marketspark.operators.sessions import MONTHLY
from marketspark.schema import LABEL_CLASSES, LABEL_HORIZONS


def add_labels(
    df: DataFrame,
    horizons: Sequence[int] = LABEL_HORIZONS,
    partition_cols: Sequence[str] = MONTHLY,
    *,
    atr_col: str = "atr_14",
    atr_mult: float = 0.5,
) -> DataFrame:
    """``close_ahead_h`` and ``label_h`` in -2..2 by ATR-scaled move.

    Null where the future close or the ATR is missing.
    """
    if atr_col not in df.columns:
        raise ValueError(f"column {atr_col!r} not found; add indicators first")
    ahead = {h: f"close_ahead_{h}" for h in horizons}
    if bounded(partition_cols) or short(df):
        df = df if bounded(partition_cols) else row_index(df, partition_cols, "timestamp")
        w = W.partitionBy(*partition_cols).orderBy("timestamp")
        df = df.withColumns({name: F.lead("close", h).over(w) for h, name in ahead.items()})
    else:
        df = _look_ahead(df, ahead, partition_cols)
    near = F.col(atr_col) * atr_mult
    far = near * 2
    close = F.col("close")
    labels = {}
    for h in horizons:
        future = F.col(ahead[h])
        labels[f"label_{h}"] = (
            F.when(future.isNull() | F.col(atr_col).isNull(), F.lit(None))
            .when(future > close + far, 2)
            .when(future > close + near, 1)
            .when(future < close - far, -2)
            .when(future < close - near, -1)
            .otherwise(0)
            .cast("byte")
        )
    return df.withColumns(labels)


def _look_ahead(
    df: DataFrame, ahead: dict[int, str], keys: Sequence[str], block: int = 4096
) -> DataFrame:
    """Future closes of a whole series, cut into overlapping runs of rows."""
    indexed = row_index(df, keys, "timestamp")
    rows = halo_blocks(indexed, block, after=max(ahead))
    w = W.partitionBy(*keys, "blk").orderBy("idx")
    rows = rows.withColumns({name: F.lead("close", h).over(w) for h, name in ahead.items()})
    return rows.where("core").drop("blk", "core")


def class_balance(df: DataFrame, label_col: str) -> DataFrame:
    """Count and share (4 digits) of each class -2..2; zeros where absent."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(
        F.col(label_col).cast("int").alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))
    classes = df.sparkSession.createDataFrame([(c,) for c in LABEL_CLASSES], "label int")
    full = classes.join(counts, "label", "left").fillna(0, ["n"])
    # Five rows: the unpartitioned window is over class counts, not data.
    total = F.sum("n").over(W.partitionBy(F.lit(1)))
    return full.select(
        "label", "n", F.coalesce(F.round(F.try_divide("n", total), 4), F.lit(0.0)).alias("ratio")
    )
