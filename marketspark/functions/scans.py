"""Ordered scans that stay distributed when one key holds most of the rows.

A plain window over a whole series pulls that series into one task. The
helpers here cut a series into blocks (a calendar month, or a run of row
numbers), work inside a block with windows, and move what must cross a border
through a small per-block summary: one row per (key, block), joined back on
exactly the columns the block windows are partitioned by, so the large side is
not shuffled again for the join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.session import stage

UNBOUNDED = W.unboundedPreceding
# 1e-30: a weight below this cannot change a double.
_NEGLIGIBLE = 69.1
SCAN_BLOCK = 2048
#: Series of so many rows at most are windows of one task; longer ones are cut into blocks.
SHORT = 1 << 16
_LONGEST = "longest"


def bounded(partition_cols: Sequence[str]) -> bool:
    """True when groups are calendar months, hence small enough for one task."""
    return "month" in partition_cols


def measured(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``df``, which should be stored, with the length of its longest series in the metadata of ``column``.

    Frames derived from it keep the note as long as they keep the column. It only chooses between plans of the same result.
    """
    return noted(df, column, df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0)


def noted(df: DataFrame, column: str, most: int) -> DataFrame:
    """``df`` with the note that no series is longer than ``most``."""
    return df.withMetadata(column, {_LONGEST: most})


def longest(df: DataFrame) -> int | None:
    """The noted length of the longest series; None if nobody measured it."""
    return max((f.metadata[_LONGEST] for f in df.schema.fields if _LONGEST in f.metadata), default=None)


def short(df: DataFrame, limit: int | None = None) -> bool:
    """True when every series is known to have ``limit`` (``SHORT``) rows or fewer."""
    rows = longest(df)
    return rows is not None and rows <= (SHORT if limit is None else min(limit, SHORT))


def without_notes(df: DataFrame) -> DataFrame:
    for f in df.schema.fields:
        if _LONGEST in f.metadata:
            df = df.withMetadata(f.name, {k: v for k, v in f.metadata.items() if k != _LONGEST})
    return df


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` written in the order of ``keys`` and ``order``, with the columns ``_block`` and ``_at``.

    Spark samples the order and cuts it into ranges of like size, so a key with most of the rows is cut into as many blocks as
    its rows need. ``_block`` numbers the ranges, ``_at`` the rows inside one; equal (key, order) rows share a block. It is
    written because a second sampling could cut elsewhere.
    """
    columns = [*keys, *order]
    place = F.monotonically_increasing_id()  # the partition in the upper bits, the row's place in it in the lower 33
    return stage(df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("_place", place), "ordered").withColumns(
        {"_block": F.shiftright("_place", 33), "_at": F.col("_place").bitwiseAND((1 << 33) - 1)}).drop("_place")


def last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` at or before each row of its key, in blocks of the order."""
    rows = ordered(df, keys, order)
    inside = W.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(UNBOUNDED, 0)
    tails = rows.groupBy(*keys, "_block").agg(F.max(F.when(F.col(value).isNotNull(), F.struct("_at", value)))[value].alias("_tail"))
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(UNBOUNDED, -1)
    carried = tails.select(*keys, "_block", F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
    local = rows.withColumn("_seen", F.last(value, ignorenulls=True).over(inside))
    return local.join(carried, [*keys, "_block"], "left").withColumn(name, F.coalesce("_seen", "_carry")).drop(
        "_block", "_at", "_seen", "_carry")


def row_index(
    df: DataFrame, keys: Sequence[str], order: str, *, previous: dict[str, str] | None = None, most: int | None = None
) -> DataFrame:
    """Add ``idx`` (0-based position) and ``n`` (series length) per key.

    A row's position is its place inside its block of the order plus what the blocks before hold: one summary row per
    (key, block). Months are windows of their own, and so are series known to be short (``measured``, or ``most`` rows), which
    then lie together for all later windows of the key and its blocks. ``previous`` adds the previous row's values (``{new name: column}``, columns
    without nulls) in the same pass. A frame that has ``idx`` is not renumbered.
    """
    if "idx" in df.columns and "n" in df.columns and not previous:
        return df
    previous = previous or {}
    most = most if most is not None else longest(df)
    if bounded(keys) or (most is not None and most <= SHORT):
        whole = W.partitionBy(*keys).orderBy(order)
        numbered = df.drop("idx", "n").withColumns({
            "idx": F.row_number().over(whole).cast("long") - 1,
            "n": F.count(F.lit(1)).over(whole.rowsBetween(UNBOUNDED, W.unboundedFollowing)),
            **{name: F.lag(src).over(whole) for name, src in previous.items()}})
        return numbered if most is None else numbered.withMetadata("idx", {_LONGEST: most})
    rows = ordered(df.drop("idx", "n"), keys, [order])
    per_block = rows.groupBy(*keys, "_block").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"),
        *[F.max_by(src, "_at").alias(f"_tail_{name}") for name, src in previous.items()],
    )
    over_blocks = W.partitionBy(*keys).orderBy("_block")
    offsets = per_block.select(
        *keys,
        "_block",
        (F.sum("_size").over(over_blocks) - F.col("_size") - F.col("_first")).alias("_offset"),
        F.sum("_size").over(W.partitionBy(*keys)).alias("n"),
        *[F.lag(f"_tail_{name}").over(over_blocks).alias(f"_in_{name}") for name in previous],
    )
    if previous:
        inside = W.partitionBy(*keys, "_block").orderBy("_at")
        rows = rows.withColumns({f"_lag_{name}": F.lag(src).over(inside) for name, src in previous.items()})
    return (
        rows.join(offsets, [*keys, "_block"])
        .withColumns({
            "idx": F.col("_offset") + F.col("_at"),
            **{name: F.coalesce(F.col(f"_lag_{name}"), F.col(f"_in_{name}")) for name in previous},
        })
        .drop("_block", "_at", "_offset", *[f"_{t}_{name}" for name in previous for t in ("lag", "in")])
    )


def previous_row(
    df: DataFrame, keys: Sequence[str], block: str, order: str, columns: dict[str, str]
) -> DataFrame:
    """Add the previous row's values (``{new name: source column}``) across blocks.

    Source columns must not be null: a null result means "first row of the series".
    """
    over_blocks = W.partitionBy(*keys).orderBy(block)
    tail = df.groupBy(*keys, block).agg(
        *[F.max_by(src, order).alias(f"_tail_{name}") for name, src in columns.items()]
    )
    carried = tail.select(
        *keys,
        block,
        *[F.lag(f"_tail_{name}").over(over_blocks).alias(f"_in_{name}") for name in columns],
    )
    inside = W.partitionBy(*keys, block).orderBy(order)
    local = df.withColumns(
        {f"_lag_{name}": F.lag(src).over(inside) for name, src in columns.items()}
    )
    return (
        local.join(carried, [*keys, block])
        .withColumns({
            name: F.coalesce(F.col(f"_lag_{name}"), F.col(f"_in_{name}")) for name in columns
        })
        .drop(*[f"_lag_{n}" for n in columns], *[f"_in_{n}" for n in columns])
    )


def halo_blocks(
    df: DataFrame, size: int, before: int = 0, after: int = 0, idx: str = "idx"
) -> DataFrame:
    """Cut an indexed series into ``blk`` = runs of ``size`` rows with overlap.

    Each block also receives copies of the ``before`` rows ahead of it and the
    ``after`` rows behind it, so windows of that reach inside ``(key, blk)``
    see everything they need. ``core`` marks a row's own block; keep only core
    rows once the windows are done.
    """
    if before > size or after > size:
        raise ValueError("the overlap must not exceed the block size")
    home = F.floor(F.col(idx) / size)
    pos = F.col(idx) - home * size
    targets = [F.struct(home.alias("blk"), F.lit(True).alias("core"))]
    if before:
        targets.append(F.when(pos >= size - before,
                              F.struct((home + 1).alias("blk"), F.lit(False).alias("core"))))
    if after:
        targets.append(F.when((pos < after) & (home > 0),
                              F.struct((home - 1).alias("blk"), F.lit(False).alias("core"))))
    if len(targets) == 1:
        return df.withColumns({"blk": home, "core": F.lit(True)})
    copies = F.filter(F.array(*targets), lambda t: t.isNotNull())
    return df.select("*", F.inline(copies))


@dataclass(frozen=True)
class Ewm:
    """One exponentially weighted mean: seeded by the plain mean of the first
    ``period`` values from position ``start`` on, then y = y + alpha (x - y)."""

    name: str
    value: str
    period: int
    alpha: float
    start: int = 0

    @property
    def seed_at(self) -> int:
        return self.start + self.period - 1

    @property
    def decay(self) -> float:
        return 1.0 - self.alpha

    def __post_init__(self) -> None:
        if self.period < 2 or not 0.0 < self.alpha < 1.0:
            raise ValueError("period must be at least 2 and alpha between 0 and 1")

    @property
    def longest_block(self) -> int:
        """Longest block whose weights stay inside the range of a double."""
        return int(690 / -math.log(self.decay))

    def fits(self, block: int) -> bool:
        return self.seed_at < block <= self.longest_block

    def reach(self, block: int) -> int:
        """How many earlier blocks still carry weight into the current one."""
        return max(1, math.ceil(_NEGLIGIBLE / (-math.log(self.decay) * block)))


def ewm_scan(
    df: DataFrame,
    specs: Sequence[Ewm],
    partition_cols: Sequence[str],
    *,
    idx: str = "idx",
    block: int | None = None,
    across: str | None = None,
    order: str | None = None,
) -> DataFrame:
    """Add one column per spec; null before its seed position.

    The recursion is unrolled to a weighted running sum inside blocks of
    ``block`` rows (short enough that the weights neither overflow nor vanish)
    plus the end values of the few earlier blocks that still matter.
    ``across="window"`` fetches those with a range frame inside the partition
    (for month-sized groups), ``across="join"`` through a per-block summary so
    that every block is its own task. Series known to be no longer than a block
    have none before it: one window in the order of ``order`` (default ``idx``),
    which needs no sort of its own where the frame already lies in that order.
    """
    across = across or ("window" if bounded(partition_cols) else "join")
    if block is None:
        # Very short and very long periods need a block length of their own.
        block = SCAN_BLOCK
        for spec in [s for s in specs if not s.fits(block)]:
            own = min(spec.longest_block, max(block, spec.seed_at + 1))
            df = ewm_scan(df, [spec], partition_cols, idx=idx, block=own, across=across, order=order)
        specs = [s for s in specs if s.fits(block)]
        if not specs:
            return df
    for spec in specs:
        if not spec.fits(block):
            raise ValueError(
                f"block {block} does not suit {spec.name}: {spec.seed_at + 1} to {spec.longest_block}")
    position = F.col(idx)
    place = F.pmod(position, F.lit(block)).cast("double")

    def contribution(s: Ewm) -> Column:
        # Divided by the weight the end value gets back; the seed's rows (all in the first block) count as if they stood at its end.
        seed = F.coalesce(F.col(s.value) / s.period, F.lit(0.0)) * s.decay ** -s.seed_at
        return F.when(position < s.start, F.lit(0.0)).when(position <= s.seed_at, seed).otherwise(
            F.col(s.value) * s.alpha * F.pow(F.lit(s.decay), -place))

    if short(df, block):
        whole = W.partitionBy(*partition_cols).orderBy(order or idx).rowsBetween(UNBOUNDED, 0)
        return df.withColumns({
            s.name: F.when(position >= s.seed_at, F.sum(contribution(s)).over(whole) * F.pow(F.lit(s.decay), place))
            for s in specs
        })
    df = df.withColumns({"_blk": F.floor(position / block), "_j": place})
    inside = W.partitionBy(*partition_cols, "_blk").orderBy(idx).rowsBetween(UNBOUNDED, 0)
    df = df.withColumns({
        f"_loc_{s.name}": F.sum(contribution(s)).over(inside) * F.pow(F.lit(s.decay), F.col("_j"))
        for s in specs
    })
    at_end = F.col("_j") == block - 1
    if across == "window":
        by_block = W.partitionBy(*partition_cols).orderBy("_blk")
        carries = {}
        for s in specs:
            end = F.when(at_end, F.col(f"_loc_{s.name}"))
            terms = [
                F.coalesce(F.max(end).over(by_block.rangeBetween(-m, -m)), F.lit(0.0))
                * (s.decay ** (block * (m - 1)))
                for m in range(1, s.reach(block) + 1)
            ]
            carries[f"_carry_{s.name}"] = sum(terms[1:], terms[0])
        df = df.withColumns(carries)
    else:
        by_block = W.partitionBy(*partition_cols).orderBy("_blk")
        ends = df.where(at_end).select(
            *partition_cols, "_blk", *[f"_loc_{s.name}" for s in specs]
        )
        carries = []
        for s in specs:
            terms = [
                F.coalesce(F.lag(f"_loc_{s.name}", m).over(by_block), F.lit(0.0))
                * (s.decay ** (block * m))
                for m in range(s.reach(block))
            ]
            carries.append(sum(terms[1:], terms[0]).alias(f"_carry_{s.name}"))
        incoming = ends.select(*partition_cols, (F.col("_blk") + 1).alias("_blk"), *carries)
        df = df.join(incoming, [*partition_cols, "_blk"], "left").fillna(
            0.0, [f"_carry_{s.name}" for s in specs]
        )
    df = df.withColumns({
        s.name: F.when(
            position >= s.seed_at,
            F.col(f"_loc_{s.name}")
            + F.pow(F.lit(s.decay), F.col("_j") + 1) * F.col(f"_carry_{s.name}"),
        )
        for s in specs
    })
    helpers = [f"{p}{s.name}" for s in specs for p in ("_loc_", "_carry_")]
    return df.drop("_blk", "_j", *helpers)


def running_total(
    df: DataFrame, keys: Sequence[str], block: str, order: str, totals: dict[str, Column]
) -> DataFrame:
    """Inclusive running sums per key over all blocks."""
    per_block = df.groupBy(*keys, block).agg(
        *[F.sum(expr).alias(f"_sum_{name}") for name, expr in totals.items()]
    )
    before = W.partitionBy(*keys).orderBy(block).rowsBetween(UNBOUNDED, -1)
    offsets = per_block.select(
        *keys,
        block,
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_pre_{n}") for n in totals],
    )
    inside = W.partitionBy(*keys, block).orderBy(order).rowsBetween(UNBOUNDED, 0)
    local = df.withColumns({f"_run_{n}": F.sum(e).over(inside) for n, e in totals.items()})
    return (
        local.join(offsets, [*keys, block])
        .withColumns({n: F.col(f"_pre_{n}") + F.col(f"_run_{n}") for n in totals})
        .drop(*[f"_run_{n}" for n in totals], *[f"_pre_{n}" for n in totals])
    )
