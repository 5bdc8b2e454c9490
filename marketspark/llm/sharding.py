"""Shards of bounded size by extendible hashing; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import groups_for, prepare, stage

#: Bits of the key hash, and how many of them one pass over the oversized buckets looks ahead.
BITS, STEP = 60, 12
#: Rows of one key placed in one task when a key alone exceeds a shard.
PAGE_ROWS = 100_000


def key_hash(*columns: str) -> Column:
    """The first 60 bits of the MD5 of the key's text."""
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _prefix(hashed: Column, depth) -> Column:
    """The first ``depth`` bits."""
    if isinstance(depth, int):
        return F.shiftright(hashed, BITS - depth)
    return F.call_function("shiftright", hashed, (F.lit(BITS) - depth).cast("int"))


def directory(sized: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, single): the buckets after splitting, from (h, bytes).

    All rows start in one bucket. A bucket over the limit splits on its next bit; one that fits, or holds a single hash,
    is final. Sizes are summed once for ``STEP`` bits at a time and only for rows of buckets still too large, so a pass
    shuffles a few thousand sums per bucket and task, and hashes spread evenly whatever the keys.
    """
    leaves, depth, rows = None, 0, sized
    while True:
        # Sums of the cells STEP bits on; shorter prefixes follow from these.
        cells = stage(rows.groupBy(_prefix(F.col("h"), depth + STEP).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.min("h").alias("lo"), F.max("h").alias("hi")), "cells")
        levels = cells.select("*", F.explode(F.sequence(F.lit(depth), F.lit(depth + STEP))).alias("depth"))
        sums = levels.groupBy("depth", F.call_function(
            "shiftright", F.col("cell"), F.lit(depth + STEP) - F.col("depth")).alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        sums = stage(sums.withColumn("fits", (F.col("bytes") <= limit) | (F.col("lo") == F.col("hi"))), "buckets")
        split = sums.where("NOT fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        final = sums.where("fits").withColumn("parent", F.shiftright("prefix", 1))
        under = final.join(split, ["depth", "parent"], "left_semi")
        if depth == 0:
            under = under.unionByName(final.where("depth = 0"))
        under = under.select("depth", "prefix", "bytes", (F.col("lo") == F.col("hi")).alias("single"))
        leaves = under if leaves is None else leaves.unionByName(under)
        depth += STEP
        large = sums.where(f"NOT fits AND depth = {depth}").select(F.col("prefix").alias("cell"))
        if depth >= BITS or large.isEmpty():
            return leaves
        rows = rows.join(large, _prefix(rows["h"], depth) == large["cell"], "left_semi")


def assign(docs: DataFrame, limit: int, key: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, shard (bits of its prefix), local_depth, page and shard_bytes.

    Rows of equal key share a hash, so no bit can part them: a key larger than the limit is laid out over pages, each within
    the limit, and a single text over it is alone on its page. shard_bytes counts all pages. NULL keys count as empty text,
    NULL texts as no bytes. Repeated rows stay repeated; an empty table gives no rows. Columns of ``docs`` named like one
    of the new ones are replaced.
    """
    prepare(docs.sparkSession)
    new = ["n_bytes", "shard", "local_depth", "page", "shard_bytes"]
    keep = [c for c in docs.columns if c not in new]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key_hash(*key).alias("h"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"))
    leaves = stage(directory(rows.select("h", "bytes"), limit), "directory")
    shallow = leaves.agg(F.min("depth")).first()[0] or 0
    # A row finds its bucket by the bits that all buckets have and the range of hashes.
    width = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(BITS) - F.col("depth")).cast("int"))
    table = leaves.select(
        "depth", F.col("bytes").alias("shard_bytes"), "single",
        F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), "0")).alias("shard"),
        (F.col("prefix") * width).alias("from"), (F.col("prefix") * width + width).alias("to")).withColumn(
        "slot", _prefix(F.col("from"), shallow))
    found = rows.withColumn("slot", _prefix(F.col("h"), shallow)).join(table, "slot").where("h >= from AND h < to")
    over = F.col("single") & (F.col("shard_bytes") > limit)
    simple = found.where(~over).withColumn("page", F.lit(0).cast("long"))
    simple = simple.select("doc", "bytes", "shard", "depth", "page", "shard_bytes")
    result = simple
    if not leaves.where(f"single AND bytes > {limit}").isEmpty():
        result = simple.unionByName(_pages(found.where(over), limit))
    out = [F.col(f"doc.`{c}`").alias(c) for c in keep]
    return result.select(*out, F.col("bytes").alias("n_bytes"), "shard", F.col("depth").alias("local_depth"), "page",
                         "shard_bytes")


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Pages within keys over the limit. Rows are dealt to blocks; each row's place is the bytes before its block and the
    bytes before it in the block, and a page takes the rows that start within its share of the places."""
    held = stage(rows.withColumn("row", F.monotonically_increasing_id()), "oversized")
    n = held.count()
    held = held.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(groups_for(n, PAGE_ROWS))))
    fits = F.col("bytes") <= limit
    blocks = held.where(fits).groupBy("h", "block").agg(F.sum("bytes").alias("own"), F.max("bytes").alias("longest"))
    blocks = blocks.select(
        "h", "block", F.expr("sum(own) OVER (PARTITION BY h ORDER BY block) - own").alias("before"),
        F.expr("max(longest) OVER (PARTITION BY h)").alias("longest"))
    placed = held.where(fits).withColumn(
        "inside", F.expr("sum(bytes) OVER (PARTITION BY h, block ORDER BY row) - bytes")).join(blocks, ["h", "block"])
    # Starts within a share of (limit + 1 - longest) bytes, so a page never exceeds the limit.
    share = F.lit(limit + 1) - F.col("longest")
    placed = placed.withColumn("page", F.floor((F.col("before") + F.col("inside")) / share).cast("long"))
    alone = held.where(~fits).withColumn("page", (-F.col("row") - 1).cast("long"))
    names = ["doc", "bytes", "shard", "depth", "page", "shard_bytes"]
    return placed.select(*names).unionByName(alone.select(*names))


def oracle(limit: int) -> str:
    """The same for the documents table in DuckDB, by summing every prefix of every length."""
    return f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
             CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT depth, h >> ({BITS} - depth) AS prefix, sum(n_bytes) AS bytes, min(h) = max(h) AS single
      FROM d, (SELECT unnest(range(0, {BITS + 1})) AS depth) GROUP BY ALL),
leaf AS (SELECT c.* FROM s c LEFT JOIN s p ON p.depth = c.depth - 1 AND p.prefix = c.prefix >> 1
         WHERE (c.bytes <= {limit} OR c.single) AND (c.depth = 0 OR NOT (p.bytes <= {limit} OR p.single)))
SELECT doc_id, n_bytes, substr(lpad(bin(h), {BITS}, '0'), 1, depth) AS shard, depth AS local_depth,
       CASE WHEN bytes > {limit} THEN NULL ELSE 0 END AS page, CAST(bytes AS BIGINT) AS shard_bytes
FROM d JOIN leaf ON h >> ({BITS} - depth) = prefix"""
