"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import groups_for, prepare, stage, text_or_empty
from marketspark.llm.components import components

BITS = 64
#: Fingerprints compared all with all in one task; larger buckets are cut into chunks and compared chunk by chunk.
BUCKET = 8192
#: Rows of keyed fingerprints gathered in one task.
CELL = 40_000


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """The SimHash of one text, unsigned; zero without words.

    Only A-Z are lower-cased and only ASCII white space separates words, which is what ``bytes`` does.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(g, seed) for g in grams], dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the 64-bit ``hashes``."""
    hashes = hashes.astype("<u8", copy=False)
    count, step = np.zeros(BITS, dtype=np.int64), 65536
    for i in range(0, len(hashes), step):  # bounds the memory of very long texts
        part = hashes[i:i + step]
        count += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 seed: int = 42) -> DataFrame:
    """(id, fp): one row per input row, the fingerprint as a signed long. NULL text counts as empty."""
    slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in part["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"id": part["id"], "fp": fp})

    return slim.mapInPandas(run, f"id {kind}, fp long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of ``blocks - distance`` whole blocks each: ``distance`` differing bits leave one of them untouched."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    single = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(some) for some in combinations(single, blocks - distance)]


def blocks_for(n: int, distance: int) -> int:
    """The fewest blocks whose keys leave about 256 of ``n`` fingerprints in a bucket. Any number is exact."""
    blocks = distance + 1
    while blocks < 2 * distance + 4 and n / 2 ** (BITS * (blocks - distance) / blocks) > 256:
        blocks += 1
    return blocks


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the groups of ``a[i]`` and ``b[i]``; a group's label is its smallest row."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        label = parent[label]
    return label


def _forest(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all rows of equal ``key`` linked by Hamming distance; at most one edge a row."""
    order = np.argsort(key, kind="stable")
    key, fp = key[order], fp[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    end = np.repeat(starts + sizes, sizes)
    label, at, step = np.arange(len(key)), np.arange(len(key)), 1
    while True:
        at = at[at + step < end[at]]
        if not len(at):
            break
        near = np.bitwise_count(fp[at] ^ fp[at + step]) <= distance
        label = _merge(label, at[near], at[near] + step)
        step += 1
    child = np.flatnonzero(label != np.arange(len(key)))
    return fp[child], fp[label[child]]


def links(fps: DataFrame, distance: int = 4, blocks: int | None = None) -> DataFrame:
    """(u, v): edges whose components are those of all pairs of ``fps.fp`` at ``distance`` or fewer bits.

    Every fingerprint gets one key per mask; close pairs share a key. A task holds whole buckets and
    keeps a spanning forest, never all pairs. Buckets over ``BUCKET`` are cut into chunks, and each pair of
    chunks is a task of its own, so the work of a hot bucket spreads and no pair is missed.
    """
    n = fps.count()
    masks = block_masks(blocks or blocks_for(n, distance), distance)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("k"))
        for i, m in enumerate(signed)])).alias("x")).select("fp", "x.c", "x.k")
    hot = keyed.groupBy("c", "k").count().where(F.col("count") > BUCKET).select(
        "c", "k", F.ceil(2 * F.col("count") / BUCKET).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    cells = groups_for(n * len(masks), CELL)
    spread = keyed.join(hot, ["c", "k"], "left").withColumn("chunk", F.when(F.col("chunks").isNotNull(), chunk))
    plain = spread.where("chunks IS NULL").select(
        "fp", F.xxhash64("c", "k").alias("key"), F.pmod(F.xxhash64("c", "k"), F.lit(cells)).alias("cell"))
    cut = spread.where("chunks IS NOT NULL").select(
        "fp", "c", "k", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "fp", F.xxhash64("c", "k").alias("key"),
        F.xxhash64("c", "k", F.least("chunk", "other"), F.greatest("chunk", "other"), F.lit("cut")).alias("cell"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        u, v = _forest(part["key"].to_numpy(), part["fp"].to_numpy().view(np.uint64), distance)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return plain.union(cut).groupBy("cell").applyInPandas(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    distance: int = 4, seed: int = 42, blocks: int | None = None) -> DataFrame:
    """(id_col, fp, component_id): one row per input row with the smallest id its group reaches.

    Exact copies collapse to one fingerprint before any comparison, so a group of any number of copies is
    one node. Empty tables give no rows. Texts without words share fingerprint zero and link like others.
    Repeated rows stay repeated; a NULL id is never chosen as component unless its group has no other.
    Other columns are ignored, whatever their names.
    """
    prepare(docs.sparkSession)
    prints = stage(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    first = stage(prints.groupBy("fp").agg(F.min("id").alias("id")), "distinct")
    labels = components(links(first.select("fp"), distance, blocks))
    joined = first.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "id", F.coalesce("component", "fp").alias("label"))
    joined = stage(joined, "labelled")
    lowest = joined.groupBy("label").agg(F.min("id").alias("component_id"))
    by_print = joined.join(lowest, "label").select("fp", "component_id")
    return prints.join(by_print, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_fingerprint(column: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")
