"""Near copies by word shingles: SimHash fingerprints and min-hash bands find candidates, the exact Jaccard similarity decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.llm.common import groups_for, prepare, stage, text_or_empty
from marketspark.llm.components import components
from marketspark.llm.simhash import links, majority

#: Bands of so many min-hashes each. Two texts of similarity s meet in no band with probability (1 - s ** WIDTH) ** BANDS:
#: 1e-6 at 0.8, 7e-12 at 0.85.
BANDS, WIDTH = 45, 6
#: Bits in which the fingerprints of candidates differ at most.
DISTANCE = 4
#: Min-hashes of a pair may agree in so much less than the least similarity before it is compared exactly (six deviations).
SLACK = 0.15
#: Texts compared all with all in one task; larger groups are cut into chunks, and each pair of chunks is a task.
GROUP = 1024

_RANDOM = np.random.default_rng(42)
_FLIP = _RANDOM.integers(0, 1 << 32, BANDS * WIDTH, dtype=np.uint32)[:, None]
_TIMES = (_RANDOM.integers(0, 1 << 32, BANDS * WIDTH, dtype=np.uint32) | np.uint32(1))[:, None]


def shingles(text: str, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``size`` words; fewer words are one run, none give none. Words as in ``simhash``."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(min(size, len(words)))), strict=False))
    return np.unique(np.array([xxhash.xxh64_intdigest(g) for g in grams], dtype=np.uint64))


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """BANDS * WIDTH min-hashes of a set that is not empty."""
    low, out = hashes.astype(np.uint32), np.full(BANDS * WIDTH, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(low), 1024):  # stays in the cache
        np.minimum(out, ((low[i:i + 1024] ^ _FLIP) * _TIMES).min(axis=1), out=out)
    return out


def _prints(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, t, node, fp, keys): hash of the text and of its set of shingles, the set's SimHash and its bands; one row per input row."""
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("t"), text_or_empty(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            nodes, prints, keys = [], [], []
            for text in part["text"]:
                found = shingles(text, size)
                nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
                prints.append(majority(found))
                rows = min_hashes(found).reshape(BANDS, WIDTH) if len(found) else []
                keys.append(np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], dtype=np.uint64).view(np.int64))
            node, fp = (np.array(x, dtype=np.uint64).view(np.int64) for x in (nodes, prints))
            yield pd.DataFrame({"id": part["id"], "t": part["t"], "node": node, "fp": fp, "keys": keys})

    return slim.mapInPandas(run, f"id {kind}, t long, node long, fp long, keys array<long>")


def _joined(texts: list[str], size: int, least: float) -> list[tuple[int, int]]:
    """Edges that join all texts linked by a Jaccard similarity of ``least``; at most one edge a text."""
    sets = [shingles(t, size) for t in texts]
    sketch = np.array([min_hashes(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    label, edges = np.arange(len(sets)), []
    for i in range(1, len(sets)):
        fits = np.minimum(sizes[:i], sizes[i]) >= least * np.maximum(sizes[:i], sizes[i])
        alike = (sketch[:i] == sketch[i]).mean(axis=1)
        open_ = np.flatnonzero(fits & (alike >= least - SLACK))
        open_ = open_[np.argsort(-alike[open_], kind="stable")]
        while len(open_):
            j, open_ = open_[0], open_[1:]
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= least * (sizes[i] + sizes[j] - both):
                edges.append((i, int(j)))
                label[label == label[j]] = label[i]
                open_ = open_[label[open_] != label[i]]
    return edges


def _stars(nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, node, low) of every distinct pair of key and node; ``low`` is the key's smallest node."""
    order = np.lexsort((nodes, keys))
    key, node = keys[order], nodes[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])][:len(key)]
    key, node = key[new], node[new]
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    return key, node, np.repeat(node[heads], np.diff(np.r_[heads, len(key)]))


def _banded(prints: DataFrame) -> DataFrame:
    """(node, low): edges that join all nodes of a band.

    A batch of rows links its nodes of a band to the smallest of them, and only that one is shuffled under the band's key, once.
    So a band that very many texts share is no more than one row a batch.
    """
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part[part["keys"].str.len() > 0]
            if len(part):
                sizes = part["keys"].str.len().to_numpy()
                key, node, low = _stars(np.repeat(part["node"].to_numpy(), sizes), np.concatenate(part["keys"].to_list()))
                yield pd.DataFrame({"key": key, "node": node, "low": low})

    found = prints.select("node", "keys").mapInPandas(run, "key long, node long, low long")
    inside = found.where("node <> low").select("node", "low")
    heads = found.where("node = low").select("key", "node")
    across = heads.withColumn("low", F.min("node").over(W.partitionBy("key"))).where("node <> low").select("node", "low")
    return inside.union(across)


def _near_prints(nodes: DataFrame) -> DataFrame:
    """(node, low): edges that join all ``nodes`` (node, fp) whose fingerprints differ in ``DISTANCE`` bits or fewer."""
    heads = stage(nodes.groupBy("fp").agg(F.min("node").alias("low")), "prints")
    equal = nodes.join(heads, "fp").where("node <> low").select("node", "low")
    close = links(heads.select("fp"), DISTANCE).join(heads.select(F.col("fp").alias("u"), F.col("low").alias("node")), "u").join(
        heads.select(F.col("fp").alias("v"), "low"), "v").select("node", "low")
    return equal.union(close)


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(id_col, component_id): one row per input row with the smallest id of its group, groups being linked by pairs of ``least``
    Jaccard similarity or more on ``shingle`` words.

    Texts of equal shingle sets are one node. Nodes whose SimHash differs in ``DISTANCE`` bits or fewer are linked as ``simhash``
    does it; at a similarity of 0.8 fingerprints differ in some ten bits, so the nodes of a min-hash band are linked to its smallest
    as well, which joins every candidate pair by as many edges as there are nodes. Within these coarse groups all pairs not yet
    joined are compared exactly; only texts of candidates are shuffled. NULL ids are
    chosen only by groups that have no other; repeated rows stay repeated.
    """
    prepare(docs.sparkSession)
    prints = stage(_prints(docs, id_col, text_col, shingle), "prints")
    first = stage(prints.groupBy("node").agg(
        F.min("t").alias("t"), F.first("fp").alias("fp"), F.max(F.size("keys")).alias("bands")), "nodes")
    banded = _banded(prints)
    near = _near_prints(first.where("bands > 0"))
    coarse = components(stage(banded.union(near).distinct(), "coarse"), "node", "low")
    coarse = stage(first.select("node", "t").join(coarse, "node"), "candidates")
    groups = coarse.groupBy("component").count()
    hot = groups.where(F.col("count") > GROUP).select("component", F.ceil(2 * F.col("count") / GROUP).cast("int").alias("chunks"))
    cells = groups_for(coarse.count(), GROUP)
    spread = coarse.join(hot, "component", "left").withColumn("chunk", F.when(
        F.col("chunks").isNotNull(), F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")))
    plain = spread.where("chunks IS NULL").select("t", "node", "component", F.pmod(F.xxhash64("component"), F.lit(cells)).alias("cell"))
    cut = spread.where("chunks IS NOT NULL").select(
        "t", "node", "component", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "t", "node", "component", F.xxhash64("component", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("cell"))
    # One number per candidate: this list goes to the texts, not the texts to it.
    asked = F.broadcast(coarse.select("t").distinct())
    texts = docs.select(F.xxhash64(text_or_empty(text_col)).alias("t"), text_or_empty(text_col).alias("text")).join(
        asked, "t", "left_semi").dropDuplicates(["t"])

    def run(part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, group in part.groupby("component"):
            nodes = group["node"].tolist()
            found += [(nodes[i], nodes[j]) for i, j in _joined(group["text"].tolist(), shingle, least)]
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    edges = plain.union(cut).join(texts, "t").groupBy("cell").applyInPandas(run, "u long, v long")
    labels = components(stage(edges.distinct(), "links")).withColumnRenamed("component", "label")
    named = stage(prints.select("id", "node").join(labels, "node", "left").select("id", F.coalesce("label", "node").alias("label")), "labelled")
    lowest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    return named.join(lowest, "label").select(F.col("id").alias(id_col), "component_id")
