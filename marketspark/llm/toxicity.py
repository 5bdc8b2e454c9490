"""Toxicity scores from confirmed toxic texts and unlabelled ones: non-negative positive-unlabelled learning.

Texts without a toxic label are not taken for clean. With the class prior pi, the share of toxic texts, the risk of a classifier is
pi R(toxic seen as toxic) + max(0, R(unlabelled seen as clean) - pi R(toxic seen as clean)); when the estimate in the maximum turns
negative, the classifier has begun to fit the toxic texts among the unlabelled ones, and the step goes back instead.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import prepare, text_or_empty

#: Classifiers, and the expected number of toxic and of unlabelled texts each learns from: the bounded sample.
MEMBERS, POSITIVES, UNLABELLED = 4, 1000, 3000
#: Features of a classifier: those most over-represented in toxic texts, and the least log-likelihood ratio of a feature: chance
#: alone gives that to about one in 100,000.
FEATURES, SCORE = 4096, 20.0
#: Letters of the word beginnings that are features beside whole words.
BEGINNINGS = range(3, 7)
#: Steps over the whole sample (in small batches the estimated risk of clean texts is negative by chance), their length, decay.
STEPS, RATE, DECAY = 300, 0.1, 3e-4
_WORD = re.compile(r"\w+")
#: Words whose features a worker remembers.
_REMEMBER = 1 << 18


def words_of(text: str) -> Counter[str]:
    return Counter(_WORD.findall(text.lower()))


def features_of(word: str) -> list[int]:
    """Hashes of a word and of its beginnings."""
    digest = xxhash.xxh64_intdigest
    return [digest(word), *(digest(word[:k] + "\n") for k in BEGINNINGS if len(word) >= k)]


def text_features(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted feature hashes of a text, how often it holds each, and its number of words."""
    count: Counter[int] = Counter()
    words = words_of(text)
    for word, n in words.items():
        for f in features_of(word):
            count[f] += n
    hashes = sorted(count)
    return np.array(hashes, np.uint64), np.array([count[f] for f in hashes], np.int64), words.total()


def strength(count: np.ndarray | int) -> np.ndarray | float:
    """What a feature counts for: a word by chance in a long text is little, the same word again more."""
    return np.log2(1.0 + count)


def extent(words: int) -> float:
    return float(np.log2(1 + words)) / 4


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


class Classifier:
    """Log odds of toxicity: a bias, a weight for the length and one for every feature that a text holds."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, length: float, bias: float):
        self.hashes, self.weights, self.length, self.bias = hashes, weights, length, bias

    @staticmethod
    def select(features: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
        """Hashes found in more of the toxic texts than the unlabelled ones lead to expect."""
        flat = np.concatenate(features)
        line = np.repeat(np.arange(len(features)), [len(f) for f in features])
        found, at = np.unique(flat, return_inverse=True)
        inside = np.bincount(at[toxic[line]], minlength=len(found))
        outside = np.bincount(at[~toxic[line]], minlength=len(found))
        expected = (inside + outside) * toxic.sum() / len(toxic)
        ratio = 2 * (inside * np.log(np.maximum(inside, 1) / expected) - inside + expected)
        good = np.flatnonzero((inside > expected) & (ratio >= SCORE))
        best = good[np.lexsort((found[good], -ratio[good]))][:FEATURES]
        return np.sort(found[best])

    @classmethod
    def learn(cls, texts: list[tuple[np.ndarray, np.ndarray, int]], toxic: np.ndarray, prior: float) -> Classifier:
        """Full-batch non-negative PU learning of a logistic model; ``texts`` are as from ``text_features``."""
        hashes = cls.select([t[0] for t in texts], toxic)
        lines, places, values = [], [], []
        for i, (own, count, words) in enumerate(texts):
            at = np.minimum(np.searchsorted(hashes, own), max(len(hashes) - 1, 0))
            here = hashes[at] == own if len(hashes) else np.zeros(len(own), bool)
            places += [at[here], [len(hashes), len(hashes) + 1]]
            values += [strength(count[here]), [extent(words), 1.0]]
            lines.append(np.full(here.sum() + 2, i))
        line, place, value = np.concatenate(lines), np.concatenate(places).astype(np.int64), np.concatenate(values)
        width = len(hashes) + 2

        class Rows:
            """The sparse rows of the texts of one kind."""

            def __init__(self, mine: np.ndarray):
                inside = mine[line]
                self.n = int(mine.sum())
                self.line, self.place, self.value = (np.cumsum(mine) - 1)[line[inside]], place[inside], value[inside]

            def odds(self, weights: np.ndarray) -> np.ndarray:
                return np.bincount(self.line, self.value * weights[self.place], self.n)

            def mean(self, amount: np.ndarray) -> np.ndarray:
                return np.bincount(self.place, self.value * amount[self.line], width) / self.n

        held, free = Rows(toxic), Rows(~toxic)
        weights = np.zeros(width)
        weights[-1] = np.log(prior / (1 - prior))
        first, second = np.zeros_like(weights), np.zeros_like(weights)
        for step in range(1, STEPS + 1):
            held_odds, free_odds = held.odds(weights), free.odds(weights)
            up, uu = sigmoid(held_odds), sigmoid(free_odds)
            # Logistic loss: log(1 + e^-x) for toxic, log(1 + e^x) for clean.
            loss = np.logaddexp(0, free_odds).mean() - prior * np.logaddexp(0, held_odds).mean()
            clean = free.mean(uu) - prior * held.mean(up)
            slope = clean - prior * held.mean(1 - up) if loss >= 0 else -clean
            slope = slope + DECAY * np.r_[weights[:-1], 0]
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope * slope
            rate = RATE * 0.5 * (1 + np.cos(np.pi * step / STEPS))
            weights -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        return cls(hashes, weights[:-2], float(weights[-2]), float(weights[-1]))


class Ensemble:
    """The mean log odds of several classifiers; equal features are held once."""

    def __init__(self, members: list[Classifier], prior: float):
        n = max(1, len(members))
        hashes = np.concatenate([np.zeros(0, np.uint64), *(m.hashes for m in members)])
        weights = np.concatenate([np.zeros(0), *(m.weights for m in members)])
        found, at = np.unique(hashes, return_inverse=True)
        self.weight = dict(zip(found.tolist(), (np.bincount(at, weights=weights, minlength=len(found)) / n).tolist(), strict=True))
        self.length = sum(m.length for m in members) / n
        self.bias = sum(m.bias for m in members) / n if members else (float("-inf") if prior == 0 else np.log(prior / (1 - prior)))
        self.known: dict[str, tuple[int, ...]] = {}

    def log_odds(self, text: str) -> float:
        known, weight, held = self.known, self.weight, Counter()
        words = words_of(text)
        for word, n in words.items():
            mine = known.get(word)
            if mine is None:
                if len(known) >= _REMEMBER:
                    known.clear()
                mine = known[word] = tuple(f for f in features_of(word) if f in weight)
            for f in mine:
                held[f] += n
        return self.bias + self.length * extent(words.total()) + sum(weight[f] * float(strength(held[f])) for f in sorted(held))


def _held_out(column: Column) -> Column:
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _members(key: Column, share: float) -> Column:
    """The classifiers that learn from a row: each takes ``share`` of the circle of hashes, starting at its own place."""
    place = F.pmod(key, F.lit(1 << 30)) / float(1 << 30)
    takes = [F.when(F.pmod(place + m / MEMBERS, F.lit(1.0)) < share, F.lit(m)) for m in range(MEMBERS)]
    return F.array_compact(F.array(*takes))


def _sample(docs: DataFrame, labels: DataFrame, toxic: int) -> DataFrame:
    """(member, key, toxic, text): the texts that the classifiers learn from, each text once for each."""
    key = F.xxhash64("id", "text")
    shares = min(1.0, POSITIVES / toxic)
    marked = labels.where("toxic = 1").select("id", _members(F.xxhash64("id"), shares).alias("member")).where("size(member) > 0")
    marked = F.broadcast(marked)  # at most about MEMBERS x POSITIVES ids, whatever the size of the tables
    both = docs.join(marked, "id")
    thin = min(1.0, MEMBERS * POSITIVES / max(1, both.select("id").count()))  # below 1 only if ids repeat with many texts
    seen = both.where(F.pmod(F.xxhash64("text", "id"), F.lit(1 << 30)) < thin * (1 << 30)).select(
        F.explode("member").alias("member"), key.alias("key"), F.lit(True).alias("toxic"), "text")
    share = min(1.0, UNLABELLED / max(1, docs.select("id").count()))
    free = docs.select(F.explode(_members(key, share)).alias("member"), key.alias("key"), F.lit(False).alias("toxic"), "text")
    return seen.union(free).groupBy("member", "key", "toxic").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, prior: float) -> list[Classifier]:
    """One classifier for each member, each learned in a task of its own from its bounded sample."""

    def hashed(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            found = [text_features(t) for t in chunk["text"]]
            yield chunk[["member", "key", "toxic"]].assign(
                features=[f[0].tobytes() for f in found], counts=[f[1].astype(np.uint32).tobytes() for f in found], words=[f[2] for f in found])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["toxic", "key"])
        toxic = rows["toxic"].to_numpy(bool)
        if not toxic.any() or toxic.all():
            return pd.DataFrame(columns=["member", "hashes", "weights", "length", "bias"])
        made = Classifier.learn([(np.frombuffer(f, np.uint64), np.frombuffer(c, np.uint32), w) for f, c, w in zip(
            rows["features"], rows["counts"], rows["words"], strict=True)], toxic, prior)
        return pd.DataFrame({"member": rows["member"].iloc[:1], "hashes": [made.hashes.tobytes()],
                             "weights": [made.weights.tobytes()], "length": [made.length], "bias": [made.bias]})

    toxic = labels.where("toxic = 1").count()
    sets = _sample(docs, labels, toxic).mapInPandas(
        hashed, "member int, key long, toxic boolean, features binary, counts binary, words long")
    found = sets.groupBy("member").applyInPandas(
        fit, "member int, hashes binary, weights binary, length double, bias double").collect()
    return [Classifier(np.frombuffer(r["hashes"], np.uint64), np.frombuffer(r["weights"], np.float64), r["length"], r["bias"])
            for r in sorted(found, key=lambda r: r["member"])]


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             prior: float | None = None) -> DataFrame:
    """(id_col, held_out, score, predicted) for every document: the probability that its whole text is toxic.

    Labels count only from rows whose crc32(id as text) leaves a remainder by 5 (NULL id: as empty text, which leaves none); of
    several labels of an id the highest counts, NULL labels are ignored. The classifiers learn from about ``POSITIVES`` toxic and
    ``UNLABELLED`` other texts each, drawn by hash. ``prior`` is the share of toxic texts, by default that among the labelled
    ones. NULL text counts as empty and gets the score of a text without a known word. Without a toxic label all scores are
    ``prior`` or 0. Repeated rows are scored each. An empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("toxic").isNotNull() & ~_held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    labelled, toxic = marked.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("int"))).first()
    share = prior if prior is not None else (toxic or 0) / max(1, labelled)
    members = train(slim.where(~_held_out(F.col("id"))), marked, min(max(share, 1e-6), 0.99)) if toxic else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ensemble(members, share)
        for batch in batches:
            odds = np.array([model.log_odds(t) for t in batch["text"].to_pylist()], np.float64)
            score = sigmoid(odds)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                             names=["id", "held_out", "score", "predicted"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.select("id", _held_out(F.col("id")).alias("held_out"), "text").mapInArrow(
        run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
