"""Model training and evaluation on Spark.

Model families differ from single-machine libraries, so scores are not
comparable number by number; protocols (folds, test-then-train, selection by
macro F1) are the same.
"""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketspark.functions.scans import short
from marketspark.operators.folds import assign_folds, fold_part, usable_folds
from marketspark.operators.prep import NEUTRAL, sequence_windows
from marketspark.operators.scoring import class_scores, confusion_counts, macro_f1, top_features
from marketspark.session import scratch_path, stage

CLASSES = (0, 1, 2, 3, 4)
SERIES = ("symbol",)


# ------------------------------------------------------------ one-job models
def seasonal_naive_predictions(
    indexed: DataFrame, *, keys: Sequence[str] = SERIES, season: int = 24, n_splits: int = 5, y: str = "y",
) -> DataFrame:
    """Repeat the last season of each fold's training rows over its test rows.

    Every test row is predicted: a slot that the training rows do not reach gets
    their last value, and the neutral class without any training row.
    """
    rows = assign_folds(indexed.select(*keys, "idx", "n", y), "timeseries", n_splits=n_splits)
    slot = F.pmod(F.col("idx") - F.col("test_lo"), F.lit(season))
    tests = rows.where(F.col("role") == "test").withColumn("_slot", slot)
    # `season` rows per series and fold, packed to one.
    lasts = rows.where((F.col("role") == "train") & (F.col("idx") >= F.col("test_lo") - season)).groupBy(*keys, "fold").agg(
        F.map_from_entries(F.collect_list(F.struct(slot.alias("slot"), F.col(y).alias("y")))).alias("_of"),
        F.max_by(y, "idx").alias("_last"))
    past = F.coalesce(F.col("_of")[F.col("_slot")], "_last", F.lit(NEUTRAL))
    guess = F.least(F.greatest(F.bround(past), F.lit(0)), F.lit(4)).cast("int")
    return tests.join(lasts, [*keys, "fold"], "left").select(*keys, "fold", "idx", y, guess.alias("prediction"))


def mean_fold_f1(predictions: DataFrame, *, keys: Sequence[str] = SERIES, y: str = "y") -> DataFrame:
    """Macro F1 averaged over the folds of a series, how many those are and how many rows they scored."""
    by = (*keys, "fold")
    per_fold = class_scores(confusion_counts(predictions, y, "prediction", by), by).groupBy(*by).agg(
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"), F.sum(F.col("tp") + F.col("fn")).alias("scored"))
    return per_fold.groupBy(*keys).agg(
        F.avg("macro_f1").alias("cv_f1_macro"), F.count(F.lit(1)).alias("folds"), F.sum("scored").alias("scored"))


#: Batches whose moments are merged in one row.
SCAN = 256
_MOMENTS = "struct<n:double,m:array<double>,q:array<double>>"


def _merged(a: Column, b: Column) -> Column:
    """The moments of two sets of rows together, from count, means and squared deviations of each; associative."""
    n = a["n"] + b["n"]
    share = F.when(n > 0, b["n"] / n).otherwise(F.lit(0.0))
    gap = F.zip_with(a["m"], b["m"], lambda x, y: y - x)
    return F.struct(
        n.alias("n"),
        F.zip_with(a["m"], gap, lambda x, d: x + d * share).alias("m"),
        F.zip_with(F.zip_with(a["q"], b["q"], lambda x, y: x + y), gap, lambda q, d: q + d * d * a["n"] * share).alias("q"))


def _before(states: DataFrame, keys: Sequence[str], nothing: Column) -> DataFrame:
    """(keys, pos, before): for every position the class moments (``state``) of all earlier ones, merged.

    ``SCAN`` neighbours are merged in a row; their totals are merged the same way, level above level, and come back as what stands
    before each row's first position. So no row holds more than ``SCAN`` states however long the series is.
    """
    packed = stage(states.groupBy(*keys, F.floor(F.col("pos") / SCAN).alias("_up")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "state"))).alias("_held")), "moments")
    together = lambda a, b: F.zip_with(a, b, _merged)
    kind = f"array<struct<pos:bigint,before:array<{_MOMENTS}>>>"
    walk = lambda start, finish: F.aggregate(
        "_held", F.struct(start.alias("now"), F.array().cast(kind).alias("seen")),
        lambda acc, x: F.struct(
            together(acc["now"], x["state"]).alias("now"),
            F.concat(acc["seen"], F.array(F.struct(x["pos"].cast("long").alias("pos"), acc["now"].alias("before")))).alias("seen")),
        finish)
    if (packed.agg(F.max("_up")).first()[0] or 0) == 0:
        above = packed.withColumn("_start", nothing)
    else:
        totals = packed.select(*keys, F.col("_up").alias("pos"), walk(nothing, lambda acc: acc["now"]).alias("state"))
        above = packed.join(_before(totals, keys, nothing).select(
            *keys, F.col("pos").alias("_up"), F.col("before").alias("_start")), [*keys, "_up"])
    return above.select(*keys, F.inline(walk(F.col("_start"), lambda acc: acc["seen"])))


def prequential_bayes(
    indexed: DataFrame, features: Sequence[str], *, keys: Sequence[str] = SERIES, batch: int = 500,
    y: str = "y", smoothing: float = 1e-6,
) -> DataFrame:
    """Test-then-train Gaussian Bayes: each batch is scored with all batches before it.

    The model of a batch is the moments of all earlier batches: running ones over a series known to be short, otherwise merged in
    a prefix scan over one row per batch. Both keep means and squared deviations, never sums of squares, so a high price level costs
    no digits. Rows of the first batch have no
    model and are left out, like classes with fewer than two rows so far. Rows without a class or feature count for nothing.
    """
    rows = indexed.withColumn("batch", F.floor(F.col("idx") / batch))
    known = F.col(y).isNotNull()
    for f in features:
        known = known & F.col(f).isNotNull()
    width = range(len(features))

    def fixed(z: Column) -> Column:
        """What a class brings to every row of the batch. Negated class: on equal likelihood the smaller class wins the maximum."""
        var = [F.greatest(z["s"]["q"][i] / z["s"]["n"], F.lit(smoothing)) for i in width]
        return F.struct((-z["c"]).alias("neg"), F.array(*var).alias("v"), z["s"]["m"].alias("m"),
                        (F.ln(z["s"]["n"] / F.col("_seen")) - sum(F.ln(v) * 0.5 for v in var)).alias("base"))

    def models(moments: DataFrame, *columns: str) -> DataFrame:
        """``columns`` and ``_model``: what each class that can be used brings, from the moments ``before``; NULL without those."""
        classes = F.arrays_zip(F.array(*[F.lit(c) for c in CLASSES]).alias("c"), F.col("before").alias("s"))
        usable = moments.select(*columns, F.when(F.col("before").isNotNull(), F.filter(classes, lambda z: z["s"]["n"] > 1)).alias("_usable"))
        seen = F.aggregate("_usable", F.lit(0.0), lambda acc, z: acc + z["s"]["n"])
        return usable.withColumn("_seen", seen).select(*columns, F.transform("_usable", fixed).alias("_model"))

    if short(indexed):
        # A series is one window in the order in which it was numbered: its running moments are a model where a batch begins.
        order = "timestamp" if "timestamp" in indexed.columns else "idx"
        series = W.partitionBy(*keys).orderBy(order)
        past, running = series.rowsBetween(W.unboundedPreceding, -1), {}
        for c in CLASSES:
            mine = known & (F.col(y) == c)
            running[f"_n{c}"] = F.count(F.when(mine, 1)).over(past).cast("double")
            for i, f in enumerate(features):
                value = F.when(mine, F.col(f))
                running |= {f"_m{c}_{i}": F.avg(value).over(past), f"_v{c}_{i}": F.var_pop(value).over(past)}
        moments = F.array(*[F.struct(
            F.col(f"_n{c}").alias("n"), F.array(*[F.col(f"_m{c}_{i}") for i in width]).alias("m"),
            F.array(*[F.col(f"_v{c}_{i}") * F.col(f"_n{c}") for i in width]).alias("q")) for c in CLASSES])
        starts = rows.withColumns(running).withColumn("before", F.when(F.col("idx") % batch == 0, moments))
        columns = dict.fromkeys([*keys, order, "batch", "idx", y, *features])
        scored = models(starts, *columns).withColumn(
            "_model", F.last("_model", ignorenulls=True).over(series.rowsBetween(W.unboundedPreceding, 0)))
    else:
        per_class = rows.where(known).groupBy(*keys, "batch", F.col(y).alias("_c")).agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.array(*[F.avg(f) for f in features]).alias("m"),
            F.array(*[F.var_pop(f) * F.count(F.lit(1)) for f in features]).alias("q"))
        zeros = F.array(*[F.lit(0.0) for _ in features])
        none = F.struct(F.lit(0.0).alias("n"), zeros.alias("m"), zeros.alias("q"))
        nothing = F.array(*[none for _ in CLASSES])
        found = per_class.groupBy(*keys, "batch").agg(
            F.map_from_entries(F.collect_list(F.struct("_c", F.struct("n", "m", "q")))).alias("_of"))
        batches = rows.select(*keys, "batch").distinct().join(found, [*keys, "batch"], "left")
        states = batches.select(*keys, F.col("batch").alias("pos"), F.array(*[
            F.coalesce(F.col("_of")[F.lit(c)], none).cast(_MOMENTS) for c in CLASSES]).alias("state"))
        before = _before(states, keys, nothing.cast(f"array<{_MOMENTS}>")).withColumnRenamed("pos", "batch")
        scored = rows.join(models(before, *keys, "batch"), [*keys, "batch"])

    def loglik(z: Column) -> Column:
        gaps = [F.col(f) - z["m"][i] for i, f in enumerate(features)]
        return F.struct((z["base"] - sum(gap * gap / z["v"][i] * 0.5 for i, gap in enumerate(gaps))).alias("ll"), z["neg"].alias("neg"))

    best = F.array_max(F.transform("_model", loglik))
    return scored.where(F.size("_model") > 0).select(
        *keys, "batch", "idx", y, (-best["neg"]).cast("int").alias("prediction"))


# ------------------------------------------------------------ online softmax
class OnlineSoftmax:
    """Multinomial logistic model learned batch by batch; small enough to be stored as one row per series.

    Holds the count, mean and squared deviations of each feature and one weight
    row per class. ``score_and_learn`` predicts a batch with what was learned
    before it, then takes ``steps`` gradient steps on it.
    """

    def __init__(self, width: int, rate: float = 0.5, penalty: float = 1e-4, steps: int = 2):
        self.rate, self.penalty, self.steps, self.count = rate, penalty, steps, 0
        self.mean, self.m2 = np.zeros(width), np.zeros(width)
        self.weights = np.zeros((len(CLASSES), width + 1))

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        std = np.sqrt(self.m2 / max(self.count, 1))
        return np.c_[np.ones(len(x)), (x - self.mean) / np.where(std > 0, std, 1.0)]

    def _chances(self, inputs: np.ndarray) -> np.ndarray:
        logits = inputs @ self.weights.T
        raised = np.exp(logits - logits.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)

    def score_and_learn(self, x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
        """Classes predicted for the batch (None for the first one); equal chances give the smaller class."""
        guess = self._chances(self._inputs(x)).argmax(axis=1) if self.count else None
        total, mean = self.count + len(x), x.mean(axis=0)
        gap = mean - self.mean
        self.m2 += ((x - mean) ** 2).sum(axis=0) + gap * gap * self.count * len(x) / total
        self.mean += gap * len(x) / total
        self.count = total
        inputs, target = self._inputs(x), y[:, None] == np.array(CLASSES)
        decay = np.r_[0.0, np.full(x.shape[1], self.penalty)]
        for _ in range(self.steps):
            gradient = (self._chances(inputs) - target).T @ inputs / len(x)
            self.weights -= self.rate * (gradient + decay * self.weights)
        return guess

    def to_row(self) -> list[float]:
        return [float(self.count), *self.mean, *self.m2, *self.weights.ravel()]

    @classmethod
    def from_row(cls, row: Sequence[float], width: int, **options) -> OnlineSoftmax:
        model, flat = cls(width, **options), np.array(row)
        model.count = int(flat[0])
        model.mean, model.m2 = flat[1:1 + width].copy(), flat[1 + width:1 + 2 * width].copy()
        model.weights = flat[1 + 2 * width:].reshape(len(CLASSES), width + 1).copy()
        return model


def online_predictions(
    indexed: DataFrame, features: Sequence[str], *, batch: int = 500, key: str = "symbol", y: str = "y", **options
) -> DataFrame:
    """Test-then-train over every series: ``key, batch, idx, y, prediction`` of all batches but the first.

    Learning follows time, so a series is read by one task, in order and a batch
    at a time; series run side by side. Only one batch and one model are in memory.
    """
    columns = [key, "idx", *features, y]
    kind = indexed.schema[key].dataType.simpleString()
    ordered = indexed.select(*columns).repartition(key).sortWithinPartitions(key, "idx")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, model, number, rest, done = object(), None, 0, None, []

        def learn(idx: np.ndarray, x: np.ndarray, target: np.ndarray) -> None:
            nonlocal number
            guess = model.score_and_learn(x, target)
            if guess is not None:
                done.append((current, number, idx, target, guess))
            number += 1

        def found() -> pd.DataFrame:
            names, numbers, *columns = zip(*done)
            sizes = [len(c) for c in columns[0]]
            repeated = pd.Series(names, dtype=object).repeat(sizes).reset_index(drop=True)
            return pd.DataFrame({key: repeated, "batch": np.repeat(numbers, sizes), **{
                name: np.concatenate(c) for name, c in zip(("idx", y, "prediction"), columns)}})

        for part in parts:
            names = part[key].to_numpy()
            held = part["idx"].to_numpy(), part[list(features)].to_numpy(float), part[y].to_numpy()
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1), len(names)] if len(names) else []
            for first, last in itertools.pairwise(cuts):
                rows = tuple(c[first:last] for c in held)
                if names[first] != current:
                    if rest is not None and len(rest[0]):
                        learn(*rest)
                    current, model, number, rest = names[first], OnlineSoftmax(len(features), **options), 0, None
                if rest is not None and len(rest[0]):
                    rows = tuple(np.concatenate(pair) for pair in zip(rest, rows))
                whole = len(rows[0]) // batch * batch
                for at in range(0, whole, batch):
                    learn(*(c[at:at + batch] for c in rows))
                rest = tuple(c[whole:] for c in rows)
            if done:
                yield found()
                done.clear()
        if rest is not None and len(rest[0]):
            learn(*rest)
        if done:
            yield found()

    return ordered.mapInPandas(run, f"{key} {kind}, batch long, idx long, {y} int, prediction int")


# ------------------------------------------------------------ spark.ml models
def tree_pipeline(features: Sequence[str], params: Mapping[str, int], seed: int) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestClassifier(featuresCol="features", labelCol="y", seed=seed, **params),
    ])


# Ranges of the random search.
TREE_SPACE = {"numTrees": (10, 20, 40), "maxDepth": (3, 5, 7), "minInstancesPerNode": (1, 5, 10), "subsamplingRate": (0.7, 1.0)}
#: What a fit costs before its first level, in levels of one tree (from fits of 30, 100 and 280 of those).
FIT_COST = 40
#: Fits that run side by side. Each is a Spark job of its own; the threads only wait for them.
PARALLEL = 4
#: Rows that all fits side by side hold together: a fit keeps its rows in the executors, some 200 to 350 bytes each.
ROWS_AT_ONCE = 30_000_000


def with_classes(df: DataFrame, y: str = "y") -> DataFrame:
    """``df`` whose label tells that it has ``CLASSES``, so no fit looks through the rows for the number of classes."""
    return df.withMetadata(y, {"ml_attr": {"type": "nominal", "num_vals": len(CLASSES)}})


def _side_by_side(run: Callable, items: Sequence, rows: int) -> list:
    """``run`` of every item, so many at a time that fits over ``rows`` rows each don't push one another out of memory."""
    with ThreadPoolExecutor(max(1, min(PARALLEL, ROWS_AT_ONCE // max(rows, 1)))) as pool:
        return list(pool.map(inheritable_thread_target(run), items))


def _scored(model: PipelineModel, rows: DataFrame) -> tuple[float, int]:
    """Macro F1 of the model on ``rows`` and how many rows were scored, from one aggregate."""
    scores = class_scores(confusion_counts(model.transform(rows).withColumn("prediction", F.col("prediction").cast("int"))))
    found = scores.agg(F.coalesce(F.avg("f1"), F.lit(0.0)), F.coalesce(F.sum(F.col("tp") + F.col("fn")), F.lit(0))).first()
    return float(found[0]), int(found[1])


def fold_score(
    rows: DataFrame, estimator: Pipeline, fold: int, method: str, **fold_options
) -> tuple[float, int]:
    """Macro F1 and number of scored rows of one fold."""
    part = partial(fold_part, rows, method, fold, **fold_options)
    return _scored(estimator.fit(part("train")), part("test"))


def shared_forests(trials: Sequence[Mapping]) -> list[tuple[dict, list[int]]]:
    """The cheapest forests, as (settings, numbers of trials), of which every trial is a part.

    A tree grows level by level and apart from the others, so the first trees of a forest, cut at a smaller depth, are a forest of
    that number and depth. Trials that agree in all else share one if it costs less than their own.
    """
    nested = ("numTrees", "maxDepth")
    alike: dict[tuple, list[int]] = {}
    for number, trial in enumerate(trials):
        alike.setdefault(tuple(sorted((k, v) for k, v in trial.items() if k not in nested)), []).append(number)
    forests = []
    for rest, numbers in alike.items():
        numbers = sorted(numbers, key=lambda i: (trials[i]["maxDepth"], trials[i]["numTrees"]))
        best: list[tuple[int, list[tuple[dict, list[int]]]]] = [(0, [])]
        for stop in range(1, len(numbers) + 1):
            ways = []
            for start in range(stop):
                part = numbers[start:stop]
                size = {k: max(trials[i][k] for i in part) for k in nested}
                ways.append((best[start][0] + FIT_COST + size["numTrees"] * size["maxDepth"], best[start][1] + [(dict(rest) | size, part)]))
            best.append(min(ways, key=lambda w: w[0]))
        forests += best[-1][1]
    return forests


def _leaf_votes(nodes: Mapping[int, Mapping], depth: int) -> list[np.ndarray]:
    """What each leaf of a tree, from left to right, votes for the classes if the tree ends at ``depth``.

    As in a fit of that depth, two leaves of one node that predict the same class are the node itself.
    """
    def walk(at: int, level: int, held: int | None) -> tuple[list[int], bool]:
        """The node that stands for each leaf below ``at``, and whether ``at`` has become a leaf; ``held``: where the tree was cut."""
        node = nodes[at]
        if node["leftChild"] < 0:
            return [at if held is None else held], True
        if held is None and level == depth:
            held = at
        sides = [walk(node[side], level + 1, held) for side in ("leftChild", "rightChild")]
        below = sides[0][0] + sides[1][0]
        if held is not None:
            return below, True
        same = nodes[node["leftChild"]]["prediction"] == nodes[node["rightChild"]]["prediction"]
        if same and sides[0][1] and sides[1][1]:
            return [at] * len(below), True
        return below, False

    stats = [np.array(nodes[i]["impurityStats"]) for i in walk(0, 0, None)[0]]
    return [s / s.sum() if s.sum() else s for s in stats]


def forest_scores(
    model: PipelineModel, rows: DataFrame, parts: Sequence[tuple[int, int]]
) -> list[tuple[float, int]]:
    """Macro F1 and number of scored rows of every (trees, depth) part of a forest on ``rows``, from one pass."""
    forest = model.stages[-1]
    path = scratch_path(rows.sparkSession, "forest")
    forest.write().save(path)
    trees: dict[int, dict[int, Mapping]] = {}
    for r in rows.sparkSession.read.parquet(f"{path}/data").collect():
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    votes = {depth: [np.array(_leaf_votes(trees[t], depth)) for t in range(len(trees))] for depth in {d for _, d in parts}}
    sent = rows.sparkSession.sparkContext.broadcast(votes)
    wide = max(CLASSES) + 1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(parts), wide * wide), dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            leaves = np.array(batch["leaf"].tolist(), dtype=np.int64)
            y = batch["y"].to_numpy(np.int64)
            for depth, of_tree in sent.value.items():
                score = np.zeros((len(batch), of_tree[0].shape[1]))
                for number, table in enumerate(of_tree, 1):
                    score += table[leaves[:, number - 1]]
                    for part, which in enumerate(parts):
                        if which == (number, depth):
                            total[part] += np.bincount(y * wide + score.argmax(axis=1), minlength=wide * wide)
        part, cell = np.nonzero(total)
        yield pd.DataFrame({"part": part, "y": cell // wide, "prediction": cell % wide, "n": total[part, cell]})

    forest.setLeafCol("leaf")
    leaves = model.transform(rows).select("y", vector_to_array("leaf").alias("leaf"))
    counts = leaves.mapInPandas(count, "part int, y int, prediction int, n long")
    found = {r["part"]: (float(r["f1"]), int(r["scored"])) for r in class_scores(counts, ("part",)).groupBy("part").agg(
        F.avg("f1").alias("f1"), F.sum(F.col("tp") + F.col("fn")).alias("scored")).collect()}
    return [found.get(part, (0.0, 0)) for part in range(len(parts))]


def train_tree(
    rows: DataFrame, features: Sequence[str], *, n_trials: int = 30, n_splits: int = 5, seed: int = 42,
    method: str = "rolling_origin", keep: int = 3,
) -> tuple[PipelineModel, dict]:
    """Random search over tree settings by mean macro F1 over folds, then a full fit.

    Successive halving: all trials run on one fold, the best ``1 / keep`` of them on two more, the best ``1 / keep`` of those on
    the rest; the winner is one of the last, which have a score for every fold. Trials that are parts of one forest share its fit;
    fits run side by side. ``rows`` should be stored.
    """
    combos = list(itertools.product(*TREE_SPACE.values()))
    trials = [dict(zip(TREE_SPACE, v)) for v in random.Random(seed).sample(combos, min(n_trials, len(combos)))]
    folds = usable_folds(rows, method, n_splits)
    rows = with_classes(rows)
    size = rows.count()
    scores: list[dict[int, tuple[float, int]]] = [{} for _ in trials]

    def mean(trial: int) -> float:
        return float(np.mean([f1 for f1, _ in scores[trial].values()])) if scores[trial] else 0.0

    alive = list(range(len(trials)))
    for rung in (folds[:1], folds[1:3], folds[3:]):
        if not rung:
            continue
        if rung != folds[:1]:
            alive = sorted(alive, key=mean, reverse=True)[:max(1, -(-len(alive) // keep))]
        jobs = [(forest, [alive[i] for i in numbers], fold)
                for forest, numbers in shared_forests([trials[i] for i in alive]) for fold in rung]

        def score(job: tuple[dict, list[int], int]) -> list[tuple[float, int]]:
            forest, numbers, fold = job
            part = partial(fold_part, rows, method, fold, n_splits=n_splits)
            model = tree_pipeline(features, forest, seed).fit(part("train"))
            return forest_scores(model, part("test"), [(trials[i]["numTrees"], trials[i]["maxDepth"]) for i in numbers])

        # The longest first, so that none is left alone at the end.
        jobs.sort(key=lambda job: -job[0]["numTrees"] * job[0]["maxDepth"])
        for (_, numbers, fold), found in zip(jobs, _side_by_side(score, jobs, size)):
            for trial, one in zip(numbers, found):
                scores[trial][fold] = one
    best = max(alive, key=mean)
    model = tree_pipeline(features, trials[best], seed).fit(rows)
    train_f1, train_rows = _scored(model, rows)
    return model, {
        "best_cv_f1_macro": mean(best), "train_f1_macro": train_f1, "cv_rows": sum(n for _, n in scores[best].values()),
        "train_rows": train_rows, "folds": len(scores[best]), "trials": len(trials), **trials[best]}


def train_sequence(
    indexed: DataFrame, features: Sequence[str], *, length: int = 8, n_splits: int = 5, hidden: int = 16,
    seed: int = 42, max_iter: int = 30, label_horizon: int = 10, top: int | None = None, block: int = 4096,
) -> tuple[PipelineModel, dict]:
    """Feed-forward classifier over flattened feature windows, purged expanding folds, mean macro F1 over the folds.

    A label looks ``label_horizon`` rows ahead and a window ``length`` rows back, so both together are purged between the rows
    trained on and those scored. Each fold, and the final model, picks its ``top`` features (all by default) on its own training
    rows. The final model trains on the first 90 % of the windows and is scored on the rest.
    """
    windows = sequence_windows(indexed, features, "y", length, block=block)
    flat = stage(windows.select(
        "symbol", "timestamp", "y", (F.col("idx") - length).alias("idx"),
        array_to_vector(F.transform(F.flatten("window"), lambda x: x.cast("double"))).alias("raw"),
    ).join(indexed.groupBy("symbol").agg((F.max("n") - length).alias("n")), "symbol"), "windows")
    own = indexed.where(F.col("idx") >= length).withColumns({"idx": F.col("idx") - length, "n": F.col("n") - length})
    purge = label_horizon + length
    options = {"n_splits": n_splits, "label_horizon": purge}
    method, wide = "purged_timeseries", len(features)

    def estimator(train: DataFrame) -> Pipeline:
        chosen = range(wide)
        if top is not None and top < wide:
            best = {r["feature"] for r in top_features(train, features, top).collect()}
            chosen = [i for i, f in enumerate(features) if f in best] or range(wide)
        return Pipeline(stages=[
            VectorSlicer(inputCol="raw", outputCol="chosen", indices=[step * wide + i for step in range(length) for i in chosen]),
            StandardScaler(inputCol="chosen", outputCol="features", withMean=True),
            MultilayerPerceptronClassifier(
                featuresCol="features", labelCol="y", layers=[length * len(chosen), hidden, len(CLASSES)],
                seed=seed, maxIter=max_iter),
        ])

    folds = usable_folds(flat, method, **options)
    scores = _side_by_side(lambda fold: fold_score(
        flat, estimator(fold_part(own, method, fold, "train", **options)), fold, method, **options), folds, flat.count())
    cut = F.floor(F.col("n") * 0.9)
    first = F.col("idx") < cut - purge
    model = estimator(own.where(first)).fit(flat.where(first))
    held_f1, held_rows = _scored(model, flat.where(F.col("idx") >= cut))
    return model, {
        "best_cv_f1_macro": float(np.mean([f1 for f1, _ in scores])) if scores else 0.0, "holdout_f1_macro": held_f1,
        "cv_rows": sum(n for _, n in scores), "holdout_rows": held_rows, "folds": len(scores)}


def score_table(model: PipelineModel, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with a ``prediction`` in -2..2; every stored feature must be present."""
    missing = [f for f in features if f not in rows.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    from marketspark.operators.select import finite_or_zero

    clean = rows.withColumns({f: F.coalesce(finite_or_zero(f), F.lit(0.0)) for f in features})
    scored = model.transform(clean)
    return scored.withColumn(
        "prediction", (F.col("prediction").cast("int") - NEUTRAL).cast("byte")
    ).drop("features", "rawPrediction", "probability")


def score_to_table(entry, rows: DataFrame, path: str, keep: Sequence[str]) -> DataFrame:
    """Score ``rows`` with a registry entry's stored model and features, store the predictions and read them back."""
    scored = score_table(PipelineModel.load(entry["artifact_path"]), rows, entry["feature_columns"])
    scored.select(*keep, "prediction", F.lit(entry["label"]).alias("label")).write.partitionBy("label").parquet(path)
    return rows.sparkSession.read.parquet(path)


def compare_backends(
    spark: SparkSession, backends: Mapping[str, Callable[[], dict]]
) -> DataFrame:
    """Run each backend and tabulate its scores; a failing one does not stop the rest."""
    rows = []
    for name, run in backends.items():
        start = time.monotonic()
        try:
            result = run()
            rows.append((name, "ok", result.get("best_cv_f1_macro"), result.get("train_f1_macro"),
                         time.monotonic() - start, None))
        except Exception as exc:  # noqa: BLE001 - reported in the table
            rows.append((name, "error", None, None, time.monotonic() - start, f"{type(exc).__name__}: {exc}"))
    return spark.createDataFrame(
        rows, "backend string, status string, best_cv_f1_macro double, train_f1_macro double, "
              "elapsed_s double, error string")
