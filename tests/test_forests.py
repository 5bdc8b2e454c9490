"""Trials of the tree search that share a fit."""

import itertools
import random

from pyspark.sql import functions as F

from marketspark.operators import models
from marketspark.operators.models import TREE_SPACE


def noisy(spark, n):
    draws = [F.rand(i).alias(c) for i, c in enumerate("abcr", 1)]
    label = F.when(F.col("r") > 0.5, F.floor(F.rand(9) * 5)).otherwise(F.floor(F.col("a") * F.col("b") * 7) % 5).cast("int")
    return models.with_classes(spark.range(n).select("id", *draws).withColumn("y", label).cache())


def test_parts_of_a_forest_score_as_forests_of_their_own(spark):
    df, features = noisy(spark, 6000), ["a", "b", "c"]
    params = {"numTrees": 5, "maxDepth": 6, "minInstancesPerNode": 5, "subsamplingRate": 0.7}
    model = models.tree_pipeline(features, params, 42).fit(df)
    parts = [(5, depth) for depth in (6, 4, 2, 1)] + [(3, 6)]
    got = models.forest_scores(model, df, parts)
    # The draws of a fit don't depend on its depth, so a cut forest is the very one of that depth.
    for (trees, depth), (f1, rows) in zip(parts[:-1], got):
        own = models.tree_pipeline(features, params | {"numTrees": trees, "maxDepth": depth}, 42).fit(df)
        assert (round(f1, 9), rows) == (round(models._scored(own, df)[0], 9), 6000)
    # Fewer trees: their votes, added up here tree by tree.
    trees = model.stages[-1].trees[:3]
    rows = model.stages[0].transform(df.limit(300)).collect()
    (f1, scored), = models.forest_scores(model, df.limit(300), [(3, 6)])
    cells = {}
    for r in rows:
        votes = [list(t.predictProbability(r["features"])) for t in trees]
        sums = [sum(v) for v in zip(*votes)]
        guess = sums.index(max(sums))
        cells[r["y"], guess] = cells.get((r["y"], guess), 0) + 1
    classes = {c for pair in cells for c in pair}
    want = [2 * cells.get((c, c), 0) / sum(n * ((y == c) + (p == c)) for (y, p), n in cells.items()) for c in classes]
    assert scored == 300 and round(f1, 9) == round(sum(want) / len(want), 9)
    assert models.forest_scores(model, df.where("id < 0"), [(3, 6)]) == [(0.0, 0)]


def test_every_trial_is_part_of_one_forest_and_none_costs_more():
    cost = lambda t: models.FIT_COST + t["numTrees"] * t["maxDepth"]
    combos = [dict(zip(TREE_SPACE, v)) for v in itertools.product(*TREE_SPACE.values())]
    for seed, n in ((1, 1), (2, 4), (3, 10), (42, 30)):
        trials = random.Random(seed).sample(combos, n)
        forests = models.shared_forests(trials)
        assert sorted(i for _, numbers in forests for i in numbers) == list(range(n))
        for forest, numbers in forests:
            for i in numbers:
                assert all(trials[i][k] <= forest[k] if k in ("numTrees", "maxDepth") else trials[i][k] == forest[k] for k in TREE_SPACE)
        assert sum(cost(f) for f, _ in forests) <= sum(map(cost, trials))
    assert len(forests) == 6


def test_the_search_fits_fewer_forests_than_it_has_trials(spark, monkeypatch):
    df = noisy(spark, 200).select(F.lit("A").alias("symbol"), F.col("id").alias("idx"), F.lit(200).alias("n"), "a", "b", "y")
    fitted, pipeline = [], models.tree_pipeline
    monkeypatch.setattr(models, "tree_pipeline", lambda features, params, seed: fitted.append(params) or pipeline(features, params, seed))
    _, metrics = models.train_tree(df, ["a", "b"], n_trials=12, n_splits=2)
    assert metrics["trials"] == 12 and metrics["folds"] == 2 and metrics["cv_rows"] == 20 and metrics["train_rows"] == 200
    assert len(fitted) < 12
