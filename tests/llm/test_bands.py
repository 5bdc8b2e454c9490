"""Band edges of the near-copy stage: one shuffle, the same groups as all pairs of a band."""

import numpy as np
from pyspark.sql import functions as F

from marketspark.llm import copies
from marketspark.llm.components import components


def test_band_edges_join_what_shares_a_key(spark):
    rng = np.random.default_rng(7)
    rows = [(int(n), [int(k) for k in rng.integers(0, 400, 2)]) for n in rng.integers(-60, 60, 150)] + [(1000, []), (1001, [-5])]
    rows += rows[:20]  # exact copies
    prints = spark.createDataFrame(rows, "node long, keys array<long>").repartition(7)
    keyed = prints.select("node", F.explode("keys").alias("key")).distinct()
    pairs = keyed.join(keyed.withColumnRenamed("node", "low"), "key").where("low < node").select("node", "low")
    edges = copies._banded(prints)
    want, got = ({tuple(r) for r in components(e, "node", "low").collect()} for e in (pairs, edges))
    assert want and got == want
    assert edges._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
