"""The rounds and bounds of the top-k search."""

import numpy as np
import pytest

from marketspark.llm import search

K = 10


def texts(n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{w}" for w in rng.zipf(1.2, rng.integers(5, 60)) % 4000) for _ in range(n)]


def test_tasks_of_the_last_round_return_what_can_still_be_an_answer(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(texts(2000, 3))), "doc_id long, text string").repartition(64).cache()
    queries = docs.where("doc_id % 100 = 0")
    rows, stage = [], search.stage
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def counted(df, label="stage", **options):
        kept = stage(df, label, **options)
        if label == "answers":
            rows.append(kept.count())
        return kept

    monkeypatch.setattr(search, "stage", counted)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a file a task
    try:
        want = search.top_k(docs, queries, K).orderBy("query_id", "rank").collect()
        rows.clear()
        monkeypatch.setattr(search, "SHARD_DOCS", 8)
        monkeypatch.setattr(search, "PASS_TERMS", 150)  # several blocks of queries
        got = search.top_k(docs, queries, K).orderBy("query_id", "rank").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [tuple(r)[:3] for r in got] == [tuple(r)[:3] for r in want] and len(got) == 20 * K
    assert [r["score"] for r in got] == pytest.approx([r["score"] for r in want])
    # 64 tasks with the ten best of each would be 12,800.
    assert sum(rows) < 64 * K * 20 / 2, rows


def test_single_precision_loses_no_answer(monkeypatch):
    monkeypatch.setattr(search, "GROUP_DOCS", 64)
    monkeypatch.setattr(search, "BLOCK_DOCS", 16)
    rng = np.random.default_rng(5)
    vocabulary = np.sort(rng.integers(0, 2**64 - 1, 500, dtype=np.uint64))
    vocabulary[-1] = 2**64 - 1
    terms = [vocabulary[np.unique(rng.zipf(1.3, rng.integers(0, 50)) % 500)] for _ in range(700)]
    terms += terms[:40] + [np.array([7], dtype=np.uint64)]
    counts = [rng.integers(1, 5, len(t)).astype("<u4") for t in terms[:700]]
    counts += counts[:40] + [np.array([3], dtype="<u4")]
    lengths = np.array([c.sum() for c in counts])
    shard = search.Shard(np.arange(len(terms)), lengths, terms, counts, vocabulary, lengths.mean())
    asked = [np.unique(rng.zipf(1.3, 20) % 500) for _ in range(30)] + [np.zeros(0, np.int64)]
    weights = [rng.random(len(t)) * 9 + 0.1 for t in asked]
    score = np.zeros((len(asked), len(terms)))
    for q, (t, w) in enumerate(zip(asked, weights, strict=True)):
        by = dict(zip(vocabulary[t].tolist(), w, strict=True))
        for d, (own, many) in enumerate(zip(terms, counts, strict=True)):
            score[q, d] = sum(by.get(int(x), 0) * c * 2.2 / (c + 1.2 * (.25 + .75 * lengths[d] / lengths.mean()))
                              for x, c in zip(own, many, strict=True))
    best = np.round(-np.sort(-score, axis=1)[:, :K], search.DIGITS)
    for floors in (np.full(len(asked), -np.inf), best[:, -1]):
        for q, (docs, found) in enumerate(shard.best(asked, weights, K, floors)):
            assert found == pytest.approx(score[q, shard.ids[docs]])
            want = np.flatnonzero((score[q] > 0) & (score[q] >= best[q, -1] - 1e-9))
            assert set(want) <= set(shard.ids[docs])
