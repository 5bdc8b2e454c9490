"""Every operator on NULLs, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import tracemalloc

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketspark.llm import chat, decontaminate, html, langid, lm, packing, pii, search, sharding, simhash

EXTRA = ("id", "fp", "row", "batch", "length", "h", "kind", "entity", "host", "cell", "n", "doc", "found", "page",
         "score", "label", "_metadata")
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
LONG = "une phrase assez longue pour durer. " * 6000


def docs(spark, empty=False):
    texts = [(1, "The quick brown fox jumps over the lazy dog and runs away. mail a.b@c.org", "en", "s"),
             (1, "The quick brown fox jumps over the lazy dog and runs away. mail a.b@c.org", "en", "s"),
             (2, "The quick brown fox jumps over the lazy dog and runs away. mail a.b@c.org", "en", "s"),
             (3, None, None, None), (4, "", "en", ""), (None, "Der schnelle braune Fuchs springt über den faulen Hund", "de", "t"),
             (5, LONG, "fr", "u"), (6, " \n\t ", "", "s"), (7, "!!! ???", "xx", "s"), (8, "Der schnelle braune Fuchs", None, "t")]
    rows = [] if empty else [(i, t, lang, s, None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, lang, s in texts]
    return spark.createDataFrame(rows, DDL)


OPERATORS = {
    "language": lambda d: langid.identify(d),
    "packing": lambda d: packing.pack(d).where("piece = 0"),
    "sharding": lambda d: sharding.assign(d, 100),
    "lm": lambda d: lm.score(d),
    "pii": lambda d: pii.anonymise(d, "k"),
    "simhash": lambda d: simhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(spark, name):
    df = docs(spark)
    assert sorted(str(r[0]) for r in OPERATORS[name](df).select("doc_id").collect()) == sorted(
        str(r[0]) for r in df.select("doc_id").collect())
    assert OPERATORS[name](docs(spark, empty=True)).count() == 0


def test_defined_results(spark):
    df = docs(spark)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(df).collect()}
    assert got[2]["component_id"] == 1 and got[3]["fp"] == 0 and got[7]["fp"] != 0
    assert {got[i]["component_id"] for i in (3, 4, 6)} == {3}
    lang = {r["doc_id"]: r["language"] for r in langid.identify(df).collect()}
    assert lang[3] == lang[4] == lang[6] == lang[7] == "und" and lang[1] == "en" and lang[None] == "de" and lang[5] == "fr"
    scores = {r["doc_id"]: r for r in lm.score(df).collect()}
    assert scores[3]["n_tokens"] == scores[6]["n_tokens"] == 1 and scores[5]["n_tokens"] == 36001
    clean = {r["doc_id"]: r for r in pii.anonymise(df, "k").collect()}
    assert clean[3]["text"] is None and "a.b@c.org" not in clean[1]["text"] and clean[5]["text"] == LONG
    assert clean[1]["text"] == clean[2]["text"] and clean[1]["row"] == "x" and clean[1].asDict().keys() == set(df.columns)


def test_shards_within_their_limit(spark):
    df = docs(spark).select("doc_id", "text", "page", "h").union(
        spark.range(300).selectExpr("9L", "repeat('z', 30)", "'x'", "'x'"))
    rows = sharding.assign(df, 100).collect()
    assert len(rows) == 310
    sizes = {}
    for r in rows:
        key = (r["shard"], r["page"])
        sizes.setdefault(key, []).append(r["n_bytes"])
    assert all(sum(v) <= 100 or len(v) == 1 for v in sizes.values())
    assert sum(len(v) for k, v in sizes.items() if 30 in v) >= 300


def test_leak_search_holds_little_of_a_batch():
    index = decontaminate.Index(decontaminate.windows("q", "one two three four five six seven eight nine ten"))
    texts = [f"{i} some words of no item whatsoever " * 60 for i in range(500)]
    texts[3] += "one two three four five six seven eight nine ten"
    texts[-1] += "one two three four five six seven eight nine ten"
    tracemalloc.start()
    try:
        found = list(index.search_all(texts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [row[0] for row in found] == [3, 499] and list(index.search_all([])) == []
    assert peak < 24 << 20


def test_leaks(spark):
    df = docs(spark)
    bench = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog, and RUNS away", "x"), (2, None, "x"), (3, "", "x"), (4, "fox", "x")],
        "item_id long, text string, doc_id string")
    found = [tuple(r)[:3] for r in decontaminate.leaks(df, bench).collect()]
    assert sorted(found) == [(1, 1, 0), (1, 1, 0), (2, 1, 0)]
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0
    assert decontaminate.leaks(docs(spark, empty=True), bench).count() == 0
    left = decontaminate.without_leaks(df, bench)
    assert left.columns == df.columns and left.count() == 7


def test_search(spark):
    df = docs(spark)
    got = search.top_k(df, df, k=2).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["doc_id"]) for r in got if r["query_id"] in (1, 2)] == [(1, 1), (1, 1), (2, 1), (2, 1)]
    assert {r["query_id"] for r in got} == {1, 2, 5, 8}
    assert search.top_k(docs(spark, empty=True), df).count() == 0
    assert search.top_k(df, df.limit(0)).count() == 0


def test_pages(spark):
    rows = [(1, "http://a.b/c", None, "x"), (2, None, "", "x"), (3, "no address", "plain &lt;text&gt;\n here", "x"),
            (4, "http://a.b/d", "<p>a<p>b" * 500, "x"), (4, "http://a.b/d", "<p>a<p>b" * 500, "x"),
            (None, "http://a.b/e", "<script>x</script><!-- c --><p>c", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted((str(r[0]), r[1], r[2], r[3]) for r in html.main_text(df).collect() if r[0] != 2 and r[0] != 4)
    assert got == [("1", "http://a.b/c", "", 0), ("3", "no address", "plain <text> here", 17), ("None", "http://a.b/e", "c", 1)]
    both = [r for r in html.main_text(df).collect() if r[0] == 4]
    assert len(both) == 2 and both[0] == both[1] and both[0]["text"] == "\n".join(["a", "b"] * 500)
    assert html.main_text(df.limit(0)).count() == 0


def test_conversations(spark):
    rows = [(1, 0, "a", "Hello\nthere", "x"), (1, 1, "b", "> Hello\n> there\nyes", "x"), (1, 1, "b", "> Hello\n> there\nyes", "x"),
            (None, 0, "a", "> x", "x"), (2, None, None, None, "x"), (2, 0, "c", "", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string")
    got = {(r[0], r[1]): r for r in chat.conversations(df).collect()}
    assert chat.conversations(df).count() == 6 and got[1, 1]["reply_to"] == 0 and got[1, 1]["content"] == "yes"
    assert got[2, None]["order_key"] == "" and got[None, 0]["reply_to"] is None and got[None, 0]["n_quoted"] == 1
    assert chat.conversations(df.limit(0)).count() == 0


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    plain = docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    spark.createDataFrame([(1, "nothing of this is in there at all, I hope")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for frame, left in ((plain, {"1", "8", "5", "None"}), (plain.limit(0), set())):
        df = frame
        for name, step in corpus_pipeline.STAGES[:-1]:
            df = step(spark, df, str(tmp_path))
            assert df.columns == plain.columns, name
        assert {str(r[0]) for r in df.collect()} == left
        assert {str(r[0]) for r in corpus_pipeline.packed(spark, df, "").select("doc_id").collect()} == left


def test_pipeline_judges_rows_not_ids(spark, tmp_path):
    fox = "the quick brown fox jumps over the lazy dog and runs away from the hunters of the village near the old mill"
    item = "every good answer to this question names the river that crosses the capital of the country"
    good = [(7, "Das ist ein guter deutscher Text über den alten Wald am Fluss"), (None, "Ein anderer guter Text über die alte Stadt"),
            (-3, fox), (None, "Und noch ein ganz anderer Satz ohne jede Nummer")]
    bad = [(7, "!!! 123"), (None, "??? 99"), (2, fox), (2, fox + " again"), (None, fox), (-3, fox), (9, item), (None, item)]
    docs = spark.createDataFrame([(i, t, "de", "s", len(t)) for i, t in [*bad, *good, (9, "Neun steht auch für diesen kurzen Satz")]],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, step in corpus_pipeline.STAGES[:3]:
        docs = step(spark, docs, str(tmp_path))
    assert sorted((str(r[0]), r[1]) for r in docs.collect()) == sorted(
        (str(i), t) for i, t in [*good, (9, "Neun steht auch für diesen kurzen Satz")])


def test_count_column_that_exists(spark):
    df = docs(spark).withColumn("n_replaced", F.lit("x"))
    found = pii.anonymise(df, "k", count_col="n_replaced")
    assert found.columns == df.columns and sorted(r["n_replaced"] for r in found.collect()) == [0] * 7 + [1] * 3
