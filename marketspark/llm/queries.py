"""The registered queries of this subpackage: one per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketspark.llm import chat, codes, decontaminate, html, langid, lm, packing, phrases, pii, search, sharding, simhash, toxicity
from marketspark.llm.common import prepare, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return register


@query("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark, sf):
    found = simhash.near_duplicates(read(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf):
    return packing.pack(read(spark, sf, "documents"))


@query("op9_lm_scoring")
def op9_lm_scoring(spark, sf):
    return lm.score(read(spark, sf, "documents"))


@query("op6_html_extraction")
def op6_html_extraction(spark, sf):
    return html.main_text(read(spark, sf, "pages"))


@query("op7_benchmark_decontamination")
def op7_benchmark_decontamination(spark, sf):
    return decontaminate.leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query("op1_language_id")
def op1_language_id(spark, sf):
    return langid.identify(read(spark, sf, "documents"))


#: Surrogates follow from this key; a real run passes a secret of its own.
DEMO_KEY = "demonstration"


@query("op8_pii_surrogates")
def op8_pii_surrogates(spark, sf):
    found = pii.anonymise(read(spark, sf, "documents"), DEMO_KEY, count_col="n_replaced")
    return found.select("doc_id", "text", "n_replaced")


#: Bytes of text in a shard.
SHARD_LIMIT = 1 << 20


@query("op4_extendible_sharding", sharding.oracle(SHARD_LIMIT))
def op4_extendible_sharding(spark, sf):
    found = sharding.assign(read(spark, sf, "documents").select("doc_id", "text"), SHARD_LIMIT)
    return found.select("doc_id", "n_bytes", "shard", "local_depth", "page", "shard_bytes")


@query("op3_quotation_linking", chat.ORACLE)
def op3_quotation_linking(spark, sf):
    return chat.conversations(read(spark, sf, "conversations"))


@query("op5_topk_search")
def op5_topk_search(spark, sf):
    docs = read(spark, sf, "documents")
    return search.top_k(docs, docs.where("doc_id % 100 = 0"))


@query("op11_phrase_collocations", phrases.oracle())
def op11_phrase_collocations(spark, sf):
    return phrases.collocations(read(spark, sf, "documents"))


@query("op12_vector_codes", codes.oracle())
def op12_vector_codes(spark, sf):
    return codes.codes(read(spark, sf, "embeddings"))


@query("op13_toxicity")
def op13_toxicity(spark, sf):
    return toxicity.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))
