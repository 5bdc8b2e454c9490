"""Training-corpus pipeline over ``documents``: language, near copies, benchmark leaks, personal data, packing.

Stages find the rows they drop first; that list is small, so the texts are filtered where they lie. A row is named by its id and
a hash of all its columns, so every row is judged by itself, also where ids are repeated or NULL; rows equal in all columns share
one fate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.llm.common import prepare, read, stage
from marketspark.llm.copies import similar
from marketspark.llm.decontaminate import without_leaks
from marketspark.llm.langid import UNKNOWN, identify
from marketspark.llm.packing import pack
from marketspark.llm.pii import anonymise
from marketspark.llm.queries import DEMO_KEY

#: No SQL: fitted language models, fingerprints, alignments, surrogates and packing are beyond it.
ORACLE_SQL = None
ROW = "__row"


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with a name per row that sorts like the id, NULL ids last; only rows equal in all columns share a name."""
    top = F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))  # negative ids first
    name = F.coalesce(F.lpad(F.hex(top), 16, "0"), F.lit("~"))
    return docs.withColumn(ROW, F.concat(name, F.lpad(F.hex(F.xxhash64(*_columns(docs))), 16, "0")))


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fit no language: those without a letter, and noise."""
    rows = _named(docs)
    rejected = stage(identify(rows, ROW).where(F.col("language") == UNKNOWN).select(ROW).distinct(), "rejected")
    return rows.join(rejected, ROW, "left_anti").select(*_columns(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group of near copies, among rows of that id the one of the smallest hash, and
    one of rows that are equal in all columns. A NULL id stays only without any other.

    Near copies are linked by SimHash over five words, and by min-hash bands for what lies further apart than its four bits; an
    exact five-word Jaccard of 0.8 or more decides each link."""
    rows = _named(docs)
    found = stage(similar(rows, ROW), "groups")
    copies = stage(found.where(F.col(ROW) != F.col("component_id")).select(ROW).distinct(), "copies")
    repeated = stage(found.groupBy(ROW).count().where("count > 1").select(ROW), "repeated")
    left = rows.join(copies, ROW, "left_anti")
    if not repeated.isEmpty():
        left = left.join(repeated, ROW, "left_anti").unionByName(left.join(repeated, ROW, "left_semi").distinct())
    return left.select(*_columns(docs))


def no_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return without_leaks(_named(docs), read(spark, sf_dir, "benchmark"), ROW).select(*_columns(docs))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data; n_chars follows the new text."""
    clean = anonymise(docs, DEMO_KEY)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the place of every piece of every document."""
    return pack(docs)


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_each_group),
    ("benchmark", no_benchmark_text),
    ("personal_data", no_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written as Parquet and read again by the next."""
    docs = read(prepare(spark), sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
