"""Corpus pipeline over ``documents``: toxicity, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes all that its predecessor kept. Every stage but the last returns the
columns it was given; the last returns ids and digests of the tokens of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe_tree, chosen_path, subword_toxic, surrogates, template_match
from tessera.llm.common import table, written
from tessera.llm.queries import PII_KEY, bpe_vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half. Learns from the labels of the given documents."""
    scored = subword_toxic.scored(docs, table(spark, sf_dir, "labels"), F.lit(True), into="__toxicity")
    return scored.where(F.col("__toxicity") < 0.5).drop("__toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component, that of the smallest doc_id (a row without one only if none has
    one). Rows are told apart by doc_id and text: of rows that repeat both one stays. Rows without doc_id and
    without words all stay."""
    loose = F.col("doc_id").isNull() & ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = written(docs.where(~loose).withColumn("__row", F.xxhash64("doc_id", "text")).dropDuplicates(["__row"]), "pipeline-rows")
    group = chosen_path.classes(rows.select(F.col("__row").alias("doc_id"), "text")).select(F.col("doc_id").alias("__row"), "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row")
    kept = rows.select("doc_id", "__row").join(group, "__row").groupBy("component_id").agg(F.min(place).alias("first")).select("first.__row")
    return rows.join(kept, "__row", "left_semi").drop("__row").select(*docs.columns).unionByName(docs.where(loose))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item, as it is or re-parameterised."""
    return template_match.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced; ``n_chars`` follows the text."""
    changed = surrogates.pseudonymised(docs, PII_KEY)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the tokens of each document."""
    return bpe_tree.token_digests(docs, *bpe_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", replace_personal_data),
    ("tokens", tokenize),
]

#: Trained scores, sketches, keyed hashes and token merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order over the documents table; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
