"""The corpus pipeline: documents through five stages, each written before the next.

Every stage takes documents (doc_id, text, lang, source and whatever else) and says in
its docstring what becomes of null and empty texts, ties, repeated rows, empty tables and
extra columns. All but the last return the columns that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, language, near_dedup, pieces, quality
from tidewater.llm.common import table, written

# No SQL can say the models and signatures of the stages; tests/llm/test_pipeline.py
# compares run() with a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told.

    Null, empty and letterless texts go, and those whose likeliest language has a
    probability under a half. Learned from the given languages; without any, all go.
    Repeated rows are judged each, by their text alone. No rows give none.
    """
    return language.known_language(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the forest.

    Null and empty texts have too few words and go. Rows of equal or null ids are judged
    by their own text; a null id has no label. Without labels the base rules decide.
    """
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the least id, of equal ids
    that of the least text key, and one of repeated rows. A null id comes last; a null
    text is an empty one, and texts without words are duplicates of equal texts only."""
    return near_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items. Null and empty texts hold none; so do all where
    there is no item with a word. Repeated rows stay or go together."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and decoded (the text of the ids) of what is
    left. A null or empty text has no ids; rows are encoded each; other columns go."""
    docs = docs.select("doc_id", "lang", "source", "text")
    out = pieces.encode(docs, decoded="decoded")
    return out.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table documents; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
