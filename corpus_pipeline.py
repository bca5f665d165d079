"""From raw documents to token ids: the stages of a training corpus, one after another.

All stages read whole texts of any length, keep every column they are given under its name and
with its values, whatever it is called, and turn an empty table into an empty one. Repeated
rows are as many documents, until one copy of each stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesieve.llm import bpe, decontaminate, quality, simhash, surrogates
from lakesieve.llm.common import table
from lakesieve.llm.queries import KEY, vocabulary_path
from lakesieve.session import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the quality classifier accepts; it is learned from two thirds of the labels.

    A null or empty text has the share of good documents among the labelled ones as its
    score, so it stays where that is a half at least. A null id teaches nothing and is scored.
    """
    model = quality.fit(docs, quality.labelled_fold(table(spark, sf_dir, "labels")))
    return quality.score(docs.select(F.struct("*").alias("row"), "text"), model).where("score >= 0.5").select("row.*")


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the least id.

    Null, empty and blank texts are one group. Of rows that share the least id, and of a
    group without any id, one row stays.
    """
    return simhash.drop_near_duplicates(docs)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts hold none, and a null or empty item is held by none. All rows of an
    id go if one of them holds an item; a null id counts as one id.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates for personal data, and the length of the new text.

    Null and empty texts, and all without personal data, stay as they are, lengths included.
    Equal texts become equal texts.
    """
    found = surrogates.pseudonymise(docs.select(F.struct("*").alias("row"), "text"), KEY)
    length = F.when(F.col("n_replaced") > 0, F.length("text").cast("bigint")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("text"), "n_chars": length}
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, their number, and the text they decode to.

    A null or empty text has no ids and decodes to an empty one. Only id and text are read.
    """
    found = bpe.round_trip(docs.select("doc_id", "text"), vocabulary_path())
    return found.select("doc_id", "ids", "n_tokens", F.col("decoded").alias("text"))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_copy),
    ("decontamination", keep_unseen),
    ("private_data", replace_private),
    ("tokens", encode),
]

#: Learned vectors, components and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each reading what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
