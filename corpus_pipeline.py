"""Preparation of a corpus: toxic documents out, lines and documents made unique, sources mixed, pieces counted.

Each stage takes all that the one before it kept, from Parquet, and returns the columns
of documents (the last one: digests of ids, decoded text and pieces' ends). Where a stage
changes a text, n_chars follows it; other columns stay, whatever their names.

Rows: a null or empty text is clean, has no lines to lose, is no near copy of anything and
gives the mix no words, so it leaves with the mix. A null doc_id is no bar: such rows come
after all others in the order of lines, and are no near copies. Rows that repeat both
doc_id and text are judged alike; of near copies one row stays, of those with one doc_id the
one with the least hash of its text. Very long texts are read whole. An empty table goes
through all stages and stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm import lines, mixing, neardup, toxicity
from gazette.llm.common import kept
from gazette.llm.queries import encoded


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars as the text has them, where there are both columns."""
    if docs.columns.count("n_chars") != 1 or docs.columns.count("text") != 1:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; learned from the labelled rows that are not held out."""
    return toxicity.not_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def with_unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly equal an earlier one; gone where no line with a word is left."""
    left = lines.unique_lines(docs)
    return _measured(left.where("n_lines = 0 or n_removed < n_lines").drop("n_lines", "n_removed"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five-word shingles, similarity 0.8."""
    return neardup.one_of_each(docs)


def with_mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each pass over a document that takes some."""
    return _measured(mixing.mixed(docs))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text, for each row of the mix."""
    return encoded(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", with_unique_lines),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", with_mixed_sources),
    ("SentencePiece encoding and decoding", as_pieces),
]

#: SQL cannot express the trained network.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
