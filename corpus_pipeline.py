"""A corpus pipeline of five training-data operators.

Documents whose language cannot be told go; passages of three lines that were seen
before go; of each group of near copies one document stays; documents that hold a
benchmark passage go; the rest is packed into sequences of 2048 tokens. Every stage
takes all rows that the one before it kept and its result is written as Parquet and read
again, so an executor lost later costs a re-read.

Stages keep all columns of their input, whatever their names, but for ``text``, which line
dedup shortens. NULL and empty texts have no language, so they go in the first stage;
an empty table passes through all of them. Rows that share a doc_id are told apart by
their texts up to near dedup, which keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm import decontaminate, language, linededup, nearcopies, pack
from tarmac.llm.common import importable, is_held_out, stored, table

#: A document goes if no language holds this share of it.
LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are mostly in one language, learned from those not held out.

    Goes: NULL texts, texts without a letter, and texts of which no language has half.
    """
    importable(spark)
    return language.keep_identified(docs, docs.where(~is_held_out("doc_id")), LEAST_SHARE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the three-line passages that an earlier one holds.

    A document of which nothing is left goes; one that was blank before stays.
    """
    found = linededup.dedup_lines(docs)
    return found.where(~((F.col("n_removed") > 0) & (F.trim("text") == ""))).select(*_names(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies (five words, 0.8).

    Of rows that share that id the one whose text hashes lowest stays; rows without id stay.
    """
    importable(spark)
    kept = nearcopies.near_copies(docs, k=5, percent=80).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    ours = docs.join(kept, "doc_id", "left_semi").withColumn("__place", F.row_number().over(first))
    return ours.where("__place = 1").select(*_names(docs)).unionByName(docs.where("doc_id IS NULL"))


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    importable(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    importable(spark)
    return pack.pack_documents(docs)


STAGES = [
    ("language identification", identify_language),
    ("line dedup", dedup_lines),
    ("near-duplicate removal", drop_near_copies),
    ("benchmark decontamination", decontaminate_documents),
    ("sequence packing", pack_sequences),
]

#: Language mixtures, minwise trees and tokens have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
