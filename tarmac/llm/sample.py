"""The bounded labelled sample that the trained classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import is_held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents outside the held-out fold.

    The documents whose id hashes lowest are taken, so the choice does not depend on
    order or partitioning. Only their ids, at most ``rows``, are broadcast. NULL ids
    and labels are no examples; a document labelled twice has its largest label, and of
    rows that share an id the smallest text counts.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out("doc_id"))
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")).select("text", "label"))
