"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tarmac.llm import (audit, codes, decontaminate, embeddings, language, linededup, mixing, nearcopies, pack, pii,
                        quality, shard, toxicity)
from tarmac.llm.common import importable, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_copies(table(spark, sf_dir, "documents"), k=2, percent=80)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(spark, sf_dir, "documents"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack_documents(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op11_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), percent=150, max_epochs=2).drop("copies", "source")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress_vectors(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def _ready(query: QueryFn) -> QueryFn:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, QueryFn] = {f.__name__: _ready(f) for f in (
    op1_quality, op2_toxicity, op3_near_copies, op4_decontaminate, op5_language, op6_embeddings, op7_shard, op8_pack,
    op9_line_dedup, op10_pii, op11_mix, op12_vector_codes, op13_filter_audit, pipeline)}
ORACLES: dict[str, str] = {"op9_line_dedup": linededup.LINE_DEDUP_SQL, "op11_mix": mixing.MIX_SQL,
                           "op12_vector_codes": codes.CODES_SQL, "op13_filter_audit": audit.AUDIT_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
