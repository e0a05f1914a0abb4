"""The corpus pipeline against brute force, stage by stage."""

import numpy as np

import brute
import corpus_pipeline
from tarmac.llm import pack
from test_text import check_packing


def test_pipeline_equals_brute_force(spark):
    docs = brute.rows("documents", "doc_id, text")
    lines = {i: t for i, n, gone, t in brute.dedup_lines(docs) if not (gone and not t.strip(" "))}
    groups = brute.near_copies(list(lines.items()), 5)
    left = [(i, t) for i, t in lines.items() if groups[i][1] == i]
    hit = {r[0] for r in brute.contamination(left, brute.rows("benchmark", "item_id, text")) if r[5]}
    clean = [(i, t) for i, t in left if i not in hit]
    assert len(docs) > len(left) > len(clean)
    rows = corpus_pipeline.run(spark, brute.SF).collect()
    n, least = check_packing(rows, clean, pack.CAPACITY)
    assert n <= least + 1


def test_stages_keep_columns_and_odd_rows(spark, clashing, no_docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, brute.SF)
        assert out.columns == clashing.columns
        assert out.where("doc_id IS NULL").count() == 1
        assert stage(spark, no_docs, brute.SF).collect() == []
    near = corpus_pipeline.drop_near_copies(spark, clashing, brute.SF)
    assert near.where("doc_id IN (7, 8)").count() == 1
    assert np.array_equal(sorted(r.doc_id or 0 for r in corpus_pipeline.identify_language(
        spark, clashing, brute.SF).select("doc_id").collect()), [0, 4, 5, 6, 7, 8, 8, 9, 11, 12])


def test_entry_lists_every_query(spark):
    import __spark_entry__ as e

    names = set(e.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(e.oracle_sql()) <= names
