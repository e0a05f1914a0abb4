"""Near copies, embeddings, line dedup and components against brute force, and odd inputs."""

import random

import pytest

from pyspark.sql import functions as F

import brute
from oracle_compare import compare, duck
from tarmac.llm import embeddings, linededup, nearcopies
from tarmac.llm.components import _with_least, components
from tarmac.llm.queries import ORACLES, QUERIES


def as_dict(df, key):
    return {r[key]: r for r in df.collect()}


def test_near_copies_on_the_tables(spark):
    got = as_dict(QUERIES["op3_near_copies"](spark, brute.SF), "doc_id")
    want = brute.near_copies(brute.rows("documents", "doc_id, text"), 2)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def variants(seed, families, copies):
    """Families of texts whose members differ in up to a tenth of their words."""
    rnd, docs = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(30, 90))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rnd.randrange(0, 1 + len(words) // 12)):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(50)}"
            docs.append((len(docs), " ".join(words)))
    return docs


@pytest.mark.parametrize("leaf, levels, pairs_each, block", [(200, 24, 10_000, 1000), (8, 24, 0, 5), (4, 3, 0, 5),
                                                             (4, 24, 10_000, 4)])
def test_near_copies_through_the_trees(docs_of, leaf, levels, pairs_each, block):
    """Small leaves force branching; few levels or a large budget the comparison in blocks."""
    docs = variants(leaf, 14, 9)
    got = as_dict(nearcopies.near_copies(docs_of(docs), k=2, leaf=leaf, levels=levels, pairs_each=pairs_each,
                                         block=block), "doc_id")
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute.near_copies(docs, 2)


@pytest.mark.parametrize("leaf, pairs_each, missed", [(200, 0, 0), (16, 10_000, 0), (16, 0, 3)])
def test_large_group_of_near_copies(docs_of, leaf, pairs_each, missed):
    """A group spread about the threshold; leaves far smaller than it may miss a lone link at 0.8."""
    docs = variants(7, 1, 300)
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(docs_of(docs), k=2, leaf=leaf,
                                                                       pairs_each=pairs_each).collect()}
    assert sum(got[i] != c for i, (_, c) in brute.near_copies(docs, 2).items()) <= missed


def test_near_copies_looks_at_every_level(docs_of, monkeypatch):
    """No level between the first and the last one is left out: a node may be small there only."""
    seen, nodes = [], nearcopies._nodes
    monkeypatch.setattr(nearcopies, "_nodes", lambda level, *a, **b: (seen.append(level), nodes(level, *a, **b))[1])
    rnd = random.Random(4)
    docs = [(i, " ".join(f"w{j}" if rnd.random() < 0.85 else f"x{rnd.randrange(5000)}" for j in range(80)))
            for i in range(200)]
    nearcopies.near_copies(docs_of(docs), k=2, leaf=4, levels=4, pairs_each=0, block=5).collect()
    search = sorted(set(seen[1:]))
    assert search == list(range(1, search[-1] + 1)) and search[-1] > 1


@pytest.mark.parametrize("level", [4, 9, 12])
def test_pairs_at_the_threshold_meet_on_deep_levels(level):
    """Ten trees part 3 of 100 lone pairs on level 9: a deeper level must have more trees."""
    import numpy as np
    import pyarrow as pa

    rnd, pairs = np.random.default_rng(level), 1500
    one = rnd.integers(0, 2 ** 32, (pairs, 64), dtype=np.uint32)
    other = np.where(rnd.random((pairs, 64)) < 0.8, one, rnd.integers(0, 2 ** 32, (pairs, 64), dtype=np.uint32))
    rows = [{"rep": i, "label": i, "sig": x.astype("<u4").tobytes()} for i, x in enumerate(np.concatenate([one, other]))]
    trees = nearcopies.trees_on(level, nearcopies.TREES, 0.8)
    met = np.zeros(pairs, dtype=bool)
    for at in range(0, pairs, 100):
        part = rows[at:at + 100] + rows[pairs + at:pairs + at + 100]
        made = list(nearcopies._nodes(level, trees, 0.8)(iter([pa.RecordBatch.from_pylist(part)])))
        node, rep = (np.concatenate([b.column(c).to_numpy() for b in made]) for c in ("node", "rep"))
        for i in range(at, at + 100):
            met[i] = np.intersect1d(node[rep == i], node[rep == pairs + i]).size > 0
    assert (~met).sum() <= 3  # 0.3 expected


def test_sketches_far_under_the_expected_matches_are_flagged():
    """A pair at 0.8 has 52 equal tokens of 64 on average; 37 are not too few, 30 are."""
    import pyarrow as pa

    for equal, flagged in ((37, [1, 2]), (30, [])):
        bits = ["0" * equal + "f" * (64 - equal), "0" * 64]
        words = [[int.from_bytes(bytes.fromhex(b[i:i + 16]), "little", signed=True) for i in range(0, 64, 16)] for b in bits]
        members = [{"rep": i + 1, "label": i + 1, **{f"s{j}": w[j] for j in range(4)}} for i, w in enumerate(words)]
        batch = pa.RecordBatch.from_pylist([{"node": 7, "members": members}])
        assert [r for b in nearcopies._flag(iter([batch])) for r in b.column("rep").to_pylist()] == flagged


def test_near_copies_odd_rows(clashing, no_docs):
    got = nearcopies.near_copies(clashing, k=2).collect()
    assert len(got) == 14
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_shingles for r in by[1] + by[2] + by[3] + by[4] + by[5]] == [0, 0, 0, 1, 1]
    assert by[7][0].component_id == 7 and by[7][0].kept
    assert [(r.component_id, r.kept) for r in by[8]] == [(7, False)] * 2
    assert by[None][0].component_id is None and by[None][0].kept
    assert nearcopies.near_copies(no_docs).collect() == []


def test_shingles_of_words():
    s = nearcopies.Shingles(2)
    assert len(s.of(b"A b a B")) == 2 and len(s.of(b"a b\x0bc")) == 2
    assert len(s.of("a b\xa0c".encode())) == 1  # a no-break space is part of a word
    assert list(s.of(b"a b")) == list(s.of(b"A\tB")) != list(s.of(b"b a"))
    assert list(s.of(b"ab")) != list(s.of(b"ab ab"))


def test_embeddings_on_the_tables(spark):
    got = as_dict(QUERIES["op6_embeddings"](spark, brute.SF), "vec_id")
    want = brute.embedding_links(brute.rows("embeddings", "vec_id, embedding, label"))
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want


@pytest.mark.parametrize("block", [7, 50])
def test_embeddings_in_many_blocks(spark, block):
    import numpy as np

    rnd = np.random.default_rng(block)
    centres = rnd.standard_normal((12, 10))
    rows = []
    for i in range(240):
        x = centres[i % 12] + rnd.standard_normal(10) * (0.25 if i % 5 else 0.0)
        rows.append((i, [float(v) for v in x], int(i % 3)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = as_dict(embeddings.near_duplicates(df, block=block, sample=40), "vec_id")
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == brute.embedding_links(rows)


def test_far_boxes_are_left_out_before_vectors_travel(spark, monkeypatch):
    """Blocks that touch on the grid's two axes but lie apart on others are never joined; the links stay."""
    import numpy as np

    rnd = np.random.default_rng(3)
    rows = []
    for i in range(400):
        x = rnd.standard_normal(12) * 0.03
        x[i % 12] += 1.0
        rows.append((i, [float(v) for v in x], 1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    compared = spark.sparkContext.accumulator(0)
    plain = embeddings._links

    def counting(cosine):
        run = plain(cosine)

        def count(batches):
            for batch in batches:
                compared.add(batch.num_rows)
                yield from run(iter([batch]))
        return count

    monkeypatch.setattr(embeddings, "_links", counting)
    got = as_dict(embeddings.near_duplicates(df, block=10, sample=400), "vec_id")
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == brute.embedding_links(rows)
    pruned, compared.value = compared.value, 0
    monkeypatch.setattr(embeddings, "box_gap", lambda *_: F.lit(0.0))
    assert as_dict(embeddings.near_duplicates(df, block=10, sample=400), "vec_id") == got
    assert pruned < 0.7 * compared.value


def test_embeddings_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1),
            (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1),
            (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2), (None, [1.0, 0.0], 1), (12, [1e300, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for r in embeddings.near_duplicates(df.selectExpr("*", "'x' AS rep", "1 AS grp", "2 AS k1")).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] * 2 and got[12] == [(3, 1, False)]
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert got[i] == [(0, i, True)], i
    assert got[None] == [(0, None, True)]
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_line_dedup_equals_sql(spark):
    r = compare(spark, "op9_line_dedup", QUERIES["op9_line_dedup"], ORACLES["op9_line_dedup"], brute.SF, duck(brute.SF))
    assert r["ok"], r


def test_line_dedup_brute_force(docs_of):
    rnd = random.Random(3)
    docs = [(i, "\n".join(rnd.choice("abcd ") for _ in range(rnd.randrange(0, 14)))) for i in range(120)]
    got = linededup.dedup_lines(docs_of(docs)).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got) == brute.dedup_lines(docs)


def test_line_dedup_odd_rows(clashing, no_docs):
    out = linededup.dedup_lines(clashing)
    assert set(clashing.columns) <= set(out.columns)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
        assert r["key"] == "extra key"
    assert got[1][0].text is None and got[1][0].n_lines == 0 and got[2][0].text == ""
    assert got[11][0].text == "a\nb\nc\nd" and got[11][0].n_removed == 3
    assert got[12][0].text == "x" and got[12][0].n_removed == 3
    assert [r.n_removed for r in got[8]] == [0, 0] and got[None][0].n_removed == 0
    assert linededup.dedup_lines(no_docs).collect() == []


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == brute.components(nodes, links)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_components_with_star_centres(spark, hot):
    """Stars about their least, their largest and a middle node, joined by single links, odd links among them."""
    stars = [(c, i) for c, at in ((1000, 1001), (2199, 2000), (3050, 3000)) for i in range(at, at + 120)]
    links = stars + [(1100, 2005), (2100, 3111), (7, 7), (1000, 1001), (1001, 1000)] + [(9000 + i, 9001 + i) for i in range(9)]
    odd = spark.createDataFrame([*links, (None, 5), (5, None)], "a long, b long")
    got = [(r.node, r.component) for r in components(odd, hot).collect()]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert len(got) == len(nodes) and dict(got) == brute.components(nodes, [x for x in links if x[0] != x[1]])


def test_no_task_meets_all_links_of_a_centre(spark):
    """The largest partition of a shuffled join holds a few links of a star, the broadcast part the rest as read."""
    star = spark.createDataFrame([(0, i) for i in range(1, 2001)] + [(5000 + i, 8000 + i) for i in range(50)],
                                 "u long, v long").repartition(8)
    met, least = _with_least(star, 64)
    at = met.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert met.count() == 2050 and at < 500 and {r.m for r in met.where("u = 0").select("m").distinct().collect()} == {1}
    assert least.count() == 51
