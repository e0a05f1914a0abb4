"""Mixing, vector codes and the filter audit against plain versions and on odd rows."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

import brute
from tarmac.llm import audit, codes, mixing
from tarmac.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- mixing

def plain_targets(sizes: dict, weights: dict, percent=150, epochs=2) -> dict:
    """Targets by clamping one round after the other."""
    left, target, open_ = Fraction(sum(sizes.values()) * percent, 100), {}, set(sizes)
    while open_:
        level = left / sum(weights[s] for s in open_) if any(weights[s] for s in open_) else None
        above = {s for s in open_ if level is None or level * weights[s] > epochs * sizes[s]}
        if not above:
            return target | {s: level * weights[s] for s in open_}
        target |= {s: Fraction(epochs * sizes[s]) for s in above}
        left -= sum(target[s] for s in above)
        open_ -= above
    return target


def cycled(names) -> dict:
    return {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(names, key=lambda s: (s is None, s or "")))}


def check_mix(got, docs, targets):
    """``docs``: (doc_id, text, source)."""
    sizes, taken = defaultdict(list), Counter()
    for _, t, s in docs:
        sizes[s].append(len(WORD.findall(t or "")))
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((i, len(WORD.findall(t or "")), s) for i, t, s in docs)
    for r in got:
        assert r.source_size == sum(sizes[r.source]) and r.target == pytest.approx(float(targets[r.source]))
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, all_sizes in sizes.items():
        repeats = max(Counter((r.doc_id, r.size) for r in got if r.source == s).values())
        assert abs(taken[s] - targets[s]) <= max(all_sizes) * repeats / 2 + 1e-6


def test_mix_on_the_tables(spark):
    docs = brute.rows("documents", "doc_id, text, source")
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(WORD.findall(t or ""))
    got = mixing.mix_sources(spark.read.parquet(f"{brute.SF}/documents.parquet")).collect()
    check_mix(got, docs, plain_targets(sizes, cycled(sizes)))
    out = QUERIES["op11_mix"](spark, brute.SF)
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert Counter(map(tuple, out.collect())) == Counter(
        (r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got)  # reruns agree


def test_mix_does_not_depend_on_buckets_or_ranges(spark, monkeypatch):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    want = Counter(map(tuple, mixing.mix_sources(docs).collect()))
    monkeypatch.setattr(mixing, "LEAST_BUCKETS", 3)
    monkeypatch.setattr(mixing, "SOURCES_PER_RANGE", 3)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert Counter(map(tuple, mixing.mix_sources(docs.repartition(13)).collect())) == want


def test_mix_odd_rows(spark, clashing, no_docs):
    from pyspark.sql import functions as F

    source = F.when(F.col("doc_id") > 6, "b").when(F.col("doc_id") > 3, "").when(F.col("doc_id") > 2, "zero")
    docs = clashing.withColumn("source", source)
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    sizes = Counter({s: 0 for *_, s in rows})
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    got = mixing.mix_sources(docs)
    check_mix(got.collect(), rows, plain_targets(sizes, cycled(sizes)))
    assert mixing.mix_sources(no_docs).collect() == []
    blank = mixing.mix_sources(docs.where("doc_id <= 3")).collect()
    assert {(r.size, r.target, r.taken) for r in blank} == {(0, 0.0, 0)}
    # The rows themselves, as often as the mix takes them, all columns kept.
    unique = docs.where("doc_id <> 8")
    out = mixing.mixed_documents(unique, mixing.mix_sources(unique))
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(
        {r.doc_id: r.copies for r in mixing.mix_sources(unique).collect() if r.copies})


def test_mix_hot_source_and_given_weights(spark, docs_of):
    """One source holds most words; a source without weight gives nothing, a clamped one twice its words."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 90), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)],
                                 "doc_id long, text string, source string")
    weights = spark.createDataFrame([("hot", 1), ("s0", 50), ("s1", 1), ("s2", 1), ("s3", 1), ("s4", 1), ("s5", 1)],
                                    "source string, weight long")
    got = mixing.mix_sources(docs, weights=weights).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += 1 + r.doc_id % 90
    given_ = {r.source: r.weight for r in weights.collect()} | {"s6": 0}
    targets = plain_targets(sizes, given_)
    check_mix(got, [tuple(r) for r in docs.collect()], targets | {"s6": 0})
    assert targets["s0"] == 2 * sizes["s0"] and {r.taken for r in got if r.source == "s6"} == {0}


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.text("abc", max_size=3), st.tuples(st.integers(0, 10**9), st.integers(1, 9)), min_size=1, max_size=12),
       st.integers(1, 300))
def test_water_fill_property(spark, sources, percent):
    rows = [Row(src=s, source_size=n, weight=w) for s, (n, w) in sources.items()]
    out = mixing.water_fill(spark.createDataFrame(rows, "src string, source_size long, weight long"), percent, 2).collect()
    want = plain_targets({s: n for s, (n, _) in sources.items()}, {s: w for s, (_, w) in sources.items()}, percent)
    for r in out:
        assert r.target == pytest.approx(float(want[r.src]), rel=1e-12)


# -- vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, digest) by full searches in Python's whole numbers."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    w = dim // parts
    q = [[int(np.floor(min(max(float(x), -4096.0), 4096.0) * 4096)) for x in v] + [0] * (dim - len(v)) for _, v, _ in kept]
    q = [[v[p * w:(p + 1) * w] for p in range(parts)] for v in q]
    book = [[v[p] for v in q[:entries]] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for v in q:
            for p in range(parts):
                members[p, nearest(v[p], p)[1]].append(v[p])
        for (p, k), m in members.items():
            book[p][k] = [sum(c) // len(m) for c in zip(*m, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    found = [[nearest(v[p], p) for p in range(parts)] for v in q]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by_label[lab] += e
    return [(i, "".join(f"{k:02x}" for _, k in f), e, min(by_label[lab], 2**63 - 1), digest)
            for (i, _, lab), f, e in zip(kept, found, errors, strict=True)]


def test_codes_on_the_tables(spark):
    got = Counter(map(tuple, QUERIES["op12_vector_codes"](spark, brute.SF).collect()))
    assert got == Counter(plain_codes(brute.rows("embeddings", "vec_id, embedding, label")))


@pytest.mark.parametrize("spread", [2, 3000])
def test_orchard_equals_a_full_search(spread):
    """With a small spread most distances tie and entries repeat."""
    rng = np.random.default_rng(spread)
    centres = rng.integers(-spread, spread + 1, (5, 16, 6))
    x = centres[np.arange(5)[None, :], rng.integers(0, 16, (4000, 5))] + rng.integers(-max(1, spread // 9), spread // 9 + 2, (4000, 5, 6))
    code, dist, computed = codes.orchard(x, centres, codes.neighbour_lists(centres))
    full = ((x[:, :, None, :] - centres[None]) ** 2).sum(axis=3)
    assert (code == full.argmin(axis=2)).all() and (dist == full.min(axis=2)).all()
    assert computed < (0.5 if spread > 2 else 1) * full.size  # neighbour lists spare the rest


def test_codes_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=10)], i % 3 if i % 4 else None) for i in range(60)]
    rows += [(None, [1.0] * 10, 1), (100, None, 1), (101, [1.0, None], 1), (102, [nan] * 10, 1), (103, [inf] * 10, 2), (104, [], None),
             (105, [0.5], 0), (106, [1e30, -1e30] * 5, 7), (107, [1e30, -1e30] * 5, 7), (5, [0.25] * 10, 9), (5, [0.25] * 10, 9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    from pyspark.sql import functions as F

    table = table.select("*", *(F.lit("x").alias(c) for c in ("vector", "code", "error", "part", "entry", "n", "_key")))
    assert Counter(map(tuple, codes.compress_vectors(table).collect())) == Counter(plain_codes(rows))
    few = [(3, [0.5, 1.0], 1), (2, [0.5, -1.0], 1), (9, [0.0, 0.0], None)]
    got = codes.compress_vectors(spark.createDataFrame(few, "vec_id long, embedding array<float>, label string"))
    assert Counter(map(tuple, got.collect())) == Counter(plain_codes(few))
    none = codes.compress_vectors(table.where("embedding IS NULL"))
    assert none.collect() == [] and none.columns == got.columns
    empty = codes.compress_vectors(table.where("vec_id = 104")).collect()
    assert [(r.code, r.error) for r in empty] == [("00" * 8, 0)]


# -- filter audit

def plain_audit(docs, labels):
    """(part, filter_order, step, kept, removed, redundant, unique, good, toxic, shapley) document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in docs:
        t = t or ""
        if i is not None:
            first[t] = min(i, first.get(t, i))
    counts, parts = Counter(), {lang or "" for *_, lang in docs}
    for i, t, lang in docs:
        t, part = t or "", lang or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": t in first and (i is None or i > first[t])}
        for order in itertools.permutations("ABCDE"):
            there = True
            for s, f in enumerate(order, 1):
                at = part, "".join(order), s
                if fails[f] and there:
                    counts[*at, "removed"] += 1
                    counts[part, f, "shapley"] += 1
                    counts[*at, "good"] += i in good
                    counts[*at, "toxic"] += i in toxic
                elif fails[f]:
                    counts[*at, "redundant"] += 1
                counts[*at, "unique"] += fails[f] and sum(fails.values()) == 1
                there &= not fails[f]
                counts[*at, "kept"] += there
    return [(p, "".join(o), s, *(counts[p, "".join(o), s, c] for c in ("kept", "removed", "redundant", "unique", "good", "toxic")),
             counts[p, f, "shapley"])
            for p in parts for o in itertools.permutations("ABCDE") for s, f in enumerate(o, 1)]


def test_packed_fields():
    """Every mask's fields say what happens, and sums up to the width do not run over."""
    assert len(audit.STEPS) == 600
    numbers = audit.packed(11)
    for mask, (kept, removed, redundant, unique) in enumerate(numbers):
        for (order, step), k, r, d, u in zip(audit.STEPS, *(audit.unpacked(n, 11) for n in (kept, removed, redundant, unique)), strict=True):
            first = next((s for s, f in enumerate(order) if mask >> "ABCDE".index(f) & 1), None)
            fails = mask >> "ABCDE".index(order[step]) & 1
            assert (k, r, d, u) == (first is None or first > step, first == step, bool(fails) and first < step, bool(fails) and mask.bit_count() == 1)
    assert set(audit.unpacked(2047 * numbers[0][0], 11)) == {2047}


def test_audit_on_the_tables(spark):
    got = Counter(map(tuple, QUERIES["op13_filter_audit"](spark, brute.SF).collect()))
    assert got == Counter(plain_audit(brute.rows("documents", "doc_id, text, lang"), brute.rows("labels", "doc_id, quality, toxic")))


def test_audit_odd_rows(spark, clashing, no_docs, labels_of, monkeypatch):
    from pyspark.sql import functions as F

    docs = clashing.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "x").when(F.col("doc_id") % 3 == 1, ""))
    docs = docs.unionByName(docs.where("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.unionByName(docs.where("doc_id = 7").withColumn("text", F.lit("ALL CAPITALS & marks")))
    labels = [(7, 1, 1), (7, 0, None), (8, None, 1), (None, 1, 1), (12, 1, 0), (999, 1, 1)]
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    want = Counter(plain_audit(rows, labels))
    frame = labels_of(labels)
    assert Counter(map(tuple, audit.audit_filters(docs, frame).collect())) == want
    # Sums passed on whenever a task holds more than one part, and many tasks.
    monkeypatch.setattr(audit, "PARTS_HELD", 1)
    assert Counter(map(tuple, audit.audit_filters(docs.repartition(9), frame).collect())) == want
    assert audit.audit_filters(no_docs, frame).collect() == []
    assert {r.good_lost + r.toxic_lost for r in audit.audit_filters(docs, frame.limit(0)).collect()} == {0}


def test_audit_hot_text_over_many_parts(spark, labels_of):
    """A third of all rows share one text, and there are more parts than one lane."""
    docs = [(i, "same text" if i % 3 == 0 else f"text {i} {'word ' * (i % 120)}", f"p{i % 40}") for i in range(900)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 900, 2)]
    labels = [(i, int(q), int(t)) for i, q, t in labels]
    got = audit.audit_filters(spark.createDataFrame(docs, "doc_id long, text string, lang string"), labels_of(labels))
    assert Counter(map(tuple, got.collect())) == Counter(plain_audit(docs, labels))
