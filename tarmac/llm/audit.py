"""Filter interaction audit by wide packed counters.

A document's mask says which of the filters it fails. For every order of the filters the mask
settles what happens at every step: the document is kept or removed there, or fails a
filter that it no longer reaches. Each mask is mapped to whole numbers with one field for each
of the 600 steps of the 120 orders. Adding up these numbers over the documents of a part counts all
steps at once, as fields are wide enough for the number of all documents and so never
run into each other. Sums are made in every task, then of the tasks' sums, and unpacked at the
end.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored

FILTERS = "ABCDE"
#: All orders, and the 600 (order, step) pairs that the fields stand for.
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(len(FILTERS))]
#: The counters: outcomes of all documents, and removals of those labelled good or toxic.
COUNTERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Parts whose sums a task holds at most before it passes them on (some 20 KB each).
PARTS_HELD = 2000
#: Tasks that add up the sums of all tasks of one part.
FAN = 16

WORD = r"([^\x20\x09-\x0D]+)"
FEWEST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
MARKS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def outcome(mask: int, order: str, step: int) -> tuple[bool, bool, bool, bool]:
    """Whether a document of this mask is kept after the step, removed at it, redundant at it, unique to its filter."""
    bits = [mask >> FILTERS.index(f) & 1 for f in order]
    earlier = any(bits[:step])
    return (not any(bits[:step + 1]), bool(bits[step]) and not earlier, bool(bits[step]) and earlier,
            mask == 1 << FILTERS.index(order[step]))


def packed(width: int) -> list[tuple[int, int, int, int]]:
    """For each mask, the four whole numbers (kept, removed, redundant, unique) of 600 fields of ``width`` bits."""
    out = []
    for mask in range(1 << len(FILTERS)):
        numbers = [0, 0, 0, 0]
        for i, (order, step) in enumerate(STEPS):
            for k, yes in enumerate(outcome(mask, order, step)):
                numbers[k] |= int(yes) << i * width
        out.append(tuple(numbers))
    return out


def unpacked(number: int, width: int) -> list[int]:
    return [number >> i * width & (1 << width) - 1 for i in range(len(STEPS))]


def text_masks(text: Column) -> Column:
    """The bits of filters A to D of a text that is not NULL."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(1))
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    fails = (n < FEWEST_WORDS, F.size(F.array_distinct(words)) * 100 < n * DISTINCT_PERCENT,
             capitals.cast("long") * 100 > F.length(text).cast("long") * CAPITAL_PERCENT, text.rlike(MARKS))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) of every document; stored."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text_masks(text).alias("mask"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("key")), "audit-rows")
    # The smallest id of each text that occurs more than once; combined in the tasks, so that a hot text is a row a task.
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = rows.join(first, "key", "left").withColumn(
        "mask", F.col("mask") + F.when(F.col("first").isNotNull() & F.coalesce(F.col("doc_id") > F.col("first"), F.lit(True)), 16).otherwise(0))
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # NULL ids match no label; they are kept out of the join, so that they do not meet in one task.
    given = F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    with_id = marked.where("doc_id IS NOT NULL").join(known, "doc_id", "left").select("part", "mask", *given)
    without = marked.where("doc_id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return stored(with_id.unionByName(without), "audit-masks")


def _bytes(numbers: list[int]) -> list[bytes]:
    return [n.to_bytes(-(-n.bit_length() // 8), "little") for n in numbers]


def _batch(sums: dict[str, list[int]]) -> pa.RecordBatch:
    out = {"part": pa.array(list(sums), pa.string())}
    packed_sums = [_bytes(s) for s in sums.values()]
    return pa.RecordBatch.from_pydict(out | {c: pa.array([b[i] for b in packed_sums], pa.binary()) for i, c in enumerate(COUNTERS)})


SUMS_SCHEMA = "part string, " + ", ".join(f"{c} binary" for c in COUNTERS)


def _count(width: int):
    """Sums over a task's documents, by part."""
    numbers = packed(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = {}
        for batch in batches:
            parts = batch.column("part").dictionary_encode()
            kind = np.asarray(parts.indices, dtype=np.int64)
            for name, values in (("mask", 32), ("good", 2), ("toxic", 2)):
                kind = kind * values + np.asarray(batch.column(name), dtype=np.int64)
            for k, n in zip(*(a.tolist() for a in np.unique(kind, return_counts=True)), strict=True):
                p, mask, good, toxic = k >> 7, k >> 2 & 31, k >> 1 & 1, k & 1
                s = sums.setdefault(parts.dictionary[p].as_py(), [0] * len(COUNTERS))
                kept, removed, redundant, unique = numbers[mask]
                for i, number in enumerate((kept, removed, redundant, unique, removed * good, removed * toxic)):
                    s[i] += n * number
            if len(sums) > PARTS_HELD:
                yield _batch(sums)
                sums = {}
        yield _batch(sums)

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of sums, by part; rows of a part come one after the other."""
    part, s = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in COUNTERS]
        for at, p in enumerate(batch.column("part").to_pylist()):
            if p != part:
                if part is not None:
                    yield _batch({part: s})
                part, s = p, [0] * len(COUNTERS)
            for i, c in enumerate(columns):
                s[i] += int.from_bytes(c[at], "little")
    if part is not None:
        yield _batch({part: s})


def _unpack(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                counts = {c: unpacked(int.from_bytes(r[c], "little"), width) for c in COUNTERS}
                in_all = dict.fromkeys(FILTERS, 0)
                for (order, step), n in zip(STEPS, counts["removed"], strict=True):
                    in_all[order[step]] += n
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([r["part"]] * len(STEPS)), "filter_order": pa.array([o for o, _ in STEPS]),
                    "step": pa.array([s + 1 for _, s in STEPS], pa.int32()),
                    **{c: pa.array(counts[c], pa.int64()) for c in COUNTERS},
                    "shapley": pa.array([in_all[o[s]] for o, s in STEPS], pa.int64())})

    return run


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of what five filters do to ``docs`` (doc_id, text, lang) in all 120 orders, for each lang.

    A document fails A with under 100 words, B with under 80% distinct words, C with over 10% capitals
    A to Z, D with any of #$%&*|, and E when a smaller doc_id has the identical text.
    Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley, 600 rows for each part, zeros included. ``labels`` is (doc_id, quality, toxic).

    A NULL text is the empty one: it fails A and, of its kind, all but the smallest ids fail E. A NULL lang is
    the part of the empty string. A NULL id is larger than all others and has no label; rows that
    repeat id and text do not fail E by each other. A document labelled more than once is good, or toxic, if any
    of its labels says so. An empty table has no parts and gives no rows.
    """
    rows = masks(docs, labels)
    width = max(1, rows.count().bit_length())  # no field can exceed the number of documents
    sums = stored(rows.mapInArrow(_count(width), SUMS_SCHEMA).withColumn("lane", F.spark_partition_id() % FAN), "audit-sums")
    # A part's sums are added up in lanes first, so that no task reads those of all tasks.
    lanes = sums.repartition("part", "lane").sortWithinPartitions("part").drop("lane").mapInArrow(_add, SUMS_SCHEMA)
    whole = lanes.repartition("part").sortWithinPartitions("part").mapInArrow(_add, SUMS_SCHEMA)
    return whole.mapInArrow(_unpack(width), "part string, filter_order string, step int, "
                           + ", ".join(f"{c} long" for c in (*COUNTERS, "shapley")))


def _audit_sql() -> str:
    fails = " UNION ALL ".join(f"SELECT '{f}' AS f, {1 << i} AS bit" for i, f in enumerate(FILTERS))
    fields = ", ".join(f"{c}::BIGINT AS {c}" for c in COUNTERS)
    return rf"""
WITH letter AS ({fails}),
seq AS (  -- every way to put the letters in order, with the bits of those before each step
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order,
         [0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, a.bit + b.bit + c.bit + d.bit] AS before,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, s AS step, before[s] AS before, bits[s] AS bit FROM seq, range(1, 6) r(s)),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^ 	-]+') AS words,
             min(doc_id) OVER (PARTITION BY text) AS first FROM t),
m AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < {FEWEST_WORDS} THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {CAPITAL_PERCENT} * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '{MARKS}') THEN 8 ELSE 0 END
         + CASE WHEN first IS NOT NULL AND coalesce(doc_id > first, TRUE) THEN 16 ELSE 0 END AS mask FROM w),
k AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
h AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
      FROM m LEFT JOIN k USING (doc_id) GROUP BY part, mask),
c AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE mask & before > 0 AND mask & bit > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM h, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, {fields},
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM c
"""


AUDIT_SQL = _audit_sql()
