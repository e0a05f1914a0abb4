"""Sharding: longest-processing-time scheduling of groups that stay together.

Groups (rows with equal text) are sorted by size and each goes to the least
loaded shard, taken from a heap. The schedule needs only how many groups have
each size, not the groups: groups of one size are interchangeable, so the heap
runs over *size classes*. Distinct sizes number at most ``sqrt(2 * total bytes)``
and in practice a few hundred thousand, whatever the number of documents.
Within a class the plan says how many groups go to each shard; a group finds
its place by its rank among the groups of its size. Ranks and slots come from
windows over hash buckets plus offsets from small per-bucket counts, so that no
task holds a whole size class or shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import stored

#: Rows that one window partition should hold at most, on average.
ROWS_PER_BUCKET = 100_000


def lpt(classes: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """For each ``(size, groups)``, largest size first, the groups each shard takes.

    The heap holds ``(load, shard)``. A shard with load ``l`` comes to its top with
    loads ``l, l + size, l + 2 size, ...``, so the ``n`` groups of a class take the
    ``n`` smallest of these (load, shard) pairs. All pairs below a load, found by
    bisection, are taken at once and the heap deals out the rest one by one: the
    same schedule as popping the heap ``n`` times, at a cost independent of ``n``.
    """
    heap = [(0, s) for s in range(shards)]
    out = []
    for size, n in classes:
        took = [0] * shards
        if n > 2 * shards:
            lo, hi = heap[0][0], max(heap)[0] + n * size
            below = lambda load: sum(max(0, -(-(load - x) // size)) for x, _ in heap)  # noqa: B023, E731
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if below(mid) <= n else (lo, mid)
            bulk = {s: max(0, -(-(lo - x) // size)) for x, s in heap}
            heap = [(x + bulk[s] * size, s) for x, s in heap]
            heapq.heapify(heap)
            took = [bulk[s] for s in range(shards)]
            n -= sum(took)
        for _ in range(n):
            load, s = heapq.heappop(heap)
            heapq.heappush(heap, (load + size, s))
            took[s] += 1
        out.append(took)
    return out


def _buckets(rows: int) -> int:
    return max(16, -(-rows // ROWS_PER_BUCKET))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Give each row of ``docs`` (doc_id, text) a shard and a slot in it.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law
    ('bytes'), shard, slot and grown_shard (NULL under this law).

    A NULL text has size 1 and no checksum; all NULL texts form one group, and
    all empty texts another. Rows with equal text, repeated rows included, share
    a shard and each gets its own slot. Ties between groups of one size are
    broken by text hash. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    # The key of a text is its SHA-256, NULL as a group of its own.
    rows = stored(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.unhex(F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))).alias("key")), "shard-rows")
    total = rows.count()
    buckets = _buckets(total)

    groups = (rows.groupBy("key").agg(F.max("size").alias("each"), F.count("*").alias("n"))
              .select("key", (F.col("each") * F.col("n")).alias("weight"),
                      F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("b")))
    groups = stored(groups, "shard-groups")
    cells = groups.groupBy("weight", "b").agg(F.count("*").alias("n"))
    classes = (cells.groupBy("weight").agg(F.sum("n").alias("n")).orderBy(F.desc("weight")))
    sizes = [(r.weight, r.n) for r in classes.toLocalIterator()]
    plan = lpt(sizes, shards)
    # Shard s of a class takes the ranks [ends[s-1], ends[s]).
    ends = []
    for (weight, _), took in zip(sizes, plan, strict=True):
        e, at = [], 0
        for t in took:
            at += t
            e.append(at)
        ends.append((weight, e))
    plan_df = spark.createDataFrame(ends, "weight long, ends array<long>")
    before = Window.partitionBy("weight").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("from_rank", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("weight", "b").orderBy("key")) - 1
    placed = (groups.withColumn("rank", rank)
              .join(starts, ["weight", "b"]).join(plan_df, "weight")
              .select("key", F.size(F.filter("ends", lambda e: e <= F.col("from_rank") + F.col("rank")))
                      .alias("shard")))
    out = stored(rows.join(placed, "key")
                 .withColumn("b", F.pmod(F.xxhash64("doc_id", "key"), F.lit(buckets))).drop("key"), "shard-placed")
    counts = out.groupBy("shard", "b").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("from_slot", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("shard", "b").orderBy("doc_id", "text_crc32")) - 1
    return (out.withColumn("within", within).join(offsets, ["shard", "b"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                    (F.col("from_slot") + F.col("within")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
