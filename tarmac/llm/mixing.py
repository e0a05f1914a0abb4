"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Sources share a budget of words by weight. A source takes at most ``max_epochs`` times
its own words; what it cannot take goes to the others by weight, until none is above.
The level of that water, words per unit of weight, only rises: every round is one
aggregate over the table of sources, and only its one row reaches the driver.

A source's target is ``whole`` repetitions of all its documents plus a remainder, which one
more repetition of some documents fills: documents stand in the order of a seeded hash,
and those up to the remainder are taken. A running total of words finds the place. It
is split by the hash into buckets, whose starts come from sums per bucket, so that
no task holds a source. All of it is DataFrame functions.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import fits_broadcast, stored

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
#: Sources that one range of the numbering, and rows that one bucket of the running totals, should hold on average.
SOURCES_PER_RANGE = 1_000_000
ROWS_PER_BUCKET = 100_000
#: Buckets that there are at least, so that a source is dealt to many tasks at any size.
LEAST_BUCKETS = 256
#: Sources (a key of some ten bytes and four numbers each) that are broadcast at most.
BROADCAST_SOURCES = 200_000
#: Weights that sources take in turn.
CYCLE = (5, 2, 1)


def source_key(source: Column | str) -> Column:
    """A source as text that is never NULL; in code point order, with NULL behind all others."""
    c = F.col(source) if isinstance(source, str) else source
    return F.coalesce(F.concat(F.lit("0"), c.cast("string")), F.lit("1"))


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """``sources`` (src, ...) with the weights of ``cycle`` given in turn, in the order of src.

    Numbered range by range: rows are dealt to ranges of src and written, each range is
    numbered by itself and starts where the ones before it end.
    """
    n = -(-sources.count() // SOURCES_PER_RANGE) or 1
    ranged = stored(sources.repartitionByRange(n, "src").withColumn("part", F.spark_partition_id()), "mix-ranges")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    place = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy("src")) - 1
    weights = F.array(*(F.lit(w) for w in cycle))
    return ranged.join(F.broadcast(starts), "part").withColumn(
        "weight", F.get(weights, (place % len(cycle)).cast("int")).cast("long")).drop("part", "start")


def _exact(n: int) -> Column:
    return F.lit(Decimal(n)).cast("decimal(38,0)")


def water_fill(sources: DataFrame, percent: int, max_epochs: int) -> DataFrame:
    """``sources`` (src, source_size, weight) with their ``target`` of words.

    The budget is ``percent`` of all words. Weights are positive whole numbers and all
    sums exact, so targets do not depend on order or partitioning. A source is clamped
    when its weight's share of the level would be above ``max_epochs`` times its size.
    If all are clamped, the budget is above what all can take and each takes its most.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level, before = Fraction(int(total) * percent, 100), Fraction(0), None
    cap = (F.col("source_size") * max_epochs).cast("decimal(38,0)")
    while level != before:
        full = cap * _exact(level.denominator) <= F.col("weight") * _exact(level.numerator)
        taken, weight = sources.agg(F.sum(F.when(full, F.col("source_size") * max_epochs)),
                                    F.sum(F.when(~full, F.col("weight")))).first()
        before = level
        level = (budget - (taken or 0)) / weight if weight else None
        if level is None:
            return sources.withColumn("target", F.when(F.col("weight") > 0, cap.cast("double")).otherwise(0.0))
    share = F.col("weight").cast("double") * F.lit(float(level.numerator)) / F.lit(float(level.denominator))
    return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(share))


def mix_sources(docs: DataFrame, percent: int = 150, max_epochs: int = 2, seed: str = SEED,
                weights: DataFrame | None = None) -> DataFrame:
    """The mix of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, copies, source.

    ``size`` is the number of words of the text, ``target`` the words that the source should
    give, ``copies`` how often the mix takes the whole document and ``taken`` the words
    of these copies. ``weights`` (source, weight: positive whole numbers) may give the weights;
    else sources by code point take 5, 2, 1 in turn. A source without a weight gives nothing.

    The words taken of a source differ from its target by at most half of its largest
    document. A NULL text has no words; NULL is a source of its own, behind all others.
    A source without words has target 0 and so does an empty table's sum; empty
    documents are then taken or not, with no words. Rows that repeat source, doc_id and
    size are one group, taken together. Results depend on the rows and the seed only.
    """
    rows = stored(docs.select(
        "doc_id", "source", source_key("source").alias("src"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "mix-rows")
    per_source = stored(rows.groupBy("src").agg(F.sum("size").alias("source_size")), "mix-sources")
    if weights is None:
        weighted = cycled_weights(per_source)
    else:
        given = weights.groupBy(source_key("source").alias("src")).agg(F.max("weight").cast("long").alias("weight"))
        weighted = per_source.join(given, "src", "left").withColumn("weight", F.coalesce("weight", F.lit(0)))
    targets = water_fill(stored(weighted, "mix-weights"), percent, max_epochs)
    size = F.col("source_size").cast("double")
    whole = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.floor(F.col("target") / size).cast("double"))
    plan = stored(targets.withColumn("whole", whole)
                  .withColumn("rest", F.col("target") - F.col("whole") * size)
                  .select("src", "source_size", "target", "whole", "rest"), "mix-plan")

    # Equal rows as one, in the order of a seeded hash within each source.
    buckets = max(LEAST_BUCKETS, -(-rows.count() // ROWS_PER_BUCKET))
    units = (rows.groupBy("src", "source", "doc_id", "size").agg(F.count("*").alias("n"))
             .withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                             F.lit(":"), F.col("size").cast("string"))))
             .withColumn("words", F.col("size") * F.col("n"))
             .withColumn("b", F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * buckets, 32)))
    units = stored(units, "mix-units")
    cells = units.groupBy("src", "b").agg(F.sum("words").alias("in_cell"))
    ahead = Window.partitionBy("src").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("start", F.coalesce(F.sum("in_cell").over(ahead), F.lit(0))).drop("in_cell")
    within = Window.partitionBy("src", "b").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (units.withColumn("within", F.coalesce(F.sum("words").over(within), F.lit(0)))
              .join(starts, ["src", "b"]).join(fits_broadcast(plan, BROADCAST_SOURCES), "src"))
    middle = (F.col("start") + F.col("within")).cast("double") + F.col("words").cast("double") / 2
    copies = (F.col("whole") + F.when(middle <= F.col("rest"), 1.0).otherwise(0.0)).cast("long")
    return (placed.withColumn("copies", copies)
            .withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                    "copies", "source"))


def mixed_documents(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """``docs`` with every row as often as ``mix`` (of :func:`mix_sources` on the same ``docs``) takes it.

    For tables whose doc_id is unique in its source; documents are told apart by both.
    """
    taken = mix.where("copies > 0").groupBy(F.col("doc_id").alias("_d"), source_key("source").alias("_s")) \
        .agg(F.max("copies").alias("_n"))
    return (docs.join(taken, (docs["doc_id"].eqNullSafe(taken["_d"])) & (source_key(docs["source"]) == taken["_s"]))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
            .select(*(docs[c] for c in docs.columns)))


MIX_SQL = rf"""
WITH r AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
-- In the order of size per weight, a source is clamped when its share of what is left would be above twice its size.
o AS (
  SELECT *, coalesce(sum(2 * source_size) OVER before, 0) AS caps, sum(weight) OVER after AS weights,
         sum(source_size) OVER () * 3 AS budget2
  FROM w WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                after AS (ORDER BY source_size::DOUBLE / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
c AS (SELECT *, 4 * source_size * weights <= (budget2 - 2 * caps) * weight AS clamped FROM o),
l AS (SELECT (max(budget2) - 2 * coalesce(sum(2 * source_size) FILTER (WHERE clamped), 0)) AS num,
             2 * sum(weight) FILTER (WHERE NOT clamped) AS den FROM c),
f AS (SELECT *, gcd(num::BIGINT, den::BIGINT) AS g FROM l),
t AS (SELECT source, source_size,
             CASE WHEN clamped THEN (2 * source_size)::DOUBLE ELSE weight::DOUBLE * (num // g)::DOUBLE / (den // g)::DOUBLE END AS target
      FROM c, f),
p AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size::DOUBLE) END AS whole FROM t),
h AS (SELECT *, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS h FROM r),
m AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY source, h) AS unit FROM h)
SELECT m.doc_id, m.size, p.source_size, p.target,
       (m.size * (p.whole + CASE WHEN upto - unit + unit::DOUBLE / 2 <= target - whole * source_size::DOUBLE THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m JOIN p ON m.source IS NOT DISTINCT FROM p.source
"""
