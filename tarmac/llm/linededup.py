"""Line dedup: repeated windows of three consecutive lines, kept once.

Every three consecutive lines of a document are hashed to 128 bits. A window
that occurs more than once in the corpus keeps its first occurrence, by
(doc_id, place); the lines of all later ones are covered, overlapping windows
merge, and covered lines are removed. DataFrame functions only: documents are
rewritten from an array of covered places, and only hashes are shuffled to find
repeats. Counting combines on the map side, and the join that finds later
occurrences is a plain equi-join, so a window that a third of all documents
share is split by the engine's skew handling rather than met in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored

LINES_PER_WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated three-line passages removed from ``text``.

    Adds ``n_lines`` and ``n_removed`` (long); every other column, whatever its
    name, is kept as it is (an input column of those two names is replaced).

    Lines are compared byte by byte; a window of blank lines alone is never a
    repeat. Texts of fewer than three lines, empty and NULL texts are unchanged
    (a NULL text has 0 lines). Rows that repeat both doc_id and text are one
    document: they are treated alike and never repeat each other. Rows that share
    a doc_id only, NULL ids included, are ordered by a hash of their text. An
    occurrence that overlaps the first one of the same window is a later one. Every
    removed line survives where its window first occurs. A document whose
    lines are all covered keeps its row with an empty text.
    """
    me = {"__doc": F.col("doc_id"), "__text": F.xxhash64("text")}
    windows = docs.where(F.col("text").contains("\n")).select(
        F.struct(F.col("doc_id").alias("doc"), me["__text"].alias("text")).alias("row"),
        _lines(F.col("text")).alias("l"))
    at = F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("l") - (LINES_PER_WINDOW - 1)),
        lambda i: F.when(
            F.length(F.trim(F.concat(*(F.element_at("l", i + k) for k in range(LINES_PER_WINDOW))))) > 0,
            F.struct(F.xxhash64(*(F.element_at("l", i + k) for k in range(LINES_PER_WINDOW))).alias("a"),
                     F.xxhash64(F.lit("2"), *(F.element_at("l", i + k) for k in range(LINES_PER_WINDOW)))
                     .alias("b"))))).alias("pos", "h")
    found = (windows.where(F.size("l") >= LINES_PER_WINDOW).select("row", at).where("h IS NOT NULL")
             .select(F.col("h.a").alias("a"), F.col("h.b").alias("b"), F.struct("row", "pos").alias("place")))
    found = stored(found, "line-windows")
    repeats = (found.groupBy("a", "b").agg(F.min("place").alias("first"), F.max("place").alias("last"))
               .where("first < last").select("a", "b", "first"))
    later = found.join(repeats, ["a", "b"]).where(F.col("place") > F.col("first"))
    # At most as many places as the document has lines.
    covered = (later.groupBy(F.col("place.row").alias("row"))
               .agg(F.sort_array(F.collect_set("place.pos")).alias("__starts"))
               .select(F.col("row.doc").alias("__doc"), F.col("row.text").alias("__text"), "__starts"))
    rows = docs.withColumns(me)
    on = [rows["__doc"].eqNullSafe(covered["__doc"]), rows["__text"] == covered["__text"]]
    joined = rows.join(covered, on, "left").drop("__doc", "__text")
    gone = F.array_distinct(F.flatten(F.transform(
        "__starts", lambda i: F.sequence(i, i + (LINES_PER_WINDOW - 1)))))
    return (joined.withColumn("__gone", gone).withColumns({
        "n_lines": F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"),
        "text": F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(
            F.filter(_lines(F.col("text")), lambda _, i: ~F.array_contains("__gone", i)), "\n")),
    }).drop("__starts", "__gone"))


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
win AS (
  SELECT doc_id, i - 1 AS pos, l[i : i + 2] AS w
  FROM lines, UNNEST(range(1, len(l) - 1)) AS r(i)
  WHERE len(l) >= 3 AND trim(l[i] || l[i + 1] || l[i + 2]) <> ''),
firsts AS (
  SELECT w, min({'d': doc_id, 'p': pos}) AS first FROM win GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, pos + k AS p
  FROM win JOIN firsts USING (w), UNNEST(range(0, 3)) AS s(k)
  WHERE {'d': doc_id, 'p': pos} > first),
numbered AS (
  SELECT doc_id, i - 1 AS p, l[i] AS line FROM lines, UNNEST(range(1, len(l) + 1)) AS r(i)),
kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.p) AS t
  FROM numbered n ANTI JOIN gone g ON n.doc_id = g.doc_id AND n.p = g.p GROUP BY n.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.l), 0)::BIGINT AS n_lines, coalesce(lost.n, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.t, '') END AS text
FROM lines d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN lost ON d.doc_id = lost.doc_id
"""
