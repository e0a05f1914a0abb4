"""Benchmark decontamination: a hash set of test n-grams scanned over documents.

Benchmark texts are normalised to words; every window of ten words (the whole
item if it has fewer) goes into a hash set. Documents are scanned whole: words
become integer ids of the benchmark's own vocabulary, windows a rolling hash of
ids, and each hash hit is verified id by id. A word that no item has breaks a
window at once, so most text costs one dictionary look-up a word.

The set is broadcast in parts of at most ``PART_WORDS`` benchmark words each: one
part for any usual benchmark, and as many scans as parts for a larger one, whose
hits are then merged by document. A task never holds more than one part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import passing, slices, stored

WINDOW = 10
#: Benchmark words in one broadcast part (about 100 bytes each in a task).
PART_WORDS = 1_000_000

# [^\x00-\x2F\x3A-\x60\x7B-\x7F] on UTF-8 bytes, A-Z lower-cased: digits, a-z and all non-ASCII.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Windows:
    """The windows of one part of the benchmark."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.by_length: dict[int, dict[tuple, list[int]]] = {}
        self.ids = ["" if i is None else str(i) for i, _ in items]
        for k, (_, text) in enumerate(items):
            words = words_of(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            n = min(WINDOW, len(ids))
            for at in range(len(ids) - n + 1 if n else 0):
                held = self.by_length.setdefault(n, {}).setdefault(tuple(ids[at:at + n]), [])
                if not held or held[-1] != k:
                    held.append(k)
        self.hashes = {n: np.sort(self._hash(np.array(list(found), dtype=np.int64).ravel(), n)[::n])
                       for n, found in self.by_length.items()}

    @staticmethod
    def _hash(ids: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
        for k in range(n):
            out = out * _FACTOR + ids[k:len(ids) - n + 1 + k].astype(np.uint64) + np.uint64(1)
        return out ^ (out >> np.uint64(29))

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, merged hit spans of words, and the items that hit."""
        words = words_of(text)
        total = len(words)
        known = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=total)
        breaks = np.flatnonzero(known < 0)
        hit, items = [], set()
        for n, table in self.by_length.items():
            if total < n:
                continue
            # A window from p is whole if no unknown word lies in [p, p + n).
            ahead = np.searchsorted(breaks, np.arange(total - n + 1))
            free = np.append(breaks, total + n)[ahead] >= np.arange(total - n + 1) + n
            if not free.any():
                continue
            h = self._hash(known, n)
            at = np.searchsorted(self.hashes[n], h)
            at[at == len(self.hashes[n])] = 0
            for p in np.flatnonzero(free & (self.hashes[n][at] == h)):
                found = table.get(tuple(known[p:p + n].tolist()))
                if found:
                    items.update(found)
                    hit.append((int(p), int(p) + n))
        spans: list[tuple[int, int]] = []
        for s, e in sorted(hit):
            if spans and s <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
            else:
                spans.append((s, e))
        return total, spans, items


_FOUND = "n_words long, spans array<struct<s:long,e:long>>, items array<string>"


def _scan(keep: list[str], packed) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Windows(packed.value)
        for batch in slices(batches):
            n_words, spans, items = [], [], []
            for text in batch.column("_scan").to_pylist():
                n, s, i = part.scan(text or b"")
                n_words.append(n)
                spans.append([{"s": a, "e": b} for a, b in s])
                items.append(sorted({part.ids[k] for k in i}))
            span = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            cols = {c: batch.column(c) for c in keep}
            yield pa.RecordBatch.from_pydict({
                **cols, "n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, span),
                "items": pa.array(items, pa.list_(pa.string()))})
    return run


def _parts(benchmark: DataFrame, part_words: int) -> Iterator[list[tuple[object, bytes]]]:
    """Benchmark items in parts of about ``part_words`` words, each read when it is asked for.

    A longer item comes in pieces of its words that overlap by all but one word of a window.
    """
    part, size, step = [], 0, max(part_words, WINDOW)
    for r in benchmark.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        text = bytes(r.text or b"")
        words = words_of(text)
        pieces = [text] if len(words) <= step else (
            b" ".join(words[at:at + step + WINDOW - 1]) for at in range(0, len(words) - WINDOW + 1, step))
        for piece in pieces:
            part.append((r.item_id, piece))
            size += min(len(words), step)
            if size >= part_words:
                yield part
                part, size = [], 0
    if part:
        yield part


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str],
                       part_words: int = PART_WORDS) -> DataFrame:
    """``keep`` columns of ``docs`` plus n_words, spans (hit word ranges, merged)
    and items (ids of items with an occurring window, sorted as strings).

    NULL and empty texts have no words and no hits; NULL and wordless items have
    no windows. Repeated item_ids count once; a NULL item_id counts as the id ''. An
    empty benchmark hits nothing. Rows are independent: repeated rows, tied or NULL
    doc_ids each get a row of their own.
    """
    spark = docs.sparkSession
    rows = docs.select(*keep, F.col("text").cast("binary").alias("_scan"))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", " + _FOUND
    parts = _parts(benchmark, part_words)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        return rows.mapInArrow(_scan(keep, spark.sparkContext.broadcast(first)), schema)
    # More than one part: scan rows with an id of their own once for each part, then merge.
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "decontaminate-rows")
    every, ahead = None, [second, first]
    del first, second
    while part := ahead.pop() if ahead else next(parts, None):
        packed = spark.sparkContext.broadcast(part)
        del part
        found = stored(rows.mapInArrow(_scan([*keep, "_row"], packed),
                                       schema.replace(", " + _FOUND, ", _row long, " + _FOUND))
                       .select("_row", "n_words", "spans", "items"), "decontaminate-part")
        packed.destroy()
        every = found if every is None else every.unionByName(found)
    words = F.array_distinct(F.flatten(F.transform(
        F.flatten(F.collect_list("spans")), lambda x: F.sequence(x.s, x.e - 1))))
    merged = every.groupBy("_row").agg(
        F.max("n_words").alias("n_words"), F.transform(words, lambda p: F.struct(p.alias("s"), (p + 1).alias("e")))
        .alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return rows.drop("_scan").join(merged, "_row").select(*keep, "n_words", "spans", "items")


def contamination_report(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_contamination(docs, benchmark, ["doc_id"], part_words)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x.e - x.s)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark window."""
    plain, names = passing(docs)
    found = find_contamination(plain, benchmark, list(names), part_words)
    return found.where(F.size("spans") == 0).select(*(F.col(n).alias(c) for n, c in names.items()))
