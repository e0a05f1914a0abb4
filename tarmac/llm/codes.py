"""Vector code compression: product quantisation with Orchard's nearest-entry search.

Each vector is cut into equal parts and each part is replaced by the index of its nearest
entry in the codebook of that position. The nearest entry is found by Orchard search:
every entry keeps a list of all entries by their distance from it. A search walks the
list of the best entry so far; when it finds a better entry it goes on in that one's
list, and entries met before are marked and passed over. It ends at an entry that is
more than twice the best distance away from the list's owner: by the triangle inequality
neither that one nor any after it can be nearer. Equal distances are still met, so
ties go to the lower index, as a full search would have it.

All parts of a block of rows are searched at once in numpy. A training round is one pass over
the table in which every task adds up its own parts; at most parts x entries x part width
sums, combined by Spark, reach the driver. Components are whole numbers and all
arithmetic is exact, so results do not depend on order or partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fits_broadcast, stored

SCALE = 4096
#: Whole-number components are held within this, |x| <= 4096 before scaling, so that squared distances fit 64 bits.
LIMIT = 1 << 24
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Vectors searched at once.
BLOCK = 2048
#: Labels with a sum each that are broadcast at most.
BROADCAST_LABELS = 500_000
LONG_MAX = (1 << 63) - 1


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For codebooks (parts, entries, width): each entry's other entries by distance, nearest
    first and ties by index, and the squared distances along that list."""
    gap = book[:, :, None, :] - book[:, None, :, :]
    square = np.einsum("pefw,pefw->pef", gap, gap)
    own = np.eye(book.shape[1], dtype=bool)
    order = np.argsort(np.where(own, -1, square), axis=2, kind="stable")[:, :, 1:]  # the owner itself comes first
    return order, np.take_along_axis(square, order, axis=2)


def orchard(vectors: np.ndarray, book: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """For ``vectors`` (n, parts, width), each part's nearest entry, its squared distance, and
    the number of distances computed."""
    n, parts, width = vectors.shape
    entries = book.shape[1]
    order, along = lists
    x = vectors.reshape(n * parts, width)
    part = np.tile(np.arange(parts), n)

    def square(rows, entry):
        gap = x[rows] - book[part[rows], entry]
        return np.einsum("rw,rw->r", gap, gap)

    # Begin at the entry whose first component is nearest.
    best = np.zeros(n * parts, dtype=np.int64)
    if width:
        for p in range(parts):
            by_first = np.argsort(book[p, :, 0], kind="stable")
            at = np.searchsorted(book[p, by_first, 0], vectors[:, p, 0])
            best[p::parts] = by_first[np.minimum(at, entries - 1)]
    rows = np.arange(n * parts)
    dist = square(rows, best)
    marked = np.zeros((n * parts, entries), dtype=bool)
    marked[rows, best] = True
    owner, place, computed = best.copy(), np.zeros(n * parts, dtype=np.int64), len(rows)
    if entries == 1:
        rows = rows[:0]
    while len(rows):
        o, at = owner[rows], place[rows]
        entry = order[part[rows], o, at]
        # Beyond twice the distance from x to the owner, that is four times the squared one, the walk ends.
        on = along[part[rows], o, at] <= 4 * dist[rows]
        rows, entry = rows[on], entry[on]
        place[rows] += 1
        new = ~marked[rows, entry]
        met, entry = rows[new], entry[new]
        marked[met, entry] = True
        d = square(met, entry)
        computed += len(met)
        tie = (d == dist[met]) & (entry < best[met])
        nearer = d < dist[met]
        best[met] = np.where(nearer | tie, entry, best[met])
        # A tie keeps the owner's list: it is as near as the new entry.
        jump = met[nearer]
        dist[jump], owner[jump], place[jump] = d[nearer], entry[nearer], 0
        rows = rows[place[rows] < entries - 1]
    return best.reshape(n, parts), dist.reshape(n, parts), computed


def _blocks(batch: pa.RecordBatch, dim: int, parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows that hold a whole vector, with their scaled components (n, parts, width)."""
    for at in range(0, batch.num_rows, BLOCK):
        rows = batch.slice(at, BLOCK)
        out = np.zeros((rows.num_rows, dim), dtype=np.int64)
        v = rows.column("vector")
        lengths = np.asarray(v.value_lengths().fill_null(0), dtype=np.int64)
        flat = np.asarray(v.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
        row = np.repeat(np.arange(rows.num_rows), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[row, place] = np.floor(np.clip(flat, -LIMIT / SCALE, LIMIT / SCALE) * SCALE).astype(np.int64)
        yield rows, out.reshape(rows.num_rows, parts, dim // parts)


def _whole(v: str):
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(v).isNotNull() & F.forall(v, fine)


def _pass(vectors: DataFrame, book: np.ndarray, final: bool) -> DataFrame:
    """One pass of searches: the sums and counts of every entry's parts, or the codes when ``final``."""
    parts, entries, width = book.shape
    lists = neighbour_lists(book)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(book.shape, dtype=np.int64)
        count = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for _, x in _blocks(batch, parts * width, parts):
                code, _, _ = orchard(x, book, lists)
                for p in range(parts):
                    np.add.at(total[p], code[:, p], x[:, p])
                    count[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(count[p, e]),
            "total": pa.array(list(total[p, e]), pa.list_(pa.int64()))})

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _blocks(batch, parts * width, parts):
                code, dist, _ = orchard(x, book, lists)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": rows.column("vec_id"), "label": rows.column("label"),
                    "code": pa.array([bytes(c).hex() for c in code.astype(np.uint8)], pa.string()),
                    "error": pa.array(dist.sum(axis=1))})

    if final:
        kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
        return vectors.mapInArrow(codes, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return vectors.mapInArrow(sums, "part int, entry int, n long, total array<bigint>")


def train_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) after ``rounds`` passes over whole ``vectors`` (vec_id, vector)."""
    dim = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    dim = -(-dim // parts) * parts
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    book = np.concatenate([x for b in first.to_batches() for _, x in _blocks(b, dim, parts)]).transpose(1, 0, 2)
    for _ in range(rounds):
        sums = (_pass(vectors, book, final=False).select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
                .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")))
        book = book.copy()
        for r in sums.toLocalIterator():  # parts x entries x width numbers at most
            book[r.part, r.entry, r.at] = r.x // r.n
    return book


def codebooks_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in book.ravel().tolist()).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of ``vectors`` (vec_id, embedding, label): vec_id, code, error, label_error, codebooks_sha256.

    A component x becomes floor(4096 * x). Codebooks begin as the parts of the vectors with the smallest
    vec_ids (as many as there are, if fewer than ``entries``); every round assigns all parts
    and replaces each used entry by the floor of its parts' mean. ``code`` is two hex digits a part,
    ``error`` the squared distance, ``label_error`` its sum over rows of equal label, NULLs together.

    Vectors that are NULL or hold NULL or non-finite components are dropped. Components beyond
    +-4096 count as +-4096. Shorter vectors, empty ones included, count as if filled up with zeros to the
    longest, and its length is rounded up to a multiple of ``parts``. NULL ids come after all others; rows that repeat
    an id are vectors of their own, by their components in order. A label's sum beyond 64 bits is the
    largest long. An empty table gives an empty result.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be between 1 and 256: a code has two hex digits a part")
    kept = vectors.where(_whole("embedding")).select("vec_id", "label", F.col("embedding").alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    if kept.isEmpty():
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    book = train_codebooks(kept, parts, entries, rounds)
    coded = stored(_pass(kept, book, final=True), "vector-codes")
    # NULL as a label of its own; a label may hold any share of the rows, so it is summed before it is joined.
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    sums = coded.groupBy(key.alias("_key")).agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("_sum"))
    sums = stored(sums.withColumn("label_error", F.least("_sum", F.lit(LONG_MAX).cast("decimal(20,0)")).cast("long"))
                  .drop("_sum"), "vector-labels")
    return (coded.withColumn("_key", key).join(fits_broadcast(sums, BROADCAST_LABELS), "_key")
            .select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(book)).alias("codebooks_sha256")))


def _round_sql(r: int) -> str:
    """One round in SQL: parts nearest to entries, then the entries' means. Table parts, books b0, b1, ..."""
    return f"""
near{r} AS MATERIALIZED ({_near_sql(f"b{r}")}),
mean{r} AS (
  SELECT part, entry, list(m ORDER BY pos) AS e
  FROM (SELECT n.part, n.entry, pos, floor(sum(x)::HUGEINT::DOUBLE / count(*))::BIGINT AS m
        FROM near{r} n JOIN (SELECT row, part, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM parts) p
          ON n.row = p.row AND n.part = p.part GROUP BY 1, 2, 3) GROUP BY 1, 2),
b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM b{r} b LEFT JOIN mean{r} m ON b.part = m.part AND b.entry = m.entry)"""


def _near_sql(book: str) -> str:
    return f"""
  SELECT row, part, entry, d FROM (
    SELECT p.row, p.part, b.entry,
           list_sum(list_transform(list_zip(p.v, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts p JOIN {book} b ON p.part = b.part)
  QUALIFY row_number() OVER (PARTITION BY row, part ORDER BY d, entry) = 1"""


CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT row, i AS part, q[i * len(q) // {PARTS} + 1 : (i + 1) * len(q) // {PARTS}] AS v FROM kept, range({PARTS}) r(i)),
b0 AS MATERIALIZED (SELECT part, row AS entry, v AS e FROM parts WHERE row < {ENTRIES}),
{",".join(_round_sql(r) for r in range(ROUNDS))},
last AS MATERIALIZED ({_near_sql(f"b{ROUNDS}")}),
codes AS (SELECT row, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last GROUP BY row),
digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (row), digest
"""
