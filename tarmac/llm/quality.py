"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Terms are hashed character trigrams, four-character shapes (case, digits, marks) and
repeats. Their document frequencies are counted over all documents, a truncated
singular value decomposition of the labelled sample gives the latent space, and the
labelled vectors are broadcast (``EXAMPLES`` x ``RANK`` numbers, whatever the corpus).
Every document's cosines to all of them are exact products, block by block; its score
is the mean label of the nearest ones, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import is_held_out, slices, stored
from tarmac.llm.sample import labelled_sample

#: Bound of the labelled sample, latent dimensions, voters and documents in a block.
EXAMPLES = 6000
RANK = 48
VOTERS = 15
BLOCK = 256
#: Similarity is raised to this power as a neighbour's weight.
SHARPNESS = 8.0
THRESHOLD = 0.3

BITS = 11
TERMS = 2 * (1 << BITS) + 3  # trigrams, shapes, three kinds of repeat

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SHAPES = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
                for c in range(256))


def _hashed(b: np.ndarray, n: int) -> np.ndarray:
    code = np.zeros(max(0, len(b) - n + 1), dtype=np.uint32)
    for k in range(n):
        code |= b[k:len(b) - n + 1 + k].astype(np.uint32) << np.uint32(8 * k)
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def term_counts(text: str | None) -> np.ndarray:
    """Counts of the ``TERMS`` hashed terms of a whole text."""
    out = np.zeros(TERMS, dtype=np.float32)
    data = (text or "").encode()
    words = data.split()
    if not words:
        return out
    letters = np.frombuffer(b" " + b" ".join(data.translate(_LETTERS).split()) + b" ", dtype=np.uint8)
    n = 1 << BITS
    out[:n] = np.bincount(_hashed(letters, 3), minlength=n)
    out[n:2 * n] = np.bincount(_hashed(np.frombuffer(b" ".join(words).translate(_SHAPES), dtype=np.uint8), 4),
                               minlength=n)
    lines = data.split(b"\n")
    out[2 * n] = sum(map(bytes.__eq__, words, words[1:]))
    out[2 * n + 1] = len(words) - len(set(words))
    out[2 * n + 2] = len(lines) - len(set(lines))
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length: root of the relative frequency within each kind of term, times ``idf``."""
    n = 1 << BITS
    out = np.empty_like(counts)
    for a, b in ((0, n), (n, 2 * n), (2 * n, TERMS)):
        total = counts[:, a:b].sum(axis=1) if a < 2 * n else counts[:, :n].sum(axis=1)
        out[:, a:b] = np.sqrt(counts[:, a:b] / np.maximum(total, 1)[:, None])
    out *= idf
    return out / np.maximum(np.linalg.norm(out, axis=1), 1e-12)[:, None]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(TERMS, dtype=np.int64), 0
    for batch in slices(batches):
        for text in batch.column(0).to_pylist():
            df += term_counts(text) > 0
            docs += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1, dtype=np.int32)),
                                      pa.array(np.append(df, docs))], names=["term", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of every term over all rows of ``docs``."""
    n = np.zeros(TERMS + 1)
    counted = docs.select("text").mapInArrow(_frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # one row a term
        n[r.term] = r.n
    return np.log1p(n[-1] / (1 + n[:-1])).astype(np.float32)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [term_counts(t) for t in batch.column("text").to_pylist()]
        bins = [np.flatnonzero(r).astype("<i4") for r in rows]
        yield pa.RecordBatch.from_arrays([
            batch.column("label").cast(pa.int32()), pa.array([b.tobytes() for b in bins], pa.binary()),
            pa.array([r[b].astype("<f4").tobytes() for r, b in zip(rows, bins, strict=True)], pa.binary())],
            names=["label", "bins", "counts"])


class Voters:
    """Labelled vectors in the latent space; a plain object that tasks can hold."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, idf: np.ndarray, rank: int, voters: int):
        self.idf, self.labels, self.voters = idf, labels.astype(np.float32), voters
        self.prior = float(labels.mean()) if len(labels) else 0.5
        x = weighted(counts, idf)
        self.basis = latent_basis(x, rank)
        self.vectors = self._unit(x @ self.basis)

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Weighted votes of the nearest examples.

        Among equal cosines at the last voter any may vote. Cosines are in single precision, whose last bits
        depend on the block a text is in, so that scores of equal texts may differ by some 1e-7.
        """
        if not len(self.labels) or not texts:
            return np.full(len(texts), self.prior)
        counts = np.stack([term_counts(t) for t in texts])
        blank = counts.sum(axis=1) == 0
        cos = self._unit(weighted(counts, self.idf) @ self.basis) @ self.vectors.T
        k = min(self.voters, cos.shape[1])
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cos, near, axis=1), 0).astype(np.float64) ** SHARPNESS
        # One vote's worth of the base rate keeps far neighbours from deciding alone.
        votes = (weight * self.labels[near]).sum(axis=1) + 1e-3 * self.prior
        return np.where(blank, self.prior, np.clip(votes / (weight.sum(axis=1) + 1e-3), 0, 1))


def latent_basis(x: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors of ``x`` by subspace iteration."""
    rank = min(rank, *x.shape) if x.size else rank
    q = np.random.default_rng(0).standard_normal((x.shape[1], min(x.shape[1], rank + 8))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ vt.T)[:, :rank]).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, rank: int = RANK,
        voters: int = VOTERS) -> Voters:
    """Voters from at most ``examples`` labelled documents and all documents' term frequencies."""
    idf = inverse_frequencies(docs)
    found = (labelled_sample(docs, labels, "quality", examples)
             .mapInArrow(_examples, "label int, bins binary, counts binary").collect())
    found.sort(key=lambda r: (bytes(r.bins), bytes(r.counts), r.label))
    counts = np.zeros((len(found), TERMS), dtype=np.float32)
    for row, r in zip(counts, found, strict=True):
        row[np.frombuffer(r.bins, "<i4")] = np.frombuffer(r.counts, "<f4")
    return Voters(counts, np.array([r.label for r in found], dtype=np.float32), idf, rank, voters)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs`` (doc_id, text).

    NULL, empty and blank texts score the base rate of label 1 in the sample; without
    labelled rows every score is 0.5. Rows are independent: repeated rows and NULL ids
    (held out) each get a score, and an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK):
            scores = model.value.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", is_held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
