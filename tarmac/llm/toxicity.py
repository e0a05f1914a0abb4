"""Toxicity scores by a counterfactually regularised logistic classifier.

Features are the byte 5- and 6-grams of lower-cased words that a text holds, hashed;
the ones most associated with the label in the sample are kept. Besides the logistic
loss and a sparsity penalty, the fit penalises score changes between labelled
sentences and their counterfactuals, in which one identity term is swapped for another
of the same kind. A sentence without any gets one word swapped for an identity
term, so that the mere mention of a group moves no score either.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import is_held_out, slices, stored
from tarmac.llm.sample import labelled_sample

#: Bound of the labelled sample, kept features, and the penalties' weights.
EXAMPLES = 40_000
FEATURES = 2048
SPARSITY = 5e-5
FAIRNESS = 1.0
#: Weight of a toxic example against another.
BALANCE = 5.0
ROUNDS = 250
THRESHOLD = 0.5
BITS = 20

# Identity terms by kind.
IDENTITY = {
    "gender": ["women", "men", "girls", "boys", "transgender", "frauen", "männer", "mujeres", "hombres", "femmes",
               "hommes"],
    "religion": ["muslim", "jewish", "christian", "hindu", "buddhist", "atheist", "catholic", "muslime", "juden",
                 "christen", "musulmán", "judío", "cristiano", "musulman", "juif", "chrétien"],
    "origin": ["african", "asian", "european", "mexican", "american", "arab", "indian", "chinese", "black", "white",
               "latino", "migrants", "ausländer", "inmigrantes", "immigrés"],
    "orientation": ["gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"],
    "condition": ["deaf", "blind", "disabled", "autistic", "elderly", "young"],
}
_KIND = {t: k for k, terms in IDENTITY.items() for t in terms}
_TERM = re.compile(r"(?<!\w)(" + "|".join(sorted(_KIND, key=len, reverse=True)) + r")(?!\w)")

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def grams(text: str | None) -> np.ndarray:
    """Hashed 5- and 6-grams of the whole text, repeats included."""
    data = b" " + b" ".join((text or "").lower().encode().translate(_LETTERS).split()) + b" "
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
    out = []
    for n in (5, 6):
        code = np.zeros(max(0, len(b) - n + 1), dtype=np.uint64)
        for k in range(n):
            code |= b[k:max(0, len(b) - n + 1) + k] << np.uint64(8 * k)
        out.append((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
    return np.concatenate(out).astype(np.int64)


def counterfactuals(text: str) -> tuple[str, str] | None:
    """A sentence of the text and the same sentence with an identity term swapped, both in lower case.

    The choice is fixed by the text's checksum: among sentences with a term if there
    are any, else a word of some sentence gives way to a term.
    """
    pick = zlib.crc32(text.encode())
    # Lower case first: letters that only a case-insensitive search would match are no terms.
    sentences = [s for s in re.split(r"(?<=[.!?\n])\s+", text.lower()) if s.strip()]
    with_term = [s for s in sentences if _TERM.search(s)]
    if with_term:
        s = with_term[pick % len(with_term)]
        m = _TERM.search(s)
        others = [t for t in IDENTITY[_KIND[m[0]]] if t != m[0]]
        return s, s[:m.start()] + others[pick % len(others)] + s[m.end():]
    if not sentences:
        return None
    words = sentences[pick % len(sentences)].split()
    terms = sorted(_KIND)
    at = pick % len(words)
    return " ".join(words), " ".join([*words[:at], terms[pick % len(terms)], *words[at + 1:]])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, pos = np.zeros(1 << BITS, dtype=np.int32), np.zeros(1 << BITS, dtype=np.int32)
    for batch in slices(batches):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            g = np.unique(grams(text))
            n[g] += 1
            if label:
                pos[g] += 1
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(pos[used])],
                                     names=["gram", "n", "pos"])


def _kept_grams(sample: DataFrame, features: int) -> np.ndarray:
    """The ``features`` grams with the largest chi-square against the label and those of all identity terms."""
    total, pos = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    terms = [grams(t) for t in sorted(_KIND)]
    if not 0 < pos < total:
        return np.unique(np.concatenate(terms))
    expect = F.col("n") * (pos / total)
    chi = (F.col("pos") - expect) ** 2 / (expect * (1 - F.col("n") / total))
    best = (sample.mapInArrow(_gram_counts, "gram int, n int, pos int")
            .groupBy("gram").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).where((F.col("n") >= 3) & (F.col("n") < total))
            .select("gram", chi.alias("chi")).orderBy(F.desc("chi"), "gram").limit(features).collect())
    return np.unique(np.concatenate([np.array([r.gram for r in best], dtype=np.int64), *terms]))


def _examples(kept):
    """Each example and its counterfactual pair as places of the kept grams they hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _places(kept.value)
        for batch in slices(batches):
            cols: tuple[list, ...] = ([], [], [])
            for text in batch.column("text").to_pylist():
                pair = counterfactuals(text or "") or ("", "")
                for out, t in zip(cols, (text, *pair), strict=True):
                    at = place[grams(t)]
                    out.append(np.unique(at[at >= 0]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()),
                                              *(pa.array(x, pa.binary()) for x in cols)],
                                             names=["label", "own", "before", "after"])
    return run


def _places(kept: np.ndarray) -> np.ndarray:
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))
    return place


class _Rows:
    """Sparse 0/1 rows over kept grams, with the two products that fitting needs."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.col = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def back(self, e: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.col, weights=e[self.row], minlength=width)


def fit_weights(own: list[np.ndarray], before: list[np.ndarray], after: list[np.ndarray], y: np.ndarray, width: int,
                sparsity: float = SPARSITY, fairness: float = FAIRNESS, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights of ``width`` features and the intercept, by accelerated proximal gradient steps."""
    n, pos = len(y), float(y.sum())
    if n == 0 or pos in (0.0, float(n)):
        return np.zeros(width), 0.0 if n == 0 else (6.0 if pos else -6.0)
    x, a, b = _Rows(own), _Rows(before), _Rows(after)
    weight = np.where(y > 0, BALANCE, 1.0)
    weight /= weight.sum()

    def grad(w: np.ndarray, c: float) -> tuple[np.ndarray, float]:
        e = (1 / (1 + np.exp(-np.clip(x.times(w) + c, -30, 30))) - y) * weight
        d = (a.times(w) - b.times(w)) * (2 * fairness / n)
        return x.back(e, width) + a.back(d, width) - b.back(d, width), float(e.sum())

    # Steps are backed by a bound on the curvature along the features' own directions.
    v = np.ones(width)
    for _ in range(20):
        d = (a.times(v) - b.times(v)) * (2 * fairness / n)
        u = x.back(x.times(v) * weight / 4, width) + a.back(d, width) - b.back(d, width)
        top = float(np.linalg.norm(u))
        v = u / max(top, 1e-12)
    step = 1 / (1.1 * top + 0.25)
    w, c, t = np.zeros(width), float(np.log(pos / (n - pos))), 1.0
    wm, cm = w, c
    for _ in range(rounds):
        g, gc = grad(wm, cm)
        new = wm - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * sparsity, 0)
        new_c = cm - step * gc
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wm, cm = new + (t - 1) / nt * (new - w), new_c + (t - 1) / nt * (new_c - c)
        w, c, t = new, new_c, nt
    return w, c


class Classifier:
    """Grams with a weight, their weights and the intercept."""

    def __init__(self, kept: np.ndarray, w: np.ndarray, c: float):
        self.w, self.c = w[w != 0], c
        self.place = _places(kept[w != 0])

    def score(self, text: str | None) -> float:
        at = self.place[grams(text)]
        z = self.c + float(self.w[np.unique(at[at >= 0])].sum())
        return float(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, features: int = FEATURES) -> Classifier:
    """Fit on at most ``examples`` labelled documents; the driver holds which kept grams they have."""
    spark = docs.sparkSession
    sample = stored(labelled_sample(docs, labels, "toxic", examples), "toxicity-sample")
    kept = _kept_grams(sample, features)
    found = (sample.mapInArrow(_examples(spark.sparkContext.broadcast(kept)),
                               "label int, own binary, before binary, after binary").collect())
    found.sort(key=lambda r: (bytes(r.own), r.label))
    rows = [[np.frombuffer(r[k], "<i4") for r in found] for k in ("own", "before", "after")]
    return Classifier(kept, *fit_weights(*rows, np.array([r.label for r in found], dtype=float), len(kept)))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs`` (doc_id, text).

    NULL and empty texts score what the intercept alone gives; without labelled rows
    every score is 0.5. Rows are independent: repeated rows and NULL ids (held out) each
    get a score, and an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [model.value.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", is_held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
