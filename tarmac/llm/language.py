"""Language identification as a mixture of languages.

Each known language is a distribution over hashed byte trigrams of lower-cased
letters, counted over all training documents. A document is a mixture of languages:
expectation-maximisation finds the proportions that make its trigrams likeliest, and
the set of languages is the one with the best likelihood after a penalty for each
language beyond the first. The prediction is the language with the largest share.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import is_held_out, passing, slices, stored

UNKNOWN = "und"
BITS = 14
#: Languages a model may have: its table is broadcast, 128 KB for each.
MAX_LANGUAGES = 1000
#: Trigrams that tell as much as one independent observation (neighbours overlap).
PER_OBSERVATION = 3.0
#: Penalty for each further language, in units of log(observations).
PENALTY = 2.0

# ASCII letters in lower case; every other ASCII byte is a gap; UTF-8 bytes of other characters as they are.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the text's words, gaps included."""
    data = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    code = b[:-2] | (b[1:-1] << 8) | (b[2:] << 16)
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(1 << BITS, dtype=np.int64))
    for batch in slices(batches):
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if has_letter(text):
                sums[lang] += np.bincount(trigrams(text), minlength=1 << BITS)
    for lang, n in sums.items():
        bins = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bins), pa.string()), pa.array(bins.astype(np.int32)),
                                          pa.array(n[bins])], names=["lang", "bin", "n"])


def train(docs: DataFrame) -> DataFrame:
    """Trigram counts (lang, bin, n) over all rows of ``docs`` (text, lang) with both."""
    return (docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
            .mapInArrow(_count, "lang string, bin int, n long")
            .groupBy("lang", "bin").agg(F.sum("n").alias("n")))


class Languages:
    """Per-language trigram probabilities, smoothed, in a table of bins x languages."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.names = sorted(counts)
        n = np.stack([counts[k] for k in self.names]) + 0.5 if self.names else np.zeros((0, 1 << BITS))
        self.p = np.ascontiguousarray((n / n.sum(axis=1, keepdims=True)).T) if self.names else n.T

    def mixture(self, text: str | None) -> list[tuple[str, float]]:
        """Languages of the chosen set with their shares, largest first; none if nothing can be told."""
        if not self.names or not has_letter(text):
            return []
        seen = np.bincount(trigrams(text), minlength=1 << BITS)
        bins = np.flatnonzero(seen)
        w = seen[bins] / PER_OBSERVATION
        p = self.p[bins]
        total = w.sum()
        share = self._share(p, w, np.full(len(self.names), 1 / len(self.names)))
        order = np.lexsort((np.arange(len(share)), -share))
        best, chosen, last = -np.inf, None, 1
        for k in range(1, len(order) + 1):
            # A small share ends the search only if the language before it gained nothing.
            if k > 1 and (share[order[k - 1]] <= 0 or share[order[k - 1]] < 0.01 and last < k - 1):
                break
            sub = p[:, order[:k]]
            s = self._share(sub, w, share[order[:k]] / share[order[:k]].sum()) if k > 1 else np.ones(1)
            fit = float(w @ np.log(sub @ s)) - PENALTY * (k - 1) * np.log(1 + total)
            if fit > best:
                best, chosen, last = fit, s, k
        top = np.lexsort((order[:last], -chosen))
        return [(self.names[order[i]], float(chosen[i])) for i in top]

    @staticmethod
    def _share(p: np.ndarray, w: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Expectation-maximisation of the shares of fixed languages, until none moves by 1e-4."""
        while True:
            resp = p * share
            new = (w / resp.sum(axis=1)) @ resp
            new /= new.sum()
            if np.abs(new - share).max() < 1e-4:
                return new
            share = new


def _model(counts: DataFrame) -> Languages:
    """The table on the driver: at most ``MAX_LANGUAGES`` x 2^14 counts, whatever the corpus."""
    found: dict[str, np.ndarray] = {}
    for r in counts.toLocalIterator():
        found.setdefault(r.lang, np.zeros(1 << BITS))[r.bin] = r.n
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} values of lang: no set of languages")
    return Languages(found)


_OUT = "lang_pred string, score double, languages array<string>, shares array<double>"


def identify(docs: DataFrame, training: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` plus lang_pred, score, languages and shares.

    ``score`` is the share of the predicted language in the document's mixture. A text
    that is NULL or has no letter, and any text if nothing was learned, gets 'und', a
    score of 0 and no languages. Ties go to the name that sorts first. Rows are
    independent, so repeated rows and NULL ids need no care; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(_model(stored(train(training), "language-counts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [model.value.mixture(t) for t in batch.column("_scan").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in keep},
                "lang_pred": pa.array([m[0][0] if m else UNKNOWN for m in found], pa.string()),
                "score": pa.array([m[0][1] if m else 0.0 for m in found], pa.float64()),
                "languages": pa.array([[k for k, _ in m] for m in found], pa.list_(pa.string())),
                "shares": pa.array([[v for _, v in m] for m in found], pa.list_(pa.float64()))})

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep) + _OUT
    return docs.select(*keep, F.col("text").alias("_scan")).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, training: DataFrame, least_share: float) -> DataFrame:
    """The rows of ``docs``, all columns, of which one language holds ``least_share`` or more."""
    plain, names = passing(docs)
    found = identify(plain, training, list(names))
    return (found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_share))
            .select(*(F.col(n).alias(c) for n, c in names.items())))


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages and shares for each row of
    ``docs`` (doc_id, text, lang), learned from the rows that are not held out."""
    found = identify(docs, docs.where(~is_held_out("doc_id")), ["doc_id"])
    return found.select("doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score", "languages", "shares")
