"""The trained operators against plain versions that count, fit and score every text again, one by one."""

import math
import re
from collections import Counter, defaultdict

import numpy as np

import brute
from tarmac.llm import language, quality, toxicity
from tarmac.llm.queries import QUERIES


def hashed(code: int, factor: int, width: int, bits: int) -> int:
    return (code * factor % (1 << width)) >> (width - bits)


def byte_grams(data: bytes, n: int) -> list[int]:
    return [int.from_bytes(data[i:i + n], "little") for i in range(len(data) - n + 1)]


def letters_only(data: bytes) -> bytes:
    """Runs of letters and of bytes of other scripts, one space around each."""
    return b" " + b" ".join(re.findall(rb"[a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), data))) + b" "


def documents() -> list[tuple]:
    return brute.rows("documents", "doc_id, text, lang")


def train_labels(name: str) -> dict:
    return {i: y for i, y in brute.rows("labels", f"doc_id, {name}") if y is not None and not brute.held_out(i)}


# -- quality

def plain_terms(text: str | None) -> Counter:
    data = (text or "").encode()
    words = data.split()
    out: Counter = Counter()
    if not words:
        return out
    for g in byte_grams(letters_only(data), 3):
        out["letters", hashed(g, 0x9E3779B1, 32, quality.BITS)] += 1
    shape = re.sub(rb"[a-z\x80-\xff]", b"a", re.sub(rb"[0-9]", b"0", re.sub(rb"[A-Z]", b"A", b" ".join(words))))
    for g in byte_grams(shape, 4):
        out["shape", hashed(g, 0x9E3779B1, 32, quality.BITS)] += 1
    lines = data.split(b"\n")
    out["repeat", 0] = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out["repeat", 1] = len(words) - len(set(words))
    out["repeat", 2] = len(lines) - len(set(lines))
    return +out


def plain_vector(terms: Counter, idf: dict, place: dict) -> np.ndarray:
    out = np.zeros(len(place))
    totals = Counter()
    for (kind, _), n in terms.items():
        totals[kind] += n
    totals["repeat"] = totals["letters"]
    for t, n in terms.items():
        out[place[t]] = math.sqrt(n / max(totals[t[0]], 1)) * idf[t]
    return out / max(np.linalg.norm(out), 1e-12)


def test_quality_equals_a_plain_refit(spark):
    """Counts by dictionaries, an exact decomposition in double precision, neighbours by a full sort."""
    terms = {i: plain_terms(t) for i, t, _ in documents()}
    df = Counter(t for c in terms.values() for t in c)
    idf = {t: math.log1p(len(terms) / (1 + n)) for t, n in df.items()}
    place = {t: k for k, t in enumerate(sorted(df))}
    labels = train_labels("quality")
    vectors = {i: plain_vector(c, idf, place) for i, c in terms.items()}
    x = np.stack([vectors[i] for i in sorted(labels)])
    y = np.array([labels[i] for i in sorted(labels)], dtype=float)
    basis = np.linalg.svd(x, full_matrices=False)[2][:min(quality.RANK, len(x))].T
    known = [v / np.linalg.norm(v) for v in x @ basis]
    got = {r.doc_id: r for r in QUERIES["op1_quality"](spark, brute.SF).collect()}
    assert set(got) == set(terms)
    off = []
    for i, v in vectors.items():
        q = v @ basis
        q /= max(np.linalg.norm(q), 1e-12)
        near = sorted(((float(q @ k), label) for k, label in zip(known, y, strict=True)), key=lambda p: -p[0])
        votes = [(max(c, 0.0) ** quality.SHARPNESS, label) for c, label in near[:quality.VOTERS]]
        score = ((sum(w * label for w, label in votes) + 1e-3 * y.mean()) / (sum(w for w, _ in votes) + 1e-3)
                 if terms[i] else y.mean())
        off.append(abs(got[i].score - score))
        assert got[i].predicted == int(got[i].score >= 0.3)
    assert max(off) < 0.02 and np.median(off) < 1e-3


# -- toxicity

def plain_grams(text: str | None) -> set[int]:
    data = letters_only((text or "").lower().encode())
    return {hashed(g, 0x9E3779B97F4A7C15, 64, toxicity.BITS) for n in (5, 6) for g in byte_grams(data, n)}


def plain_fit(x, a, b, y, rounds):
    """Accelerated proximal steps over dense rows; the curvature is the exact largest one."""
    n = len(y)
    weight = np.where(y > 0, toxicity.BALANCE, 1.0)
    weight /= weight.sum()
    d = (b - a) * math.sqrt(2 * toxicity.FAIRNESS / n)
    step = 1 / (1.1 * np.linalg.norm(np.vstack([x * np.sqrt(weight / 4)[:, None], d]), 2) ** 2 + 0.25)
    w, c, t = np.zeros(x.shape[1]), math.log(y.sum() / (n - y.sum())), 1.0
    wm, cm = w, c
    for _ in range(rounds):
        e = (1 / (1 + np.exp(-(x @ wm + cm))) - y) * weight
        new = wm - step * (x.T @ e + d.T @ (d @ wm))
        new = np.sign(new) * np.maximum(np.abs(new) - step * toxicity.SPARSITY, 0)
        new_c = cm - step * e.sum()
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        wm, cm = new + (t - 1) / nt * (new - w), new_c + (t - 1) / nt * (new_c - c)
        w, c, t = new, new_c, nt
    return w, c


def loss(x, a, b, y, w, c):
    weight = np.where(y > 0, toxicity.BALANCE, 1.0)
    z = x @ w + c
    return float((weight * (np.logaddexp(0, z) - y * z)).sum() / weight.sum()
                 + toxicity.FAIRNESS * (((b - a) @ w) ** 2).mean() + toxicity.SPARSITY * np.abs(w).sum())


def test_toxicity_equals_a_plain_refit(spark):
    """Terms kept by a plain chi-square and dense rows; the stated loss has all but reached its least value."""
    grams = {i: plain_grams(t) for i, t, _ in documents()}
    texts = {i: t for i, t, _ in documents()}
    labels = train_labels("toxic")
    ids = sorted(labels)
    total, pos = len(ids), sum(labels.values())
    n, toxic = Counter(), Counter()
    for i in ids:
        n.update(grams[i])
        if labels[i]:
            toxic.update(grams[i])
    chi = {}
    for g, k in n.items():
        if 3 <= k < total:
            expect = k * (pos / total)
            chi[g] = (toxic[g] - expect) ** 2 / (expect * (1 - k / total))
    kept = set(sorted(chi, key=lambda g: (-chi[g], g))[:toxicity.FEATURES])
    for terms in toxicity.IDENTITY.values():
        for t in terms:
            kept |= plain_grams(t)
    place = {g: k for k, g in enumerate(sorted(kept))}

    def dense(sets):
        out = np.zeros((len(sets), len(place)))
        for row, s in zip(out, sets, strict=True):
            row[[place[g] for g in s if g in place]] = 1
        return out

    pairs = [toxicity.counterfactuals(texts[i] or "") or ("", "") for i in ids]
    x, a, b = dense([grams[i] for i in ids]), dense([plain_grams(p[0]) for p in pairs]), dense([plain_grams(p[1]) for p in pairs])
    y = np.array([labels[i] for i in ids], dtype=float)
    w, c = plain_fit(x, a, b, y, toxicity.ROUNDS)
    fitted = toxicity.fit(spark.createDataFrame(documents(), "doc_id long, text string, lang string"),
                          spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    own = np.zeros(len(place))
    own[[k for g, k in place.items() if fitted.place[g] >= 0]] = [fitted.w[fitted.place[g]] for g in place if fitted.place[g] >= 0]
    assert len(fitted.w) == np.count_nonzero(own)  # no gram outside the plain choice
    start = loss(x, a, b, y, np.zeros(len(place)), math.log(y.sum() / (len(y) - y.sum())))
    least = loss(x, a, b, y, *plain_fit(x, a, b, y, 20 * toxicity.ROUNDS))
    assert loss(x, a, b, y, own, fitted.c) - least < 0.01 * (start - least)
    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, brute.SF).collect()}
    assert set(got) == set(grams)
    for i, s in grams.items():
        z = fitted.c + sum(own[place[g]] for g in s if g in place)
        assert abs(got[i].score - 1 / (1 + math.exp(-z))) < 1e-9
        refit = 1 / (1 + math.exp(-(c + sum(w[place[g]] for g in s if g in place))))
        assert abs(got[i].score - refit) < 1e-3
        assert got[i].predicted == int(got[i].score >= 0.5)


# -- language

def plain_shares(p: np.ndarray, w: np.ndarray, share: list[float]) -> list[float]:
    while True:
        mass = [0.0] * len(share)
        for row, n in zip(p, w, strict=True):
            parts = [q * s for q, s in zip(row, share, strict=True)]
            total = sum(parts)
            for k, v in enumerate(parts):
                mass[k] += n * v / total
        new = [m / sum(mass) for m in mass]
        if max(abs(u - v) for u, v in zip(new, share, strict=True)) < 1e-4:
            return new
        share = new


def test_language_equals_a_plain_refit(spark):
    """Counts by dictionaries and expectation-maximisation term by term, for every whole text."""
    def bins(text):
        return [hashed(g, 0x9E3779B1, 32, language.BITS) for g in byte_grams(letters_only(text.lower().encode()), 3)]

    counts: dict = defaultdict(Counter)
    for i, t, lang in documents():
        if t is not None and lang is not None and any(map(str.isalpha, t)) and not brute.held_out(i):
            counts[lang].update(bins(t))
    names = sorted(counts)
    size = {k: sum(counts[k].values()) + 0.5 * (1 << language.BITS) for k in names}
    got = {r.doc_id: r for r in QUERIES["op5_language"](spark, brute.SF).collect()}
    for i, t, _ in documents():
        if t is None or not any(map(str.isalpha, t)):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        seen = Counter(bins(t))
        p = [[(counts[k][g] + 0.5) / size[k] for k in names] for g in seen]
        w = [n / language.PER_OBSERVATION for n in seen.values()]
        share = plain_shares(p, w, [1 / len(names)] * len(names))
        order = sorted(range(len(names)), key=lambda k: (-share[k], k))
        best, chosen, last = -math.inf, None, 1
        for k in range(1, len(names) + 1):
            held = order[:k]
            if k > 1 and (share[held[-1]] <= 0 or share[held[-1]] < 0.01 and last < k - 1):
                break
            sub = [[row[j] for j in held] for row in p]
            whole = sum(share[j] for j in held)
            s = plain_shares(sub, w, [share[j] / whole for j in held]) if k > 1 else [1.0]
            fit = (sum(n * math.log(sum(q * v for q, v in zip(row, s, strict=True))) for row, n in zip(sub, w, strict=True))
                   - language.PENALTY * (k - 1) * math.log(1 + sum(w)))
            if fit > best:
                best, chosen, last = fit, s, k
        want = sorted(zip(chosen, (names[j] for j in order[:last]), strict=True), key=lambda v: (-v[0], v[1]))
        assert got[i].languages == [name for _, name in want] and got[i].lang_pred == want[0][1]
        assert np.allclose(got[i].shares, [v for v, _ in want], atol=1e-6)
        assert abs(got[i].score - want[0][0]) < 1e-6 and got[i].held_out == brute.held_out(i)
