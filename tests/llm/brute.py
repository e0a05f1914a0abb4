"""Plain single-machine versions of the operators' results, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np

SF = "/root/testdata/sf0.001"


def rows(name: str, columns: str, sf: str = SF) -> list[tuple]:
    return duckdb.connect().execute(f"SELECT {columns} FROM read_parquet('{sf}/{name}.parquet')").fetchall()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def components(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near_copies(docs: list[tuple], k: int, percent: int = 80) -> dict:
    """doc_id -> (n_shingles, component_id); ids unique and not None."""
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    ids = sorted(sets)
    links = []
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((a, b))
    part = components(ids, links)
    return {i: (len(sets[i]), part[i]) for i in ids}


def contamination(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))

    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[j:j + n])].add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit)))
    return out


def dedup_lines(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, n_removed, text); rows that repeat id and text are one document."""
    first, out = {}, []
    docs = sorted(set(docs), key=lambda r: r[0])
    for d, t in docs:
        lines = [] if t is None else t.split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if "".join(w).strip(" ") == "":
                continue
            if first.setdefault(w, (d, p)) != (d, p):
                gone.update(range(p, p + 3))
        out.append((d, len(lines), len(gone),
                    t if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple]:
    """(start, kind index, end) of the stated patterns, sorted."""
    text = text or ""
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        (r"[0-9]([\x20-]?[0-9])+",
         lambda v: 12 <= len(re.sub(r"\D", "", v)) <= 19 and _luhn(re.sub(r"\D", "", v))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub(r"\D", "", v)) <= 15)]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, text)
                  if ok(m[0]))


def spans_digest(spans: list[tuple]) -> str:
    names = ("email", "ip", "card", "phone")
    return hashlib.sha256(",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def embedding_links(vectors: list[tuple], cosine: float = 0.93) -> dict:
    """vec_id -> (n_links, component_id); ids unique and not None."""
    good = []
    for i, x, label in vectors:
        if x and label is not None and all(v is not None and np.isfinite(v) for v in x) and any(x):
            v = np.array(x, dtype=float)
            good.append((i, v / np.linalg.norm(v), label))
    n, links = defaultdict(int), []
    for p, (a, x, la) in enumerate(good):
        for b, y, lb in good[p + 1:]:
            if la == lb and len(x) == len(y) and x @ y >= cosine:
                n[a] += 1
                n[b] += 1
                links.append((a, b))
    part = components([i for i, *_ in vectors], links)
    return {i: (n[i], part[i]) for i, *_ in vectors}


def held_out(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def lpt(sizes: list[int], shards: int) -> list[int]:
    """Loads of the one-by-one schedule."""
    loads = [0] * shards
    for s in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += s
    return sorted(loads)
