"""Best-fit packing with certified partitions.

Documents are tokenised once; a document longer than a sequence is cut into pieces,
and the small piece records (no text, no ids) are packed. Pieces are dealt to
partitions of bounded size and each partition runs best-fit decreasing. Dual-feasible
functions give a lower bound on the sequences that any packing of a partition needs:
where the count meets the bound the partition is certified. While all partitions
together use more than the bound of all pieces, those with a gap keep their full
sequences and exchange the documents of all others, and certified ones exchange only
those of sequences with room to spare. Best-fit decreasing runs again over these
pools; a new packing is taken only if it needs fewer sequences. Rounds go on until the
bound is met, one partition is left or a round gains nothing.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import slices, stored

CAPACITY = 2048
END_ID = 0
#: Pieces in one partition: what one task packs in memory, about 100 bytes each.
PIECES_PER_PARTITION = 100_000
#: Rounds in which the partitions grow by four; later ones deal anew to partitions of that size.
ROUNDS = 2
#: Distinct words in each of the two generations that a worker remembers, about 200 bytes each.
REMEMBERED = 250_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# A-Z to lower case, as the tokenizer does first; all else as it is.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MARKS = b".,!?;:%&$#*|"
#: Lower-case letters that normalisation leaves as they are: a-z, and U+00DF to U+00FF but for the division sign.
_PLAIN = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])"
_PLAIN_AND_MARKS = re.compile(b"(" + _PLAIN + b"+)([" + re.escape(_MARKS) + b"]*)").fullmatch
_BEFORE_MARKS = re.compile(rb"(?:[0-9]|" + _PLAIN + b")$").search
_LATIN = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]

# What a tokenizer file must say for its ids to be found word by word.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _stem(word: bytes) -> bytes:
    """``word`` without marks at its end if a digit or a letter of ``_PLAIN`` comes before them.

    Other letters stay with their marks: composing or lower-casing may turn them into a letter and
    a combining mark, which the tokenizer joins with what follows.
    """
    stem = word.rstrip(_MARKS)
    return stem if len(stem) < len(word) and _BEFORE_MARKS(stem) else word


class WordIds:
    """Token ids of texts, as little-endian bytes, one look-up a word.

    A tokenizer that composes, lower-cases, drops white space and never joins characters across it
    gives a text the ids of its words in order, and a word those of
    its stem and of the marks at its end. Only new stems go to the tokenizer, and those of plain
    lower-case letters, which its steps before the merges leave as they are, to its merges at once. A text
    that may hold a special token's string goes there whole, and so do all texts if the file
    describes any other tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _is_by_word(json.loads(self.tokenizer.to_str()))
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
                                  or "(?!)", re.IGNORECASE)
        self.merges = self.tokenizer.model.tokenize if self.by_word else None
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_chars = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in _LATIN}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        if not self.by_word or b"<|" in text and self.special.search(text.decode()):
            return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()
        words = text.translate(_LOWER).split()
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known  # what is used again moves back, the rest goes
        found = list(map(self.known.get, words))
        if None not in found:
            return b"".join(found)
        self._learn({w for w, ids in zip(words, found, strict=True) if ids is None})
        return b"".join(map(self.known.__getitem__, words))

    def _learn(self, words: set[bytes]) -> None:
        known, older, merges = self.known, self.older, self.merges
        rest = []
        for w in words:
            if w in older:
                known[w] = older[w]
                continue
            plain = _PLAIN_AND_MARKS(w)
            if not plain:
                rest.append(w)
                continue
            stem, marks = plain.groups()
            ids = known.get(stem) or older.get(stem)
            if ids is None:
                letters = stem.decode() if stem.isascii() else stem.decode().translate(self.byte_chars)
                ids = array("I", [t.id for t in merges(letters)]).tobytes()
            known[stem] = ids
            if marks:
                if marks not in known:
                    self._encode([marks])
                known[w] = ids + known[marks]
        cut = [(w, _stem(w)) for w in rest]
        parts = {stem for _, stem in cut}
        parts.update(w[len(stem):] for w, stem in cut if len(stem) < len(w))
        self._encode(list(parts.difference(known)))
        known.update((w, known[stem] + known[w[len(stem):]]) for w, stem in cut if len(stem) < len(w))

    def _encode(self, parts: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
        self.known.update(zip(parts, (array("I", e.ids).tobytes() for e in found), strict=True))


def _is_by_word(d: dict) -> bool:
    """Whether a tokenizer's description is of the kind that ``WordIds`` looks up by words."""
    split, model = d["pre_tokenizer"] or {}, d["model"]
    steps = split.get("pretokenizers") or [{}, {}]
    return (d["normalizer"] == _NORMALIZER and split.get("type") == "Sequence" and len(steps) == 2
            and steps[0].get("pattern") == {"Regex": _SPLIT} and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
            and steps[1].get("type") == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and model["type"] == "BPE" and model["dropout"] is None and d["truncation"] is None and d["padding"] is None
            and all(t["content"].startswith("<|") for t in d["added_tokens"]))


_ENCODERS: dict[str, WordIds] = {}


def encoder_of(path: str) -> WordIds:
    """The worker's encoder for a tokenizer file; it stays for the worker's next tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def _pieces(path: str | None, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path or public_tokenizers.path("word_bpe_49k.json"))
        end = array("I", [END_ID]).tobytes()
        for batch in slices(batches):
            cols: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text or b"") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for c, v in zip(cols, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        c.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each length, and the free room of each sequence.

    ``mask`` has a bit for every amount of room that some open sequence has, so the
    tightest fit is the lowest set bit at or above the length.
    """
    order = np.argsort(-lengths, kind="stable")
    where, offset, room = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = mask >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            b = by_room[free].pop()
            if not by_room[free]:
                mask &= ~(1 << free)
        else:
            free, b = capacity, len(room)
            room.append(capacity)
        where[i], offset[i] = b, capacity - free
        room[b] = free - n
        if free - n:
            by_room[free - n].append(b)
            mask |= 1 << (free - n)
    return where, offset, np.array(room, dtype=np.int64)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that any packing of these lengths needs."""
    return bound_of_counts(np.bincount(np.asarray(lengths, dtype=np.int64), minlength=capacity + 1), capacity)


def bound_of_counts(count: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best bound of three families of dual-feasible functions, from how many pieces have each length."""
    count = count.astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    total, upto, heavy = int((count * x).sum()), np.cumsum(count * x), np.cumsum(count)
    best = -(-total // capacity)
    # Lengths over C - k count as C, under k as 0, others as they are.
    for k in range(1, capacity // 2 + 1):
        large = int(heavy[capacity] - heavy[capacity - k])
        middle = int(upto[capacity - k] - upto[k - 1])
        best = max(best, large + -(-middle // capacity))
    # x -> floor((k+1) x / C) / k, and x / C where (k+1) x / C is whole.
    for k in range(1, 101):
        scaled = (k + 1) * x
        whole = scaled % capacity == 0
        value = np.where(whole, x * k, scaled // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    return best


def _pack(round_no: int, capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        where, offset, room = best_fit_decreasing(lengths, capacity)
        return rows.assign(sequence_id=(np.int64(round_no) << 52) + (np.int64(key[0]) << 28) + where, offset=offset,
                           room=room[where], gap=len(room) - lower_bound(lengths, capacity))
    return run


_PACKED = _PIECES + ", part long, sequence_id long, offset long, room long, gap long"


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                   per_partition: int = PIECES_PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns a row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. ``tokenizer`` is the path of a tokenizers file, the public 49k word BPE if
    not given.

    A document is its token ids and then id 0, so NULL, empty and blank texts have one
    token. Rows that repeat a doc_id, or have none, are packed as rows of their own.
    Ties are broken by doc_id and piece. An empty table gives an empty result.
    """
    pieces = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary"))
                    .mapInArrow(_pieces(tokenizer, capacity), _PIECES), "pack-pieces")
    todo, settled, before = pieces, [], None
    for r in count():
        # An exchange deals what was released to fewer partitions, at first also to larger ones.
        parts = max(1, -(-todo.count() // (per_partition * 4 ** min(r, rounds))))
        dealt = todo.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(r)), F.lit(parts)))
        packed = stored(dealt.groupBy("part").applyInPandas(_pack(r, capacity), _PACKED), "pack-round")
        used = packed.select("sequence_id").distinct().count()
        if before is not None and used >= before:
            settled.append(todo)  # the exchange gained nothing
            break
        of_length = np.zeros(capacity + 1, dtype=np.int64)
        for x in packed.groupBy("length").count().collect():  # at most ``capacity`` rows
            of_length[x["length"]] = x["count"]
        needed = bound_of_counts(of_length, capacity)
        # With a gap all sequences with room are released, without one those that an exchange may help.
        loose = (F.col("room") > 0) & ((F.col("gap") > 0) | (F.col("room") > capacity // 64))
        if parts == 1 or used <= needed:
            settled.append(packed)
            break
        settled.append(packed.where(~loose))
        todo = packed.where(loose)
        before = todo.select("sequence_id").distinct().count()
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
