"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of word shingles, reduced to ``COORDINATES`` minwise tokens.
Independent trees branch it: a node picks, from its own path, one coordinate and
sometimes a second (``1 / similarity`` on average), and a document goes down with the
token it has there, so similar sets stay together. Small nodes are compared
exhaustively, larger ones branch again. Members whose four-bit sketch matches none of
another label drop out; those left are compared on their full sets, recomputed from the
texts, and a group returns only as many links as connect it, never its pairs.

Groups of copies are kept from filling nodes in two ways. Documents with equal sets are
one class from the start. And before the trees are searched, every class is compared with
the first member, by hash order, of each node it is in; the closest of these and the first
likely one are confirmed, at most two a class. The links of this pass
label most of any group, however large. While a large node still holds many members outside its
main label, the pass is repeated with other first members as long as that links many. Nodes that hold one label only are done.
Later passes look only for links between labels, which is all that components need; the
few other members of a node that one label fills are compared with all of it. Other large
nodes are compared in blocks, and the largest branch on, each by its own size, under the labels that the links
found so far give; the deeper they do, the more trees their members
get: a pair at the threshold misses all trees of any level with at most ``MISS``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fits_broadcast, slices, small, stored
from tarmac.llm.components import components, spanning_roots

#: Share of pairs at the threshold that may be apart in all trees of a level, see ``trees_on``.
MISS = 2e-4
#: Trees that there are at least.
TREES = 10
COORDINATES = 64
#: Classes that a node may have to be compared exhaustively.
LEAF = 200
#: A node with at most so many members is compared in blocks: so many sketch comparisons cost a member
#: less than its rows on all the levels below.
PAIRS_EACH = 8000
#: Passes that only label groups, at most; more would change the work and not the result.
HEAD_PASSES = 6
#: Another pass is made if the last one linked more than one in so many of the classes that it would look at.
PASS_LINKS = 10
#: Shingles (8 bytes each) of the full sets that are compared in one group, on average.
GROUP_SHINGLES = 8_000_000
#: Members of a block in that comparison.
BLOCK = 1000
#: Level of the first pass, which only labels groups; the search looks at every level from 1.
FIRST_LEVEL = 3
#: Levels after which large nodes are compared whatever they cost.
LEVELS = 24
#: Equal four-bit tokens, of 64, that a pair must show: 5 deviations under what 0.8 gives, 1 in a million fails.
MIN_MATCHES = 36
#: Equal tokens of a pair that is more likely than not at the threshold.
LIKELY_MATCHES = 52
#: Ids of documents to confirm that may be broadcast (8 bytes each).
BROADCAST_IDS = 2_000_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_REMEMBERED = 200_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Shingles:
    """Sets of hashed ``k``-word shingles; remembers the hashes of words."""

    def __init__(self, k: int):
        self.k, self.known = k, {}

    def of(self, text: bytes | None) -> np.ndarray:
        """The sorted set of a whole text: empty without words, one element for fewer than k."""
        words = (text or b"").translate(_LOWER).split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(self.k, len(words))
        out = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i])
        return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    """Minwise tokens of a set, one for each coordinate."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(s), 4096):
        part = s[at:at + 4096]
        np.minimum(low, ((part[:, None] ^ _SEEDS) * _SEEDS[::-1]).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def sketch(sig: np.ndarray) -> np.ndarray:
    """The low four bits of every token of the rows of ``sig``, sixteen to a word."""
    bits = (sig & 15).astype(np.uint64).reshape(len(sig), 4, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return np.bitwise_or.reduce(bits, axis=2)


_SIGNED = "doc_id long, n_shingles long, f1 long, f2 long, sig binary"


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for batch in slices(batches):
            n, f1, f2, sigs = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles.of(text)
                n.append(len(s))
                f1.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                f2.append(int(_mix(s + np.uint64(1)).sum(dtype=np.uint64).astype(np.int64)))
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "f1", "f2", "sig"])
    return run


def miss_on(level: int, trees: int, similarity: float) -> float:
    """Probability that a pair of the similarity is apart in all trees on a level.

    How many of the ``COORDINATES`` tokens agree is binomial and the same for all trees; with
    it given, a tree is a branching process whose paths go on with one or two tokens.
    """
    agree = np.arange(COORDINATES + 1) / COORDINATES
    of_agree = np.array([comb(COORDINATES, a) * similarity ** a * (1 - similarity) ** (COORDINATES - a)
                         for a in range(COORDINATES + 1)])
    apart, two = np.zeros(COORDINATES + 1), 1 / similarity - 1
    for _ in range(level):
        ends = 1 - agree + agree * apart
        apart = ends * (1 - two + two * ends)
    return float(of_agree @ apart ** trees)


def trees_on(level: int, least: int, similarity: float, miss: float = MISS) -> int:
    """Trees that a level needs, so that at most ``miss`` of the pairs of the similarity are apart in all."""
    trees = least
    while miss_on(level, trees, similarity) > miss:
        trees += 1
    return trees


_NODES = "node long, parent long, rep long, label long"
_SKETCHED = _NODES + ", s0 long, s1 long, s2 long, s3 long"


def _nodes(level: int, trees: int, similarity: float, above: int = 0, first: int = 0, sketched: bool = True):
    """The nodes of every class on one level of all trees from ``first`` (the root on level 0), each
    with the node it is under on level ``above``."""
    second = np.uint64(int((1 / similarity - 1) * 2.0 ** 64))
    at_once = min(1024, max(1, int(400_000 * similarity ** level) // max(1, trees - first)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = _mix(np.arange(first + 1, trees + 1, dtype=np.uint64) << np.uint64(20))
        for batch in slices(batches, at_once):
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u4").reshape(batch.num_rows, -1)
            row = np.repeat(np.arange(batch.num_rows), trees - first)
            node = np.tile(roots, batch.num_rows)
            parent = node
            for depth in range(level):
                pick = _mix(node + np.uint64(1))
                one = (pick % np.uint64(COORDINATES)).astype(np.int64)
                two = (one + 1 + ((pick >> np.uint64(32)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
                also = _mix(node + np.uint64(2)) < second
                row = np.concatenate([row, row[also]])
                node = np.concatenate([node, node[also]])
                parent = node if depth == above else np.concatenate([parent, parent[also]])
                at_c = np.concatenate([one, two[also]])
                token = sig[row, at_c].astype(np.uint64) | (at_c.astype(np.uint64) << np.uint64(32))
                node = _mix(_mix(node) + token)
            words = sketch(sig)[row].view(np.int64) if sketched else np.zeros((0, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.view(np.int64)), pa.array(parent.view(np.int64)),
                 batch.column("rep").take(pa.array(row)), batch.column("label").take(pa.array(row)),
                 *(pa.array(np.ascontiguousarray(words[:, j])) for j in range(words.shape[1]))],
                names=["node", "parent", "rep", "label", *(f"s{j}" for j in range(words.shape[1]))])
    return run


def _level(active: DataFrame, level: int, trees: int, old: int, similarity: float, mixed: DataFrame | None,
           sketched: bool) -> DataFrame:
    """The rows of a level: all nodes of the trees from ``old`` on, and of the others those under ``mixed``."""
    schema = _SKETCHED if sketched else _NODES
    parts = []
    if mixed is not None:
        rows = active.mapInArrow(_nodes(level, old, similarity, level - 1, sketched=sketched), schema)
        parts.append(rows.join(fits_broadcast(mixed.select(F.col("node").alias("parent")), BROADCAST_IDS), "parent",
                               "left_semi").select(rows.columns))
    if trees > old:
        parts.append(active.mapInArrow(_nodes(level, trees, similarity, first=old, sketched=sketched), schema))
    # A class reaches a node once: two of its paths never meet again.
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).drop("parent")


def _matches(a: Column, b: Column) -> Column:
    """Equal four-bit tokens of two sketches given as structs of s0 to s3."""
    different = F.lit(0)
    for j in range(4):
        x = a[f"s{j}"].bitwiseXOR(b[f"s{j}"])
        for shift in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        different = different + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(COORDINATES) - different


_GROUPED = "node long, rep long, label long"


def _flag(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each group whose sketch matches one of another label in it."""
    nibble = np.uint64(0x1111111111111111)
    for batch in slices(frames):
        members = batch.column("members")
        flat = members.flatten()
        rep, label = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "label"))
        s = np.stack([flat.field(f"s{j}").to_numpy(zero_copy_only=False) for j in range(4)], axis=1).view(np.uint64)
        sizes = np.array(members.value_lengths())
        ends = np.cumsum(sizes)
        hit = np.zeros(len(rep), dtype=bool)
        for lo, hi in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
            for at in range(lo, hi, 128):
                to = min(hi, at + 128)
                same = COORDINATES
                for w in range(4):
                    x = s[at:to, None, w] ^ s[None, lo:hi, w]
                    x |= x >> np.uint64(1)
                    x |= x >> np.uint64(2)
                    same = same - np.bitwise_count(x & nibble)
                hit[at:to] = ((same >= MIN_MATCHES) & (label[at:to, None] != label[None, lo:hi])).any(axis=1)
        node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), sizes)
        yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (node, rep, label)], names=["node", "rep", "label"])


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingles.of(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())],
                names=["rep", "members"])
    return run


def links_of(sets: list[np.ndarray], label: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different labels whose sets reach the similarity, exactly.

    All intersection sizes come from products of 0/1 rows over the shingles that two
    or more of the sets have, a few thousand columns at a time.
    """
    m, size = len(sets), np.array([len(x) for x in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(m), size)
    _, col, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    row, col = row[shared[col]], place[col[shared[col]]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((m, m), dtype=np.float32)  # whole numbers, exact below 2^24
    width = max(256, 4_000_000 // max(m, 1))
    for at in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(col, [at, at + width])
        x = np.zeros((m, min(width, int(shared.sum()) - at)), dtype=np.float32)
        x[row[lo:hi], col[lo:hi] - at] = 1
        both += x @ x.T
    linked = 100 * both.astype(np.int64) >= percent * (size[:, None] + size[None, :] - both.astype(np.int64))
    return np.nonzero(np.triu(linked, 1) & (label[:, None] != label[None, :]))


def _link(percent: int):
    """Confirmed links of each group, only as many as connect what they connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            out_a, out_b = [], []
            for members in batch.column(0):
                rep = np.array([r["rep"].as_py() for r in members.values])
                label = np.array([r["label"].as_py() for r in members.values])
                sets = [np.frombuffer(r["members"].as_py(), dtype=np.uint64) for r in members.values]
                i, j = links_of(sets, label, percent)
                if len(i):
                    root = spanning_roots(len(rep), i, j, rep)
                    linked = root != np.arange(len(rep))
                    out_a.append(rep[linked])
                    out_b.append(rep[root[linked]])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))],
                                                 names=["a", "b"])
    return run


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(k)
        for batch in slices(batches):
            seen: dict[int, tuple[bytes, np.ndarray]] = {}

            def of(i: int, text: bytes) -> np.ndarray:
                if i not in seen or seen[i][0] != text:  # noqa: B023
                    if len(seen) > 64:  # noqa: B023
                        seen.clear()  # noqa: B023
                    seen[i] = text, shingles.of(text)  # noqa: B023
                return seen[i][1]  # noqa: B023

            keep = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb")), strict=True):
                x, y = of(a, ta), of(b, tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    pairs = stored(pairs, "near-pairs")
    ids = stored(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(),
                 "near-ids")
    texts = stored(docs.select("doc_id", "text").join(fits_broadcast(ids, BROADCAST_IDS), "doc_id", "left_semi"),
                   "near-texts")
    both = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb"))
    return stored(both.mapInArrow(_confirm(k, percent), "a long, b long").distinct(), "near-links")


def _flagged(rows: DataFrame) -> DataFrame:
    """(node, rep, label) of the members of bounded groups that may have a link to another label."""
    members = F.collect_list(F.struct("rep", "label", "s0", "s1", "s2", "s3")).alias("members")
    return stored(rows.groupBy("node").agg(members).mapInArrow(_flag, _GROUPED), "near-flagged")


def _linked(flagged: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) confirmed on the full sets of the members of each group.

    A group whose sets hold too many shingles together is dealt out, so that every two of its
    parts meet in a group that holds few enough.
    """
    ids = stored(flagged.select(F.col("rep").alias("doc_id")).distinct(), "near-ids")
    sets = stored(docs.select("doc_id", "text").join(fits_broadcast(ids, BROADCAST_IDS), "doc_id", "left_semi")
                  .mapInArrow(_sets(k), "rep long, members binary"), "near-sets")
    sizes = sets.select("rep", (F.octet_length("members") / 8).alias("size"))
    heavy = (flagged.join(sizes, "rep").groupBy("node").agg(F.sum("size").alias("size"))
             .select("node", F.ceil(F.col("size") / GROUP_SHINGLES).cast("int").alias("m")).where("m > 1"))
    dealt = flagged.join(fits_broadcast(stored(heavy, "near-heavy"), BROADCAST_IDS), "node", "left")
    mine = F.pmod(F.xxhash64("rep"), F.col("m")).cast("int")
    dealt = (dealt.withColumn("other", F.explode(F.when(F.col("m").isNull(), F.array(F.lit(0)))
                                                 .otherwise(F.sequence(F.lit(0), F.col("m") - 1))))
             .withColumn("node", F.when(F.col("m").isNull(), F.col("node")).otherwise(
                 F.xxhash64("node", F.least(mine, "other"), F.greatest(mine, "other")))).select("node", "rep", "label"))
    groups = dealt.join(sets, "rep").groupBy("node").agg(
        F.collect_list(F.struct("rep", "label", "members")).alias("group")).select("group")
    return stored(groups.mapInArrow(_link(percent), "a long, b long").where("a <> b").distinct(), "near-links")


def near_links(reps: DataFrame, docs: DataFrame, k: int, percent: int, trees: int = TREES, leaf: int = LEAF,
               levels: int = LEVELS, pairs_each: int = PAIRS_EACH, block: int = BLOCK) -> DataFrame:
    """Confirmed links (a, b) between classes (rep, sig), enough to connect every component."""
    similarity = percent / 100
    plain = reps.select("rep", "sig", F.col("rep").alias("label"))
    # First passes: every class against the first one of each of its nodes on the first level.
    rows = plain.mapInArrow(_nodes(FIRST_LEVEL, trees, similarity), _SKETCHED).drop("parent", "label")
    shared = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    rows = stored(rows.join(fits_broadcast(stored(shared, "near-shared"), BROADCAST_IDS), "node"), "near-first")
    links, current = None, rows.withColumn("label", F.col("rep"))
    for r in range(HEAD_PASSES):
        found = _confirmed(_head_pairs(current, r), docs, k, percent)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        # On with large nodes that have many members outside their main label.
        current = _labelled(rows.where(F.col("n") > leaf), labels)
        split = stored(_main_labels(current).where(F.col("others") > leaf // 4).select("node"), "near-split")
        current = stored(current.join(fits_broadcast(split, BROADCAST_IDS), "node"), "near-current")
        # Large nodes also come from frequent words; they stay split, so passes end that link few.
        if found.count() <= current.select("rep").distinct().count() // PASS_LINKS:
            break
    plain = stored(_labelled(reps, labels).select("rep", "sig", "label"), "near-labelled")

    flagged, active, last, old = [], plain, None, 0
    n_active, whole = plain.count(), small(plain, leaf)
    for level in [0] if whole else range(1, levels + 1):
        now = 1 if whole else trees_on(level, max(trees, old), similarity)
        rows = _level(active, level, now, old, similarity, last, False)
        nodes = stored(rows.groupBy("node").agg(F.count("*").alias("n"), F.min("label").alias("l1"),
                                                F.max("label").alias("l2")).where("l1 < l2").select("node", "n"),
                       "near-nodes")
        large = stored(_main_labels(rows.join(fits_broadcast(nodes.where(F.col("n") > leaf), BROADCAST_IDS), "node")),
                       "near-large")
        few, many = F.col("others") <= leaf // 4, F.col("others") > leaf // 4
        # A node branches on if that makes fewer rows of each member than it has pairs.
        most = max(pairs_each, trees_on(level + 1, now, similarity) / similarity ** (level + 1))
        branches = many & (F.col("n") > most) if level < levels else F.lit(False)
        mixed = stored(large.where(branches).select("node", "n"), "near-mixed")
        compared = nodes.join(fits_broadcast(mixed.select("node"), BROADCAST_IDS), "node", "left_anti")
        rows = _level(active, level, now, old, similarity, last, True)
        rows = stored(rows.join(fits_broadcast(compared, BROADCAST_IDS), "node"), "near-level")
        flagged.append(_flagged(rows.where(F.col("n") <= leaf)))
        rows = rows.drop("n")
        if not large.where(few).isEmpty():
            flagged.append(_flagged(_around_main(rows, large.where(few), block)))
        blocks = large.where(many & ~branches).select("node", "n")
        if not blocks.isEmpty():
            flagged.append(_flagged(_block_pairs(rows, blocks, block)))
        if mixed.isEmpty():
            break
        touched = _level(active, level, now, old, similarity, last, False)
        touched = stored(touched.join(fits_broadcast(mixed.select("node"), BROADCAST_IDS), "node", "left_semi")
                         .select("rep").distinct(), "near-touched")
        n_touched = touched.count()
        if n_touched < 0.8 * n_active:
            active, n_active = stored(active.join(touched, "rep", "left_semi"), "near-active"), n_touched
        # What this level has found gives those that go deeper their labels.
        links = links.unionByName(_linked(functools.reduce(DataFrame.unionByName, flagged), docs, k, percent))
        active = stored(_labelled(active.drop("label"), components(links)), "near-active")
        flagged, last, old = [], mixed, now
    return links.unionByName(_linked(functools.reduce(DataFrame.unionByName, flagged), docs, k, percent)) if flagged else links


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the label of their class: its component so far, or itself."""
    known = labels.select(F.col("node").alias("rep"), F.col("component").alias("label"))
    return rows.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def _main_labels(rows: DataFrame) -> DataFrame:
    """For each node of ``rows`` (node, label, n): n, its most frequent label and the members outside that."""
    return (rows.groupBy("node", "label").agg(F.count("*").alias("of"), F.max("n").alias("n"))
            .groupBy("node").agg(F.max("n").alias("n"), F.max(F.struct("of", "label")).alias("most"))
            .select("node", "n", F.col("most.label").alias("main"), (F.col("n") - F.col("most.of")).alias("others")))


def _head_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b), at most two a class, of classes and the first members of their nodes, other labels each.

    First is first by a hash that ``turn`` changes.
    """
    tokens = F.struct("s0", "s1", "s2", "s3")
    heads = rows.groupBy("node").agg(
        F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("rank"), "rep", "label", tokens.alias("s"))).alias("head"))
    met = (rows.join(heads, "node").where(F.col("label") != F.col("head.label"))
           .withColumn("same", _matches(tokens, F.col("head.s"))).where(F.col("same") >= MIN_MATCHES)
           .groupBy("rep").agg(F.max(F.struct("same", "head.rank", "head.rep")).alias("best"),
                               F.min(F.when(F.col("same") >= LIKELY_MATCHES, F.struct("head.rank", "head.rep")))
                               .alias("common")))
    return (met.select("rep", F.explode(F.array("best.rep", "common.rep")).alias("other")).where("other IS NOT NULL")
            .select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct())


def _around_main(rows: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """Large nodes with few members outside their main label: the main ones in blocks,
    the few, at most ``LEAF / 4``, in each of them."""
    dealt = (rows.join(nodes.select("node", "n", "main"), "node")
             .withColumn("m", F.ceil(F.col("n") / block).cast("int"))
             .withColumn("to", F.when(F.col("label") == F.col("main"), F.array(
                 F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("m") - 1)))
             .withColumn("to", F.explode("to")))
    return dealt.withColumn("node", F.xxhash64("node", "to")).select("node", "rep", "label", "s0", "s1", "s2", "s3")


def _block_pairs(rows: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """Large nodes as groups of two blocks each, so that every two members meet in one."""
    dealt = (rows.join(nodes, "node").withColumn("m", F.ceil(F.col("n") / block).cast("int"))
             .withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1))))
    met = dealt.withColumn("node", F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")))
    return met.select("node", "rep", "label", "s0", "s1", "s2", "s3")


def near_copies(docs: DataFrame, k: int = 5, percent: int = 80, trees: int = TREES, leaf: int = LEAF,
                levels: int = LEVELS, pairs_each: int = PAIRS_EACH, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    Documents whose sets of ``k``-word shingles have a Jaccard similarity of
    ``percent`` / 100 or more are linked; a component's id is its smallest doc_id.

    NULL, empty and blank texts have no shingles and link with nothing; a text of fewer
    than ``k`` words is one shingle. Rows that share a doc_id are one node, each with
    its own n_shingles. A row without doc_id has no component, links with nothing and
    is kept. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    signed = stored(docs.mapInArrow(_sign(k), _SIGNED), "near-signed")
    reps = stored(signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "f1", "f2")
                  .agg(F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig")), "near-classes")
    links = near_links(reps.select("rep", "sig"), docs, k, percent, trees, leaf, levels, pairs_each, block)
    whole = components(links)
    class_of = (reps.select("n_shingles", "f1", "f2", "rep").join(whole.withColumnRenamed("node", "rep"), "rep", "left")
                .select("n_shingles", "f1", "f2", F.coalesce("component", "rep").alias("component_id")))
    out = signed.select("doc_id", "n_shingles", "f1", "f2").join(class_of, ["n_shingles", "f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
