"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors have cosine ``c`` or more exactly if they are ``sqrt(2 - 2c)`` or less
apart. Vectors are turned to their principal axes and sorted by the grid cells, as wide as
that distance, of the leading ones. Runs of this order are blocks; two blocks are
compared only if cells of theirs touch and their bounding boxes over all axes are not
farther apart than that distance, and then recursively: an interval pair whose
bounding boxes are farther apart than the distance is skipped, a long one is halved,
and a short one compared exactly in double precision.

Equal vectors are one class first. Neither pairs of copies nor pairs of a
block leave a task: it returns, for each class, how many vectors it links and the
smallest id it reaches, and these links make the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored
from tarmac.llm.components import components, spanning_roots

COSINE = 0.93
#: Vectors that the principal axes are fitted on. Any rotation gives the same links.
AXES_SAMPLE = 4096
GRID_AXES = 4
#: Vectors in a block: what a task holds of either side.
BLOCK = 2048
#: Interval length from which the recursion compares instead of halving.
LEAF = 256


def _axes(classes: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """Rotations to principal axes, by dimension, from the vectors that hash lowest."""
    rows = classes.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("x").collect()
    found = {}
    for n in {len(r.x) for r in rows}:
        x = np.array([r.x for r in rows if len(r.x) == n])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        _, axes = np.linalg.eigh(x.T @ x)
        found[n] = np.ascontiguousarray(axes[:, ::-1])
    return found


def _project(axes, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, cells = [], []
            for x in batch.column("x").to_pylist():
                v = np.array(x, dtype=np.float64)
                v /= np.abs(v).max()  # so that no square overflows or vanishes
                v /= np.linalg.norm(v)
                turn = axes.value.get(len(v))
                v = v if turn is None else v @ turn
                vecs.append(v.tobytes())
                cells.append((np.floor(v[:GRID_AXES] / eps)).astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("m"), batch.column("grp"), pa.array(vecs, pa.binary()),
                 pa.array(cells, pa.list_(pa.int32()))], names=["rep", "m", "grp", "v", "cells"])
    return run


def _blocks(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Consecutive runs of one group, at most ``size`` long, packed into one row each."""
    held: list[pd.DataFrame] = []

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        v = b"".join(rows["v"])
        x = np.frombuffer(v, np.float64).reshape(len(rows), -1)
        two = sorted({(int(c[0]), int(c[1]) if len(c) > 1 else 0) for c in rows["cells"]})
        return pd.DataFrame({"block": [int(rows["rep"].iloc[0])], "grp": [rows["grp"].iloc[0]],
                             "reps": [rows["rep"].to_numpy(np.int64).tobytes()],
                             "ms": [rows["m"].to_numpy(np.int64).tobytes()], "vs": [v],
                             "xs": [[a for a, _ in two]], "ys": [[b for _, b in two]],
                             "lo": [x.min(axis=0)], "hi": [x.max(axis=0)]})

    for frame in frames:
        for _, part in frame.groupby((frame["grp"] != frame["grp"].shift()).cumsum(), sort=False):
            if held and held[0]["grp"].iloc[0] != part["grp"].iloc[0]:
                yield pack(pd.concat(held))
                held = []
            held.append(part)
            while sum(map(len, held)) >= size:
                rows = pd.concat(held)
                yield pack(rows.iloc[:size])
                held = [rows.iloc[size:]] if len(rows) > size else []
    if held:
        yield pack(pd.concat(held))


def _reach(cosine: float) -> float:
    """Squared distance, with room for rounding, beyond which no two unit vectors link."""
    return 2 - 2 * cosine + 1e-9


def box_gap(lo: str, hi: str, lo2: str, hi2: str) -> Column:
    """Squared distance of two boxes given by arrays of their least and largest coordinates."""
    apart = F.zip_with(F.zip_with(lo, hi2, lambda a, b: a - b), F.zip_with(lo2, hi, lambda a, b: a - b),
                       lambda a, b: F.greatest(a, b, F.lit(0.0)))
    return F.aggregate(apart, F.lit(0.0), lambda total, x: total + x * x)


class Side:
    """One block as arrays."""

    def __init__(self, reps: bytes, ms: bytes, vs: bytes):
        self.reps, self.m = np.frombuffer(reps, np.int64), np.frombuffer(ms, np.int64)
        self.v = np.frombuffer(vs, np.float64).reshape(len(self.reps), -1)


def link_blocks(a: Side, b: Side | None, cosine: float, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks, or within one if ``b`` is None, as places in a and b."""
    other = a if b is None else b
    eps2 = _reach(cosine)
    left, right = [], []
    box_a: dict[tuple[int, int], tuple] = {}
    box_b = box_a if b is None else {}

    def box(side: Side, held: dict, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        if (lo, hi) not in held:
            part = side.v[lo:hi]
            held[lo, hi] = part.min(axis=0), part.max(axis=0)
        return held[lo, hi]

    def join(lo: int, hi: int, lo2: int, hi2: int) -> None:
        if b is None and hi2 <= lo:
            return  # the other way round it is compared
        (l1, h1), (l2, h2) = box(a, box_a, lo, hi), box(other, box_b, lo2, hi2)
        gap = np.maximum(0, np.maximum(l1 - h2, l2 - h1))
        if gap @ gap > eps2:
            return
        if hi - lo <= leaf and hi2 - lo2 <= leaf:
            cos = a.v[lo:hi] @ other.v[lo2:hi2].T
            i, j = np.nonzero(cos >= cosine)
            i, j = i + lo, j + lo2
            if b is None:
                i, j = i[i < j], j[i < j]
            left.append(i)
            right.append(j)
            return
        if hi - lo >= hi2 - lo2:
            mid = (lo + hi) // 2
            join(lo, mid, lo2, hi2)
            join(mid, hi, lo2, hi2)
        else:
            mid = (lo2 + hi2) // 2
            join(lo, hi, lo2, mid)
            join(lo, hi, mid, hi2)

    join(0, len(a.reps), 0, len(other.reps))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                a = Side(r["reps"], r["ms"], r["vs"])
                b = None if r["block"] == r["block2"] else Side(r["reps2"], r["ms2"], r["vs2"])
                i, j = link_blocks(a, b, cosine)
                n = len(a.reps)
                reps = a.reps if b is None else np.concatenate([a.reps, b.reps])
                m = a.m if b is None else np.concatenate([a.m, b.m])
                j = j if b is None else j + n
                links = (np.bincount(i, weights=m[j], minlength=len(reps))
                         + np.bincount(j, weights=m[i], minlength=len(reps))).astype(np.int64)
                roots = reps[spanning_roots(len(reps), i, j, reps)]
                has = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(reps[has]), pa.array(links[has]), pa.array(roots[has])],
                                                 names=["rep", "links", "root"])
    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK,
                    sample: int = AXES_SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors`` (vec_id, embedding, label).

    Rows with equal labels and a cosine of ``cosine`` or more are linked. A vector links
    with nothing if it, its label or its id is NULL, or if it is empty, zero or
    has a NULL or non-finite component; it is its own component and kept. Only vectors
    of one dimension are compared. Rows with equal vectors are linked rows, each
    counted; rows that share an id are one node of the components. An empty table gives
    an empty result.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    valid = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
             & F.exists("embedding", lambda v: v != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.when(F.coalesce(valid, F.lit(False)), x).alias("x"), "label")
    rows = stored(rows.select("vec_id", "x", F.concat_ws(":", F.size("x"), "label").alias("grp"),
                              F.when(F.col("x").isNotNull(), F.xxhash64("label", "x")).alias("k1"),
                              F.xxhash64(F.lit(1), "x", "label").alias("k2")), "vectors")
    classes = stored(rows.where("x IS NOT NULL").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.any_value("x").alias("x"),
        F.any_value("grp").alias("grp")), "vector-classes")
    spark = vectors.sparkSession
    axes = spark.sparkContext.broadcast(_axes(classes, sample))
    eps = float(np.sqrt(2 - 2 * cosine))
    ordered = (classes.select("rep", "m", "grp", "x")
               .mapInArrow(_project(axes, eps), "rep long, m long, grp string, v binary, cells array<int>")
               .repartitionByRange("grp", "cells", "rep").sortWithinPartitions("grp", "cells", "rep"))
    blocks = stored(ordered.mapInPandas(
        lambda frames: _blocks(frames, block),
        "block long, grp string, reps binary, ms binary, vs binary, xs array<int>, ys array<int>, "
        "lo array<double>, hi array<double>"), "vector-blocks")
    # Blocks meet where a cell of one is a cell of the other or next to it, on the first two axes.
    cell = blocks.select("block", "grp", F.explode(F.arrays_zip("xs", "ys")).alias("c"))
    home = cell.select("block", "grp", F.col("c.xs").alias("x"), F.col("c.ys").alias("y"))
    step = F.explode(F.array(*map(F.lit, (-1, 0, 1))))
    near = (home.withColumn("dx", step).withColumn("dy", step)
            .select(F.col("block").alias("block2"), "grp", (F.col("x") + F.col("dx")).alias("x"),
                    (F.col("y") + F.col("dy")).alias("y")).distinct())
    pairs = home.join(near, ["grp", "x", "y"]).where("block <= block2").select("block", "block2").distinct()
    # Of these, the pairs with boxes too far apart go before any vectors travel; a box is two rows of a block's vectors.
    boxes = blocks.select("block", "lo", "hi")
    pairs = (pairs.join(boxes, "block").join(boxes.toDF("block2", "lo2", "hi2"), "block2")
             .where(box_gap("lo", "hi", "lo2", "hi2") <= _reach(cosine)).select("block", "block2"))
    data = blocks.select("block", "reps", "ms", "vs")
    both = pairs.join(data, "block").join(data.toDF("block2", "reps2", "ms2", "vs2"), "block2")
    both = both.select("block", "block2", "reps", "ms", "vs",
                       *(F.when(F.col("block") != F.col("block2"), F.col(c)).alias(c) for c in ("reps2", "ms2", "vs2")))
    links = stored(both.mapInArrow(_links(cosine), "rep long, links long, root long"), "vector-links")
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    whole = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    found = (classes.select("k1", "k2", "rep", "m").join(counts, "rep", "left")
             .join(whole.withColumnRenamed("node", "rep"), "rep", "left")
             .select("k1", "k2", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rep").alias("component")))
    out = rows.select("vec_id", "k1", "k2").join(found, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
