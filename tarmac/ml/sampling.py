"""Train/test split and class-balancing sample (ML1, ML2, AGG12, SET1).

Both draw from a hash of a stable row key instead of a random generator: the
outcome of a row never depends on partitioning or on re-execution after an
executor loss (``randomSplit``/``sample`` can, which can leak rows between
train and test when a stage is recomputed). Neither needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.scalar import unit_hash
from tarmac.operators.metrics import Predicate, class_balance, label_is

SPLIT_SEED = 42
SAMPLE_SEED = 7


def _bounds(weights: Sequence[float]) -> list[float]:
    if not weights or any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    total = float(sum(weights))
    acc, out = 0.0, [0.0]
    for w in weights:
        acc += w
        out.append(acc / total)
    out[-1] = 1.0
    return out


def row_key(df: DataFrame, key: str | Column | None) -> Column:
    """The hashing key: ``key`` if given, else the whole row (identical rows
    then always land on the same side of a split, so duplicates cannot leak
    from train into test)."""
    if key is not None:
        return F.col(key) if isinstance(key, str) else key
    return F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns])


def split_column(key: str | Column, weights: Sequence[float] = (0.8, 0.2), names: Sequence[str] = ("train", "test"),
                 method: str = "xxhash64", seed: int = SPLIT_SEED) -> Column:
    """Name of the split each row falls in, from a hash of ``key``."""
    if len(names) != len(weights):
        raise ValueError("one name per weight")
    u = unit_hash(key, method, seed)
    b = _bounds(weights)
    expr = None
    for i, name in enumerate(names):
        cond = u < F.lit(b[i + 1]) if i < len(names) - 1 else F.lit(True)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def hash_split(df: DataFrame, key: str | Column | None, weights: Sequence[float] = (0.8, 0.2),
               method: str = "xxhash64", seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Disjoint parts of ``df`` whose union is ``df``, sized by ``weights``
    (``key=None`` hashes the whole row)."""
    u = unit_hash(row_key(df, key), method, seed)
    b = _bounds(weights)
    parts = []
    for i in range(len(weights)):
        lo, hi = b[i], b[i + 1]
        cond = u >= F.lit(lo) if i > 0 else F.lit(True)
        if i < len(weights) - 1:
            cond = cond & (u < F.lit(hi))
        parts.append(df.filter(cond))
    return parts


def undersample(df: DataFrame, label: Predicate, key: str | Column | None, ratio: float = 3.0,
                method: str = "xxhash64", seed: int = SAMPLE_SEED) -> tuple[DataFrame, float | None]:
    """Keep every positive row and a hash sample of negatives sized to about
    ``ratio`` negatives per positive (the union of the two classes, taken in
    one pass).

    The fraction ``min(1, ratio * positives / negatives)`` comes from one
    counting pass (a single one-row aggregate brought to the driver). Returns
    the balanced frame and the fraction (``None`` when there is no negative).
    """
    stats = class_balance(df, label, ratio).select("sample_fraction").first()
    fraction = stats["sample_fraction"] if stats else None
    pos, neg = label_is(label, 1), label_is(label, 0)
    if fraction is None:
        return df.filter(pos), None
    if fraction < 1.0:
        neg = neg & (unit_hash(row_key(df, key), method, seed) < F.lit(float(fraction)))
    # positives plus the sampled negatives: one filter, one scan (not a union of two)
    return df.filter(pos | neg), float(fraction)
