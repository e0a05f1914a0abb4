"""Deterministic de-duplication and latest-row-per-key (SET3, SET4).

The batch forms are one aggregate over the key with ``min``/``max`` of a struct
that leads with the ordering columns. The aggregate combines partially on the
map side, so a key that holds a large share of the rows costs one row per
task in the shuffle (a ``row_number`` window would sort the whole hot key in
one task). The survivor is fully determined: ties on the order columns are
broken by the remaining columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.roles import require_columns


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), keep: str = "first",
           tasks: int | None = None) -> DataFrame:
    """One row per ``keys``: the first (smallest) or last (largest) by ``order``.

    ``tasks`` spreads the rows over that many tasks instead of the session's shuffle width, and sorts them
    once, there. Rows then travel uncombined: it is meant for large tables whose keys have few copies each.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    keys = list(keys)
    order = [c for c in order if c not in keys]
    require_columns(df, *keys, *order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    if tasks:
        df = df.repartition(tasks, *keys)
    if not order and not rest:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c) for c in [*order, *rest]])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    out = df.groupBy(*keys).agg(pick.alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def latest_by(df: DataFrame, key: str | Sequence[str], ts: str) -> DataFrame:
    """The row with the greatest ``ts`` per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return dedupe(df, keys, order=[ts], keep="last")


def dedupe_within_watermark(df: DataFrame, keys: Sequence[str], ts: str, watermark: str) -> DataFrame:
    """One row per ``keys`` of a stream: the first to arrive; later ones go as they arrive.

    The state holds a key until the watermark has passed its event time by the delay, so it is
    bounded by the events of that span; copies must not be further apart than the watermark's
    delay. On a batch frame this is :func:`dedupe` by event time.
    """
    require_columns(df, *keys, ts)
    if not df.isStreaming:
        return dedupe(df, keys, order=[ts])
    return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))
