"""Column-level helpers. All are built-in Spark expressions (codegen'd, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.roles import col_of


def percent(numerator: str | Column, denominator: str | Column, scale: int = 2) -> Column:
    """``numerator / denominator * 100`` rounded; NULL instead of an error on 0."""
    ratio = F.try_divide(col_of(numerator).cast("double"), col_of(denominator).cast("double"))
    return F.round(ratio * F.lit(100.0), scale)


_WHOLE = r"^\s*[+-]?[0-9]+\s*$"


def coerce_to(c: str | Column, dtype: T.DataType) -> Column:
    """Typed coercion of a raw text value.

    Integral targets truncate toward zero, so ``"65.7"`` becomes 65 (a plain
    int cast would give NULL); whole numbers are taken as they are, so ids
    beyond 2^53 stay exact. Blank and malformed text become NULL.
    """
    raw = col_of(c)
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        whole = dtype.simpleString()
        # Only what reads as a whole number is cast to one: a failed cast throws and catches for every value.
        return F.when(raw.cast("string").rlike(_WHOLE), raw.try_cast(whole)).otherwise(
            raw.try_cast("double").try_cast(whole))
    if isinstance(dtype, T.StringType):
        return raw.cast("string")
    return raw.try_cast(dtype.simpleString())


def ntz_to_instant(c: str | Column) -> Column:
    """A ``timestamp_ntz`` wall clock as the ``timestamp`` instant at that UTC
    wall clock, whatever the session time zone (windows on the result align
    exactly like windows on the wall clock). Apply to ``timestamp_ntz`` only."""
    return F.from_utc_timestamp(col_of(c).cast("timestamp"), F.current_timezone())


def instant_to_ntz(c: str | Column) -> Column:
    """Inverse of :func:`ntz_to_instant`: an instant's UTC wall clock as ``timestamp_ntz``."""
    return F.to_utc_timestamp(col_of(c), F.current_timezone()).cast("timestamp_ntz")


def event_time_of(df, c: str) -> Column:
    """Column ``c`` of ``df`` as a ``timestamp`` usable by ``withWatermark``:
    wall-clock ``timestamp_ntz`` is read as UTC, other types are cast."""
    if isinstance(df.schema[c].dataType, T.TimestampNTZType):
        return ntz_to_instant(c)
    return F.col(c).cast("timestamp")


def epoch_seconds(ts: str | Column) -> Column:
    """Whole epoch seconds of a ``timestamp`` instant, as long."""
    return F.unix_timestamp(col_of(ts))


def window_bounds(window_col: str = "window", ntz: bool = False) -> list[Column]:
    """Flatten a window struct into ``window_start`` / ``window_end``."""
    start = F.col(f"{window_col}.start")
    end = F.col(f"{window_col}.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return [start.alias("window_start"), end.alias("window_end")]


def geo_point(lon: str | Column, lat: str | Column) -> Column:
    """``(lon, lat)`` point in EPSG:4326 as a struct."""
    return F.struct(col_of(lon).cast("double").alias("lon"), col_of(lat).cast("double").alias("lat"))


def marker_size(total: str | Column, floor: float = 50.0, divisor: float = 5.0) -> Column:
    """Map marker size ``max(floor, total / divisor)``."""
    return F.greatest(F.lit(floor), col_of(total).cast("double") / F.lit(divisor))


def unit_hash(key: str | Column, method: str = "xxhash64", seed: int = 42) -> Column:
    """Deterministic value in [0, 1) derived from a key and a seed.

    ``xxhash64`` is the fast default. ``md5`` (first 32 bits of the hex
    digest of ``"<seed>:<key>"``) is slower but reproducible in other engines,
    which lets a split or sample be checked against plain SQL. Different
    seeds give independent draws for the same key.
    """
    k = col_of(key)
    if method == "xxhash64":
        return F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(1 << 32)).cast("double") / F.lit(float(1 << 32))
    if method == "md5":
        hex8 = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"))), 1, 8)
        return F.conv(hex8, 16, 10).cast("long").cast("double") / F.lit(float(1 << 32))
    raise ValueError(f"unknown hash method {method!r}; use 'xxhash64' or 'md5'")


def exact_mean(m: Column, decimals: int | None) -> Column:
    """Mean of ``m``; with ``decimals``, summed exactly as a fixed-point decimal.

    A double sum depends on summation order in its last bit, which decides
    HALF_UP rounding on exact ties (``33.325`` may come out as ``33.3249...``).
    For fixed-point measures (money, 2-decimal readings) summing as a decimal
    gives the true mean. ``None`` keeps Spark's double ``avg``.
    """
    if decimals is None:
        return F.avg(m)
    total = F.sum(m.cast(f"decimal(28,{decimals})")).cast("double")
    return F.try_divide(total, F.count(m).cast("double"))
