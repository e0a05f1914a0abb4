"""Batch delay analytics: labelled counts, rankings, grouped statistics, contrasts.

Every operator is DataFrame-in / DataFrame-out and takes its column roles as
arguments. All aggregates are declarative (partial aggregation before the
shuffle), so a hot key that holds a large share of the rows is combined on
the map side and never lands whole on one reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.scalar import exact_mean
from tarmac.roles import col_of, require_columns
from tarmac.schema import DELAY_COUNT_COL, GROUP_COUNT_COL

Predicate = str | Column


def _predicate(p: Predicate) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def label_is(label: Predicate, value: int = 1) -> Column:
    """``label == value`` for a 0/1 label column name, or a boolean predicate as is.

    A predicate (Column) selects the positive class; ``value=0`` negates it.
    NULL labels match neither class.
    """
    if isinstance(label, str):
        return F.col(label) == F.lit(value)
    return label if value == 1 else ~label


def apply_filters(df: DataFrame, predicates: Iterable[Predicate] = ()) -> DataFrame:
    """AND a list of SQL predicates (``"PRCP > 0"``) or Columns onto ``df``.

    Works unchanged on streaming frames. Catalyst merges the chain into one
    filter and pushes the column comparisons into the Parquet scan.
    """
    for p in predicates:
        df = df.filter(_predicate(p))
    return df


def _key_cols(key: str | Column | Sequence[str | Column]) -> list[Column]:
    keys = key if isinstance(key, (list, tuple)) else [key]
    return [col_of(k) for k in keys]


def labelled_rows(df: DataFrame, label: Predicate, where: Iterable[Predicate] = ()) -> DataFrame:
    """Rows of the positive class, optionally further filtered (FLT1-FLT5)."""
    return apply_filters(df.filter(label_is(label, 1)), where)


def count_by(df: DataFrame, key: str | Column | Sequence[str | Column] | None, label: Predicate,
             top_n: int | None = None, where: Iterable[Predicate] = (),
             count_col: str = DELAY_COUNT_COL) -> DataFrame:
    """Positive-class rows per key.

    Without ``top_n`` the result is ordered by key; with it, the ``top_n`` keys
    with most rows, ties broken by the key (planned as TakeOrderedAndProject:
    a per-partition top-n, never a full sort). Without a key the filtered rows
    themselves are returned.
    """
    rows = labelled_rows(df, label, where)
    if key is None:
        return rows
    keys = _key_cols(key)
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    names = counted.columns[: len(keys)]
    if top_n:
        return counted.orderBy(F.col(count_col).desc(), *[F.col(n).asc() for n in names]).limit(top_n)
    return counted.orderBy(*[F.col(n).asc() for n in names])


def count_by_dimensions(df: DataFrame, keys: Sequence[str | Column], label: Predicate,
                        where: Iterable[Predicate] = (), count_col: str = DELAY_COUNT_COL) -> DataFrame:
    """Positive-class rows per value of each key, for several keys in one pass.

    One scan, one ``GROUPING SETS`` aggregate (each row is expanded once per
    key before the map-side partial count, then a single shuffle), instead of
    one scan and one shuffle per key. Long format: ``dimension`` (key name),
    ``value`` (key value as text), count.
    """
    rows = labelled_rows(df, label, where).select(*[col_of(k) for k in keys])
    names = rows.columns
    flags = [F.grouping(n).alias(f"_g{i}") for i, n in enumerate(names)]
    grouped = rows.groupingSets([[n] for n in names], *names).agg(F.count(F.lit(1)).alias(count_col), *flags)
    dim, value = None, []
    for i, n in enumerate(names):
        hit = F.col(f"_g{i}") == 0
        dim = F.when(hit, F.lit(n)) if dim is None else dim.when(hit, F.lit(n))
        value.append(F.when(hit, F.col(n).cast("string")))
    return grouped.select(dim.alias("dimension"), F.coalesce(*value).alias("value"), F.col(count_col))


def top_n_by(df: DataFrame, key: str | Column | Sequence[str | Column], label: Predicate, n: int = 10,
             where: Iterable[Predicate] = (), count_col: str = DELAY_COUNT_COL) -> DataFrame:
    """The ``n`` keys with the most positive-class rows."""
    return count_by(df, key, label, top_n=n, where=where, count_col=count_col)


def group_stats(df: DataFrame, key: str, measure: str, scale: int = 2,
                count_col: str = GROUP_COUNT_COL, mean_decimals: int | None = None) -> DataFrame:
    """Rounded mean/min/max/sample stddev of ``measure`` and row count per key.

    Sorted by row count (descending), then key. A one-row group has a NULL
    stddev. Unknown columns raise ``ValueError``. ``mean_decimals``: exact
    fixed-point mean (see :func:`tarmac.functions.scalar.exact_mean`).
    """
    require_columns(df, key, measure)
    m = F.col(measure)
    stats = df.groupBy(key).agg(
        F.round(exact_mean(m, mean_decimals), scale).alias(f"average_{measure}"),
        F.round(F.min(m), scale).alias(f"min_{measure}"),
        F.round(F.max(m), scale).alias(f"max_{measure}"),
        F.round(F.stddev_samp(m), scale).alias(f"stddev_{measure}"),
        F.count(F.lit(1)).alias(count_col),
    )
    return stats.orderBy(F.col(count_col).desc(), F.col(key).asc())


def summary(df: DataFrame, measure: str, scale: int | None = None) -> DataFrame:
    """One row: global min, max, mean and sample stddev of ``measure``."""
    require_columns(df, measure)
    m = F.col(measure)

    def r(c: Column) -> Column:
        return F.round(c, scale) if scale is not None else c

    return df.agg(
        r(F.min(m)).alias(f"min_{measure}"),
        r(F.max(m)).alias(f"max_{measure}"),
        r(F.avg(m)).alias(f"mean_{measure}"),
        r(F.stddev_samp(m)).alias(f"stddev_{measure}"),
    )


def avg_by_period(df: DataFrame, period: str | Column, measures: Sequence[str], label: Predicate | None = None,
                  scale: int = 2, aliases: dict[str, str] | None = None,
                  mean_decimals: int | None = None) -> DataFrame:
    """Rounded means of ``measures`` per period over positive-class rows, ordered by period."""
    aliases = aliases or {}
    rows = df.filter(label_is(label, 1)) if label is not None else df
    out = rows.groupBy(col_of(period)).agg(
        *[F.round(exact_mean(F.col(m), mean_decimals), scale).alias(aliases.get(m, f"avg_{m}")) for m in measures]
    )
    return out.orderBy(out.columns[0])


def avg_by_keys(df: DataFrame, keys: Sequence[str | Column], measure: str, n: int | None = 10,
                scale: int = 2, alias: str | None = None, mean_decimals: int | None = None) -> DataFrame:
    """Rounded mean of ``measure`` per key combination, highest first, top ``n``."""
    name = alias or f"avg_{measure}"
    out = df.groupBy(*_key_cols(keys)).agg(F.round(exact_mean(F.col(measure), mean_decimals), scale).alias(name))
    key_names = out.columns[:-1]
    ordered = out.orderBy(F.col(name).desc_nulls_last(), *[F.col(k).asc() for k in key_names])
    return ordered.limit(n) if n else ordered


def contrast(df: DataFrame, label: Predicate, measures: Sequence[str], scale: int = 2,
             suffixes: tuple[str, str] = ("delayed", "on_time"), stems: dict[str, str] | None = None,
             mean_decimals: int | None = None) -> DataFrame:
    """Means of ``measures`` for the positive and the negative class, in one pass.

    ``avg(when(positive, m))`` and ``avg(when(negative, m))`` side by side: a
    single scan with one global partial aggregate, instead of two filtered
    scans. Rows with a NULL label count in neither class. Output columns are
    ``avg_<stem>_<suffix>``; the stem defaults to the measure name.
    """
    stems = stems or {}
    pos, neg = label_is(label, 1), label_is(label, 0)
    aggs = []
    for m in measures:
        stem = stems.get(m, m)
        aggs.append(F.round(exact_mean(F.when(pos, F.col(m)), mean_decimals), scale
                            ).alias(f"avg_{stem}_{suffixes[0]}"))
        aggs.append(F.round(exact_mean(F.when(neg, F.col(m)), mean_decimals), scale
                            ).alias(f"avg_{stem}_{suffixes[1]}"))
    return df.agg(*aggs)


def class_balance(df: DataFrame, label: Predicate, ratio: float = 3.0) -> DataFrame:
    """Class counts in one pass, plus the majority sampling fraction for ``ratio``:1.

    ``sample_fraction = min(1, ratio * positives / negatives)``; NULL when
    there is no negative row.
    """
    pos, neg = label_is(label, 1), label_is(label, 0)
    counts = df.agg(
        F.count_if(pos).alias("n_positive"),
        F.count_if(neg).alias("n_negative"),
    )
    return counts.select(
        "n_positive",
        "n_negative",
        (F.col("n_positive") + F.col("n_negative")).alias("n_labelled"),
        # least() skips NULLs, so the no-negative case is guarded explicitly
        F.when(F.col("n_negative") > 0,
               F.least(F.lit(1.0), F.lit(ratio) * F.col("n_positive") / F.col("n_negative"))
               ).alias("sample_fraction"),
        F.try_divide(F.col("n_negative").cast("double"), F.col("n_positive")).alias("imbalance"),
    )


def distinct_count(df: DataFrame, key: str | Column, alias: str = "n_distinct") -> DataFrame:
    """Number of distinct non-null values of ``key`` (one row)."""
    return df.agg(F.count_distinct(col_of(key)).alias(alias))


def distinct_values(df: DataFrame, key: str | Column) -> DataFrame:
    """Sorted distinct values of ``key`` (hash distinct, then range-partitioned sort)."""
    out = df.select(col_of(key)).distinct()
    return out.orderBy(out.columns[0])


def preview(df: DataFrame, n: int, key: str | Column, seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """``n`` pseudo-random rows, reproducible: ordered by a seeded hash of
    ``key`` (then the key itself).

    Planned as a per-partition top-n, so it never sorts the whole table and
    does not depend on partitioning (unlike ``sample`` + ``limit``).
    """
    from tarmac.functions.scalar import unit_hash

    k = col_of(key)
    return df.withColumn("_h", unit_hash(k, method, seed)).orderBy("_h", k).limit(n).drop("_h")
