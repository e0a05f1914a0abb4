"""Registry of named queries over the driver tables, each with its SQL twin.

A query is a function ``(spark, sf_dir) -> DataFrame`` that reads the given
tables and runs one of our operators over them, whole. When an equivalent
plain-SQL statement exists it is registered next to it so that any SQL engine
can check our result; operators without one (model fitting, seeded hashing)
are registered without SQL and checked by invariants in the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    ids: tuple[str, ...]
    sql: str | None = None
    headline: bool = False
    tags: tuple[str, ...] = field(default_factory=tuple)


_QUERIES: dict[str, Query] = {}


def register(name: str, ids: str | tuple[str, ...], sql: str | None = None, headline: bool = False):
    """Decorator registering ``fn`` as query ``name`` covering inventory ``ids``."""
    ids_t = (ids,) if isinstance(ids, str) else tuple(ids)

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = Query(name, fn, ids_t, sql.strip() if sql else None, headline)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # Importing the plan modules fills the registry.
    from tarmac.plans import batch, live, ml, prep, reporting, streams, windows  # noqa: F401

    return dict(_QUERIES)


def sql_round(expr: str, scale: int = 2) -> str:
    """SQL for HALF_UP rounding of a double exactly as Spark's ``round`` does.

    Spark rounds the shortest decimal representation of the double; going
    through text reproduces that (a plain double ``round`` differs on ties).
    """
    return f"round(({expr})::varchar::decimal(38,18), {scale})::double"


def sql_unit(key_sql: str, seed: int) -> str:
    """SQL twin of ``unit_hash(key, "md5", seed)``: a value in [0, 1) from the
    first 32 bits of ``md5("<seed>:<key>")``."""
    return (f"('0x' || substr(md5('{seed}:' || ({key_sql})::VARCHAR), 1, 8))::BIGINT::DOUBLE"
            f" / 4294967296.0::DOUBLE")
