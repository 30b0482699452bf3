"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrella.plans.views import Tables

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function from tables to a result, with equivalent SQL if there is any."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(fn):
        return lambda spark, folder: fn(Tables(spark, folder))

    return {name: bound(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def drawn_bits_sql(hex_digits: int, *parts: str | int) -> str:
    """The counterpart of ``functions.numeric.drawn_bits`` for SQL expressions."""
    texts = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"CAST('0x' || substr(md5(concat_ws('-', {texts})), 1, {hex_digits}) AS BIGINT)"


def uniform_sql(id_column: str, seed: int, stream: int = 0) -> str:
    """The counterpart of ``sources.generators.uniform``."""
    return f"((CAST({drawn_bits_sql(13, id_column, seed, stream)} AS DOUBLE) + 5e-1) / {1 << 52}e0)"


def normal_sql(id_column: str, seed: int, stream: int = 0) -> str:
    """The counterpart of ``sources.generators.normal``."""
    first, second = uniform_sql(id_column, seed, 2 * stream), uniform_sql(id_column, seed, 2 * stream + 1)
    return f"(sqrt(-2e0 * ln({first})) * cos(2e0 * pi() * {second}))"
