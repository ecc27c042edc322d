"""Query registry: a name, a function of (spark, folder), and matching SQL if any."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name!r} is registered twice")
        _queries[name] = run
        if sql is not None:
            _oracles[name] = sql
        return run

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)
