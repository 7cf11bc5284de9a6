"""Named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from brindle.catalog import joins, layout, logs, metrics, relational, skew  # noqa: F401
    from brindle.catalog.registry import QUERIES

    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    all_queries()
    from brindle.catalog.registry import ORACLES

    return dict(ORACLES)
