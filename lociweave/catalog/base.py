"""Small helpers shared by the query families."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn
    return add


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Doubles rounded as the check rounds them; -0.0 becomes 0.0."""
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), places) + F.lit(0.0))
    return df


def rnd(expr: str, places: int = 6) -> str:
    return f"(round({expr}, {places}) + 0.0)"
