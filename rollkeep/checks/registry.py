"""Registered queries: one Spark callable and, where plain SQL can say it, one oracle text each."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rollkeep.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its oracle SQL."""

    def add(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add
