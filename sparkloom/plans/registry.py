"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Each registered query reads full driver tables (or views Spark derives from them) and
returns a DataFrame whose column names and types equal those of its oracle SQL in
``sparkloom.plans.oracle``. Doubles that depend on summation order or on ``log``/``exp``
are rounded in both, and every ranking breaks ties by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}


def register(name: str) -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        return fn

    return wrap


def all_queries() -> dict[str, QueryFn]:
    # importing the modules fills QUERIES
    from sparkloom.plans import (  # noqa: F401
        eval_queries,
        model_queries,
        text_queries,
        topic_queries,
        trip_queries,
    )

    return dict(QUERIES)
