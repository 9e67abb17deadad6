"""Registered queries over the driver tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` registered with
:func:`register` together with an equivalent DuckDB SQL text (the oracle), or
``None`` when the operator is not SQL-expressible (writes, streams, file metadata).
Importing this package imports every plan module, which fills :data:`REGISTRY`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, oracle.strip() if oracle else None)
        return fn
    return deco


def _load_all() -> None:
    from . import (  # noqa: F401
        agg_plans,
        asset_plans,
        bridge_plans,
        dim_plans,
        filter_plans,
        incremental_plans,
        json_plans,
        join_plans,
        ledger_plans,
        market_plans,
        movement_plans,
        price_plans,
        quality_plans,
        scalar_plans,
        set_plans,
        source_plans,
        stream_plans,
        window_plans,
    )


_load_all()
