"""Registered queries: (spark, sf_dir) → DataFrame.

Every query reads the driver's test tables through the fixture views
(``daybook.sources.fixtures``, written once per session as parquet tables in
the shared folder) and runs the package's own operators on them.
The run is that of FIXTURES.md: run date 2024-01-22, products P0–P3.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.params import Ledger, RunParams
from daybook.session import program_scope
from daybook.sources.fixtures import materialized_fixture_ledger

# Fixed values of the fixture run (FIXTURES.md).
RUN = RunParams.from_yyyymmdd("20240122", "'P0', 'P1', 'P2', 'P3'")

_REGISTRY: dict[str, Callable[[Ledger, RunParams], DataFrame]] = {}
_RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register ``fn(ledger, params) -> DataFrame`` under ``name``.  A function with a
    ``scope`` saves the frames that it uses more than once there."""
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def raw_query(name: str):
    """Register ``fn(spark, sf_dir) -> DataFrame`` (sources and sinks)."""
    def deco(fn):
        _RAW[name] = fn
        return fn
    return deco


def _bind(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        led = materialized_fixture_ledger(spark, sf_dir)
        return fn(led, RUN, scope=program_scope(spark)) if scoped else fn(led, RUN)

    scoped = "scope" in inspect.signature(fn).parameters
    run.__doc__ = fn.__doc__
    run.__name__ = fn.__name__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import daybook.queries  # noqa: F401  (fills the registry)
    out = {name: _bind(fn) for name, fn in _REGISTRY.items()}
    out.update(_RAW)
    return out
