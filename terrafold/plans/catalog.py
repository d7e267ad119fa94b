"""All registered queries."""

from __future__ import annotations

from terrafold.plans import (  # noqa: F401  (importing registers)
    aggregates,
    filters,
    functions,
    joins,
    layouts,
    loads,
    scans,
)
from terrafold.plans.registry import ORACLES, QUERIES, Query
from terrafold.workspace import attach


def _attached(fn: Query) -> Query:
    def run(spark, sf_dir):
        attach(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _attached(fn) for name, fn in QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
