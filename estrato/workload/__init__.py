"""The registered queries: each operator over the given tables, with its SQL twin."""

from estrato.workload import (  # noqa: F401
    airline,
    basics,
    claims,
    cleaning,
    labels,
    quality,
    reports,
    stats,
    storage,
    tables,
)
from estrato.workload.registry import oracles, runnable

__all__ = ["oracles", "runnable"]
