"""Registered queries: the engine run over the given tables, each with an equivalent SQL."""

from workload import checks, deliveries, galaxy, operators  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
