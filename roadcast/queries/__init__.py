"""Registered queries over the driver's tables, with their SQL counterparts."""

from roadcast.queries import features, ingest, models, serving  # noqa: F401  (registers)
from roadcast.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
