"""Queries on the driver's tables; importing any of them registers all."""

from fundsieve.plans import audit, extraction, queries, search  # noqa: F401
