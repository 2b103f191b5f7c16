"""Registered queries over the given tables, each with the SQL that checks it where SQL can."""

from folioforge.plans import audit, facts, history, landing, quality, returns, risk  # noqa: F401
from folioforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
