"""Stand-in tables, registered queries and their oracle SQL."""

from rollkeep.checks import commuting, enrolling, filings, grouping, selection  # noqa: F401
from rollkeep.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
