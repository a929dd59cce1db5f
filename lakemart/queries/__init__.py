"""All registered queries."""

from lakemart.queries import cleaning, intake, jobs, marts, recipes, tables, upkeep  # noqa: F401
from lakemart.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
