"""All registered queries of this subpackage."""

from lakemart.llm import queries_dedup, queries_manifest, queries_prints, queries_quality, queries_runs, queries_tokens, queries_vectors, queries_web  # noqa: F401
from lakemart.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
