"""All registered queries of this subpackage."""

from crmflow.llm import queries_counts, queries_layout, queries_near, queries_scan, queries_text, queries_web, queries_words  # noqa: F401  (they register queries)
from crmflow.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
