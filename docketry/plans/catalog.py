"""All queries of the core; importing the modules registers them."""

from docketry.plans import extract_queries, history_queries, mention_queries, pipeline_queries, quality_queries, read_queries, relational_queries, record_queries, report_queries, review_queries, statute_queries, stream_queries  # noqa: F401
from docketry.plans.registry import CORE

__all__ = ["CORE"]
