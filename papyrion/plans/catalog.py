"""All queries of the library, gathered from the modules that define them."""

from papyrion.plans import class_queries, context_queries, extension_queries, search_queries, storage_queries, table_queries, text_queries
from papyrion.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "class_queries", "context_queries", "extension_queries", "search_queries", "storage_queries", "table_queries", "text_queries"]
