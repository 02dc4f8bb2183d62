"""All registered queries."""

from bindings import catalogs, graphs, harvests, logs, merges, prompts, usages, vectors  # noqa: F401
from bindings.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
