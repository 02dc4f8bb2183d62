"""Catalog, property-graph, vector-search and query-log analytics on Spark DataFrames."""
