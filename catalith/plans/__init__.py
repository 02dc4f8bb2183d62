"""Plan shapes shared by the operators: ranking, nesting, sizing, lineage cuts."""
