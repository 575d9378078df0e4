"""Plain SQL formulations of the registered queries, for a single-node engine to check against."""
