"""Registered queries of the engine over the benchmark tables, and the same results in SQL."""
