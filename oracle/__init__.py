"""Independent DuckDB SQL for every registered query (the correctness oracle).

The driver pre-registers the base tables as views; each query text below starts
with the CTE chain that derives the raw marketplace datasets and the silver/gold
tables from them, written directly in SQL (not generated from the Spark code).
"""

from .sql import oracle_queries  # noqa: F401
