"""Operators for preparing language-model training text on Spark.

Nothing outside this package imports it; ``queries.py`` names its registered
queries and ``sql.py`` their DuckDB counterparts.
"""
