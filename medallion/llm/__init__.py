"""Operations of a training-data pipeline over the ``documents``-like tables.

Ten operators (one module each), the queries that apply them to whole tables
(:mod:`medallion.llm.queries`) and their DuckDB statements
(:mod:`medallion.llm.oracle`). Nothing outside this package imports it.
"""
