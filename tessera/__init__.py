"""tessera: batch analytics jobs written as plain DataFrame -> DataFrame functions.

Layout
------
sources/    readers (tolerant positional text, quoted multi-line CSV, globbed and
            header-inferred CSV, word lists, parquet tables) and writers
functions/  Column -> Column helpers built only from pyspark.sql.functions
operators/  reusable relational building blocks (dimension lookups, grouped
            means, conditional means, tag explosion, text pipeline, top-k)
plans/      the composed jobs bound to concrete tables, plus their oracle SQL
streaming/  the same text jobs driven by Structured Streaming file sources

Nothing in the package creates a session, collects a data-sized result to the
driver, or registers a Python UDF; Catalyst and adaptive execution choose the
physical plan.
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
