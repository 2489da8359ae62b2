"""DuckDB texts that re-derive each registered query from the raw tables.

They are written independently of the Spark plans (often in another shape:
full outer joins where Spark uses one conditional aggregate, UNION ALL where
Spark uses unpivot) so that a shared mistake is unlikely.
"""
