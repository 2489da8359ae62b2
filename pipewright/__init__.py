"""pipewright: sales-pipeline analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    table scans, CRM-shaped views, snapshot tables, sinks
functions  Column helpers: periods, null/zero rules, money, text, fixed dimensions
operators  reusable DataFrame operators (semi/anti joins, complete groups, top-N, merge, flatten)
plans      the report jobs (pipeline movement, scorecards, activities, velocity, enrichment, export)
oracle     DuckDB texts that re-derive every registered query independently
"""

from pipewright.session import get_spark  # noqa: F401
