"""touchline — marketing analytics (bronze → silver → gold, multi-touch
attribution, KPI views, cohorts, funnels, data quality) as Spark DataFrame
operators.

Sub-packages:

* ``functions``  column-level helpers (cleaners, integer mean, safe division,
  month arithmetic, US week numbers)
* ``sources``    bronze text scans, silver feed specs, load jobs, the binding of
  the driver's TPC-H-like tables to the marketing star schema
* ``operators``  dimensions, facts, attribution, profiling, quality checks,
  magnitude / ranking / trend / KPI / LTV / funnel analyses
* ``plans``      the gold model (lazy star schema) and the registry of named
  queries used by ``__spark_entry__`` and ``bench.py``
* ``streaming``  incremental bronze landing with Structured Streaming
"""

__version__ = "0.1.0"
