"""riskframe: daily portfolio analytics as Spark DataFrame plans.

Layout
------
functions/   column-level helpers (cleaning expressions, window specs)
sources/     payload parsing, file scans, universe filters
operators/   DataFrame -> DataFrame transforms (prices, positions, metrics, ...)
sinks/       parquet writers and the upsert (merge) primitive
plans/       incremental state, multi-step jobs, fixtures and the query catalog
streaming/   file-stream ingestion (availableNow)
"""

__version__ = "0.1.0"
