"""tunefold: a music-catalogue analytics engine on Spark DataFrames.

Nested-JSON playlist pages and artist documents are flattened into ``tracks``,
``albums`` and ``artists``; tables are loaded by insert, keyed upsert or full
replace (batch or micro-batch stream); five analytic views answer questions
over them; each run is recorded in an append-only run log.
"""

__version__ = "0.1.0"
