"""stayglass: lodging-price analytics as composable Spark DataFrame operators.

Sub-packages
------------
functions   Column expressions (parsing, dates, geography, buckets, rules)
operators   DataFrame -> DataFrame building blocks (cleaning, joins, features, profiles, splits)
sources     scans and sinks (drifting CSV, captured JSON / HTML, split and model stores)
plans       composed jobs from scan to sink, and the model training jobs
streaming   Structured Streaming ingest and daily volumes
catalog     the registered queries and their SQL counterparts
"""
