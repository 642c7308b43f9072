"""popcorr — entity popularity x market price correlation on Spark.

Every public function takes and returns a ``DataFrame`` so that steps chain
with ``df.transform(fn)``; nothing here collects table data to the driver.

Sub-packages
------------
sources    schemas, layer readers/writers, shaping of the driver tables
functions  column expressions (KPIs, labels, jitter, ids, rolling Pearson)
operators  relational steps (resolution, expansion, joins, model, serving)
plans      the user-facing compositions (format, combine, serve, enrich)
streaming  Structured Streaming live-quote refresh and keyed upsert sink
"""

__version__ = "0.1.0"
