"""plantlake: plant-operations analytics as Spark DataFrame operators.

Layers: ``sources`` (CSV, point files, message streams), ``operators``
(silver, gold, metrics, serving, governance, tools, quality, diagnostics),
``functions`` (column expressions), ``plans`` (batch pipeline, sinks, query
registry) and ``streaming`` (file stream ingest, dedup, hourly window).
"""

__version__ = "0.1.0"
