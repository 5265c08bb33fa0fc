"""tidylake: raw files -> clean tables -> enriched tables, as Spark DataFrame functions.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``) and only declares a logical plan; Catalyst and AQE choose the
physical strategy.  Sub-packages:

* ``tidylake.sources``   - CSV (typed / header-verified / layout variants),
  Parquet (partition-aware), file discovery, HTML table extraction.
* ``tidylake.sinks``     - CSV and Parquet writers, counted writes.
* ``tidylake.functions`` - column expressions (labels, text cleaning, time).
* ``tidylake.operators`` - DataFrame operators (projection, cleaning, dedup,
  lookups, enrichment, union).
* ``tidylake.plans``     - the raw -> silver -> gold flows and the airport
  movement configuration.
* ``tidylake.streaming`` - incremental (Structured Streaming) ingestion of the
  raw layer with the same operators.
"""

__version__ = "0.1.0"
