"""touchline: incremental ingest and entity resolution for sports payloads, on Spark.

Every public function takes and returns lazy DataFrames (or Columns); only the
writers in ``touchline.sinks`` and ``touchline.streaming`` run jobs.
"""

__version__ = "0.1.0"
