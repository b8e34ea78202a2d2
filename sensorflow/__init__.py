"""sensorflow: sensor time-series ingest, quality and analytics on Spark DataFrames.

Subpackages:
  sources    readers, sinks, table maintenance (landing files, Parquet facts, CSV export)
  functions  column-expression helpers (time parsing, rounding, topics, sizes)
  operators  DataFrame -> DataFrame operators (quality, time series, reports, monitoring)
  streaming  Structured Streaming ingest and rollups
  plans      named queries over the test tables and their DuckDB oracles
"""

from sensorflow.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
__version__ = "0.1.0"
