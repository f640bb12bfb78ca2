"""quarry: analytics operators written on Spark DataFrames and MLlib.

Sub-packages
------------
sources    typed file ingest and sinks (CSV, JSON, Parquet, delimited text, images)
functions  column-expression helpers (casts, ratios, timestamps, hash splits)
operators  shaping, graph, features, text, models, clustering, recommendation,
           tuning and evaluation operators; every one takes and returns DataFrames
plans      inputs derived from the driver tables and plan inspection helpers
"""

from quarry.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
