"""Usage-versus-billing reconciliation on the public Spark DataFrame API.

Layers:
  sources/    fixtures derived from testdata, file/table ingest, JSON envelope
  functions/  column-level logic: cleaning, rating, calendar, classification
  operators/  frame-level logic: expectations, dedup, SCD1, reconcile join, summary, layout
  streaming/  Structured Streaming runners (availableNow) over the same functions
  plans/      the batch pipeline, the query registry and the DuckDB oracles
"""

from reconlake.session import ensure_session, get_session, scratch_path

__all__ = ["ensure_session", "get_session", "scratch_path"]
