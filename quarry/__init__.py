"""quarry: tabular data jobs (ingest, clean, profile, check, book, alert,
forecast, model) written as Spark DataFrame / SQL / ML / Structured
Streaming operators.  Every operator takes and returns DataFrames."""

__version__ = "0.1.0"
