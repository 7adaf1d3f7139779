"""Sources and sinks: text-line ingest with rejects, delimited review files,
stopword lists, result writers, and the parquet test-table adapter."""
