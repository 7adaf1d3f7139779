"""Column expressions shared by ingest and plans."""
