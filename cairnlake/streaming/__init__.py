"""The raw-ingest and landing streams."""
