"""End-to-end jobs: ingest of raw files, and the registered queries over the provided tables."""
