"""Jobs composed of the operators: ingest, replay, details."""
