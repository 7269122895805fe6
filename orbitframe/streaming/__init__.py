"""Incremental ingest: new scenes in, touched pixels recomputed."""
