"""Composite plans: materialization, replay, reports, ingest, archive."""
