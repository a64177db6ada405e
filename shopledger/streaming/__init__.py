"""Continuous ingest. An extension: the original flow is a scheduled batch."""
