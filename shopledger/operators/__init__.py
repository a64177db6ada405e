"""DataFrame-to-DataFrame steps shared by the marts and the ingest flow."""
