"""Marts, reports, narratives, dashboards and the ingest flow.

A mart is ``mart(tables, months=None) -> DataFrame``: ``tables`` maps the core
table names to DataFrames, ``months`` restricts every input before any join or
aggregate (a filter on the result of a full alignment could not be pushed that
far by the optimizer).
"""
