"""Scans, sinks and ingest.

``files`` (parquet/CSV scans, tolerant and quote-repairing CSV, module folders,
append / full-refresh writes), ``manifest`` (dataset manifest expansion,
ingest with a status report), ``catalog`` (resource selection, link discovery).
"""
