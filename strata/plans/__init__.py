"""Spec instances and whole loads.

``revenue``, ``forms``, ``survey``: the three star schemas (dimension specs,
fact specs, dashboards); ``warehouse``: bronze staging and the silver-then-gold
load as parquet tables; ``standins``: bronze-shaped frames from the driver
tables; ``registry`` (+ ``ingest_queries``, ``profiling_queries``): the queries
exposed by ``__spark_entry__``, with their DuckDB twins in ``oracle`` and
``ingest_oracle``.
"""
