"""DataFrame operators of the warehouse.

``joins`` (size-checked broadcast, anti join, row bounds), ``keys`` (dense
surrogate keys), ``dims`` (dimension loads, lookups, time dimension),
``facts`` (star lookups, integrity report), ``gold`` (dashboards, KPI views,
string aggregation), ``reshape`` (column selection, unpivot), ``schema``
(profile, widen, reconcile, align), ``modules`` (normalise, merge, split),
``profiling`` (functional dependencies, keys, 2NF).
"""
