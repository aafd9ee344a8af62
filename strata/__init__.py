"""strata: layered (bronze -> silver -> gold) analytics tables on Spark DataFrames.

Sub-packages:

* ``sources``   - file scans, tolerant CSV, manifest ingest, catalog / link selection, sinks
* ``functions`` - Column -> Column helpers (try-convert, key normalisation, name cleaning, ...)
* ``operators`` - schema fitting/widening, surrogate keys, dimension and fact loads,
                  unpivot, dashboards, module merge/split, dependency profiling
* ``plans``     - declarative specs wired into whole warehouse loads, plus the
                  queries registered in ``__spark_entry__``
"""

from strata.session import build_session, cut_lineage, ensure_checkpoint_dir, materialize

__all__ = ["build_session", "cut_lineage", "ensure_checkpoint_dir", "materialize"]
