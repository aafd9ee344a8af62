"""Incremental dimension loads with dense surrogate keys.

A load is: project the source with the spec's expressions -> required-key
filter -> ``DISTINCT`` over all projected columns -> left-anti join against the
existing dimension on the natural key -> surrogate ids after the current
maximum -> append. ``DISTINCT`` is over all attributes while novelty is tested
on the key only, so one code arriving with two names in one batch yields two
rows; lookups therefore collapse the dimension to its lowest id per key
(``lookup_table``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.exprs import LOOKUP_KEY_CHARS, to_text_truncated
from strata.operators.joins import (
    DEFAULT_BROADCAST_MAX_ROWS,
    anti_join,
    bounded_broadcast,
    keep_row_bound,
    row_bound,
    set_row_bound,
    single_partition_if_bounded,
)
from strata.operators.keys import assign_surrogate_keys
from strata.session import cut_lineage


@dataclass(frozen=True)
class DimensionSpec:
    """Declarative dimension load.

    ``columns``: (output column, Spark SQL expression over the source row).
    ``key``: natural-key output columns. ``id_col``: surrogate id column, or
    ``None`` when the key itself is the id (computed keys such as ``YYYYMM``).
    ``require``: SQL predicates over the projected row (output names); default
    is every key column ``IS NOT NULL``. ``source_filter``: one SQL predicate
    over the source row, for conditions on columns the projection drops.
    """

    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    id_col: str | None = None
    require: tuple[str, ...] | None = None
    source_filter: str | None = None

    @property
    def output_columns(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.output_columns if c not in self.key]

    def predicates(self) -> tuple[str, ...]:
        if self.require is not None:
            return self.require
        return tuple(f"`{k}` IS NOT NULL" for k in self.key)

    def all_columns(self) -> list[str]:
        return ([self.id_col] if self.id_col else []) + self.output_columns


@dataclass
class DimensionLoad:
    dim: DataFrame
    inserted: DataFrame
    next_id: int = field(default=0)


def project_batch(source: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Projected, filtered, de-duplicated candidate rows of one batch."""
    if spec.source_filter:
        source = source.filter(F.expr(spec.source_filter))
    proj = source.select(*[F.expr(e).alias(c) for c, e in spec.columns])
    for pred in spec.predicates():
        proj = proj.filter(F.expr(pred))
    return proj.distinct()


_MAX_ID_ATTR = "_strata_max_id"


def _max_id(existing: DataFrame | None, id_col: str) -> int:
    if existing is None:
        return 0
    known = getattr(existing, _MAX_ID_ATTR, None)
    if known is not None:
        return known
    row = existing.agg(F.max(id_col).alias("m")).collect()[0]
    return int(row["m"] or 0)


def load_dimension(
    source: DataFrame,
    existing: DataFrame | None,
    spec: DimensionSpec,
    max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DimensionLoad:
    """Insert the batch's unseen natural keys into ``existing`` (may be ``None``)."""
    batch = project_batch(source, spec)
    if existing is not None:
        batch = anti_join(batch, existing, spec.key, max_broadcast_rows)
    if spec.id_col is None:
        # computed key (no surrogate): materialise once and record its size, so
        # later lookups and broadcasts need no count of their own
        new_rows = cut_lineage(batch)
        n = new_rows.count()
        if n <= max_broadcast_rows:
            new_rows = new_rows.coalesce(1)
        set_row_bound(new_rows, n)
        next_id = 0
    else:
        start = _max_id(existing, spec.id_col)
        order = list(spec.key) + spec.attributes
        new_rows = assign_surrogate_keys(batch, order, spec.id_col, start=start)
        next_id = start + (row_bound(new_rows) or 0)
    new_rows = keep_row_bound(new_rows.select(*spec.all_columns()), new_rows)
    if existing is None:
        full = new_rows
    else:
        full = existing.select(*spec.all_columns()).unionByName(new_rows)
        old, new = row_bound(existing), row_bound(new_rows)
        if old is not None and new is not None:
            set_row_bound(full, old + new)
    if spec.id_col is not None:
        setattr(full, _MAX_ID_ATTR, next_id)
    return DimensionLoad(full, new_rows, next_id)


def _finish_load(
    batch: DataFrame,
    existing: DataFrame | None,
    spec: DimensionSpec,
    batch_bound: int,
    max_broadcast_rows: int,
) -> DimensionLoad:
    """Anti-join, ids and append for a deterministic batch of at most ``batch_bound`` rows."""
    if existing is not None:
        batch = anti_join(batch, existing, spec.key, max_broadcast_rows)
    if spec.id_col is None:
        new_rows = batch.coalesce(1) if batch_bound <= max_broadcast_rows else batch
        set_row_bound(new_rows, batch_bound)
        max_id = None
    else:
        start = _max_id(existing, spec.id_col)
        order = list(spec.key) + spec.attributes
        new_rows = assign_surrogate_keys(batch, order, spec.id_col, start=start, known_max_rows=batch_bound)
        # the bound is only an upper bound (filters and the anti-join may drop
        # rows), so no maximum id is recorded; a later load computes it
        max_id = None
    new_rows = keep_row_bound(new_rows.select(*spec.all_columns()), new_rows)
    if existing is None:
        full = new_rows
    else:
        full = existing.select(*spec.all_columns()).unionByName(new_rows)
        old = row_bound(existing)
        if old is not None:
            set_row_bound(full, old + batch_bound)
    if max_id is not None:
        setattr(full, _MAX_ID_ATTR, max_id)
    return DimensionLoad(full, new_rows, max_id or 0)


# at most this many grouping columns in one pass (grouping_id is a 64-bit mask)
_MAX_GROUPING_COLUMNS = 60


def load_dimensions(
    source: DataFrame,
    specs: Sequence[DimensionSpec],
    existing: Mapping[str, DataFrame] | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> dict[str, DimensionLoad]:
    """Load several dimensions from one source in one pass.

    Every spec's projection (plus a flag for its source filter) is one grouping
    set of a single ``GROUPING SETS`` aggregation: the source is scanned once,
    each row is expanded once per dimension and combined map-side, and the
    distinct rows of all dimensions are checkpointed together and counted per
    dimension in one small job. Each dimension then continues as in
    ``load_dimension`` from its slice of the checkpoint.
    """
    existing = dict(existing or {})
    chunks: list[list[tuple[int, DimensionSpec]]] = [[]]
    width = 0
    for i, spec in enumerate(specs):
        n = len(spec.columns) + 1
        if chunks[-1] and width + n > _MAX_GROUPING_COLUMNS:
            chunks.append([])
            width = 0
        chunks[-1].append((i, spec))
        width += n
    out: dict[str, DimensionLoad] = {}
    for chunk in chunks:
        out.update(_load_chunk(source, chunk, existing, max_broadcast_rows))
    return out


def _load_chunk(source, chunk, existing, max_broadcast_rows) -> dict[str, DimensionLoad]:
    cols, sets, names_of = [], [], {}
    for i, spec in chunk:
        names = [f"__d{i}_{j}" for j in range(len(spec.columns))]
        flag = f"__ok{i}"
        cols += [F.expr(e).alias(n) for (_, e), n in zip(spec.columns, names)]
        cols.append((F.coalesce(F.expr(spec.source_filter), F.lit(False)) if spec.source_filter else F.lit(True)).alias(flag))
        sets.append([flag, *names])
        names_of[i] = names
    grouping = [c for s in sets for c in s]
    wide = source.select(*cols)
    distinct_rows = wide.groupingSets([[F.col(c) for c in s] for s in sets], *grouping).agg(
        F.grouping_id().alias("__gid")
    )
    staged = cut_lineage(distinct_rows)
    counts = {r["__gid"]: r["n"] for r in staged.groupBy("__gid").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = len(grouping)
    out: dict[str, DimensionLoad] = {}
    for (i, spec), s in zip(chunk, sets):
        gid = sum(1 << (n - 1 - k) for k, c in enumerate(grouping) if c not in s)
        rows = staged.filter((F.col("__gid") == gid) & F.col(f"__ok{i}")).select(
            *[F.col(nm).alias(c) for nm, (c, _) in zip(names_of[i], spec.columns)]
        )
        for pred in spec.predicates():
            rows = rows.filter(F.expr(pred))
        out[spec.name] = _finish_load(rows, existing.get(spec.name), spec, int(counts.get(gid, 0)), max_broadcast_rows)
    return out


def run_concurrently(tasks: Mapping[str, Callable[[], Any]], max_workers: int = 8) -> dict[str, Any]:
    """Run independent loads from a thread pool; Spark schedules their jobs side
    by side (each load is a few small jobs, so latency, not throughput, bounds it)."""
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(len(tasks), max_workers)) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}


def load_dimension_sources(
    sources: Iterable[tuple[DataFrame, DimensionSpec]],
    existing: DataFrame | None = None,
) -> DataFrame:
    """"First source wins": ordered loads into one dimension; each later source
    adds only keys no earlier source produced."""
    dim = existing
    for source, spec in sources:
        dim = load_dimension(source, dim, spec).dim
    if dim is None:
        raise ValueError("no sources given")
    return dim


def missing_members(dim: DataFrame, members: Sequence[Mapping[str, object]], key: Sequence[str]) -> DataFrame:
    """The fixed member rows whose key is not in ``dim`` (``IF NOT EXISTS ... INSERT``)."""
    rows = [tuple(m.get(f.name) for f in dim.schema.fields) for m in members]
    fixed = dim.sparkSession.createDataFrame(rows, dim.schema)
    keys = keep_row_bound(dim.select(*key), dim)
    return fixed.join(bounded_broadcast(keys), on=list(key), how="left_anti")


def ensure_members(dim: DataFrame, members: Sequence[Mapping[str, object]], key: Sequence[str]) -> DataFrame:
    """Insert fixed member rows (e.g. the unknown member ``0``) whose key is absent."""
    rows = members
    out = dim.unionByName(missing_members(dim, members, key))
    bound = row_bound(dim)
    return set_row_bound(out, bound + len(rows)) if bound is not None else out


def lookup_table(
    dim: DataFrame,
    id_col: str,
    key_cols: Sequence[str],
    truncate: int | None = LOOKUP_KEY_CHARS,
    key_names: Sequence[str] | None = None,
    id_name: str | None = None,
) -> DataFrame:
    """Lowest id per (optionally truncated) natural key.

    Equals ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY id) = 1`` projected
    on (id, key), computed as a partial+final ``min`` aggregation (no sort, no
    window, map-side combine).
    """
    names = list(key_names or key_cols)
    keys = [
        (to_text_truncated(k, truncate) if truncate else F.col(k)).alias(n)
        for k, n in zip(key_cols, names)
    ]
    small = single_partition_if_bounded(dim)
    return keep_row_bound(small.groupBy(*keys).agg(F.min(id_col).alias(id_name or id_col)), dim)


# ---------------------------------------------------------------------------
# Time dimension: mixed grain (YYYYMM, YYYY, 0 = unknown)

TIME_COLUMNS = ("IdTiempo", "ANIO", "MES", "DIA", "HORA", "MINUTO", "SEGUNDO")
TIME_SCHEMA = T.StructType([T.StructField(c, T.IntegerType(), c not in ("IdTiempo", "ANIO")) for c in TIME_COLUMNS])


def time_month_spec(year_expr: str, month_expr: str) -> DimensionSpec:
    """``YYYYMM`` members from lenient year/month columns."""
    y = f"try_cast({year_expr} AS INT)"
    m = f"try_cast({month_expr} AS INT)"
    return DimensionSpec(
        name="DIM_TIEMPO",
        columns=(
            ("IdTiempo", f"try_add(try_multiply({y}, 100), {m})"),
            ("ANIO", y),
            ("MES", m),
            ("DIA", "CAST(NULL AS INT)"),
            ("HORA", "CAST(NULL AS INT)"),
            ("MINUTO", "CAST(NULL AS INT)"),
            ("SEGUNDO", "CAST(NULL AS INT)"),
        ),
        key=("IdTiempo",),
        require=("ANIO IS NOT NULL", "MES IS NOT NULL"),
    )


def time_year_spec(year_col: str = "__anio") -> DimensionSpec:
    """``YYYY`` members from an integer year column (see ``load_time_years``)."""
    return DimensionSpec(
        name="DIM_TIEMPO",
        columns=(
            ("IdTiempo", year_col),
            ("ANIO", year_col),
            ("MES", "CAST(NULL AS INT)"),
            ("DIA", "CAST(NULL AS INT)"),
            ("HORA", "CAST(NULL AS INT)"),
            ("MINUTO", "CAST(NULL AS INT)"),
            ("SEGUNDO", "CAST(NULL AS INT)"),
        ),
        key=("IdTiempo",),
    )


def explode_values(source: DataFrame, exprs: Sequence[str], name: str) -> DataFrame:
    """Fixed unpivot of N expressions into one column ``name`` (one output row per expression)."""
    arr = F.array(*[F.expr(e) for e in exprs])
    return source.select(F.explode(arr).alias(name))


def load_time_years(source: DataFrame, year_exprs: Sequence[str], existing: DataFrame | None) -> DataFrame:
    """Year members from several year columns of each row: a fixed unpivot
    (``CROSS APPLY (VALUES (a),(b),(c))``) followed by a dimension load."""
    years = explode_values(source, [f"try_cast({e} AS INT)" for e in year_exprs], "__anio")
    return load_dimension(years, existing, time_year_spec("__anio")).dim


def time_member(id_tiempo: int, anio: int) -> dict[str, object]:
    return {"IdTiempo": id_tiempo, "ANIO": anio}
