"""Fact loads by star-schema lookup, and integrity checks.

A fact row is the bronze row with each natural key replaced by the lowest
surrogate id of its dimension (``lookup_table``); a row that misses any
dimension is dropped (inner join). Lookup sides are small and broadcast behind
a row-count bound, so the whole chain of lookups runs in the scan stage of the
fact without a shuffle; a lookup over the bound is split: frequent keys are
broadcast, the rest shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import LOOKUP_KEY_CHARS, to_text_truncated
from strata.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, bounded_broadcast, fits_broadcast, keep_row_bound, single_partition_if_bounded, split_join
from strata.session import materialize


@dataclass(frozen=True)
class Lookup:
    """Resolve one dimension id.

    ``dim``: name of the dimension frame; ``dim_id``: its id column;
    ``dim_keys``: its natural-key columns; ``fact_keys``: Spark SQL expressions
    over the fact row (may reference ids resolved by earlier lookups);
    ``as_col``: name of the id in the fact; ``truncate``: compare the first N
    characters of the text form of both sides (``None``: compare as is), one
    value for all keys or one per key; ``dedupe``: collapse the dimension to its
    lowest id per key first (``False``: duplicate dimension rows fan out).
    """

    dim: str
    dim_id: str
    dim_keys: tuple[str, ...]
    fact_keys: tuple[str, ...]
    as_col: str | None = None
    truncate: int | None | tuple[int | None, ...] = LOOKUP_KEY_CHARS
    dedupe: bool = True

    @property
    def out(self) -> str:
        return self.as_col or self.dim_id

    def truncations(self) -> tuple[int | None, ...]:
        if isinstance(self.truncate, tuple):
            return self.truncate
        return (self.truncate,) * len(self.dim_keys)


def _key(c: Column, n: int | None) -> Column:
    return to_text_truncated(c, n) if n else c


@dataclass(frozen=True)
class FactSpec:
    name: str
    lookups: tuple[Lookup, ...]
    columns: tuple[tuple[str, str], ...]  # (output column, SQL expression over the bronze row)


def resolve_lookups(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    lookups: Sequence[Lookup],
    max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Inner-join ``fact`` to each lookup in order, adding the resolved id columns.

    The fact-side keys are join-condition expressions (the planner extracts them
    as equi-join keys), so the chain adds no projection per lookup; helper
    columns are dropped once at the end.
    """
    cur = fact
    helpers: list[str] = []
    for i, lk in enumerate(lookups):
        names = [f"__lk{i}_{j}" for j in range(len(lk.dim_keys))]
        cuts = lk.truncations()
        dim = dims[lk.dim]
        dim_keys = [_key(F.col(k), n).alias(a) for k, n, a in zip(lk.dim_keys, cuts, names)]
        if lk.dedupe:
            # lowest id per key == ROW_NUMBER() OVER (PARTITION BY key ORDER BY id) = 1
            small = single_partition_if_bounded(dim, max_broadcast_rows)
            side = keep_row_bound(small.groupBy(*dim_keys).agg(F.min(lk.dim_id).alias(lk.out)), dim)
        else:
            side = keep_row_bound(dim.select(*dim_keys, F.col(lk.dim_id).alias(lk.out)), dim)
        fact_keys = [_key(F.expr(e), n) for e, n in zip(lk.fact_keys, cuts)]
        if fits_broadcast(side, max_broadcast_rows):
            side = bounded_broadcast(side, max_broadcast_rows)
            cur = cur.join(side, reduce(lambda a, b: a & b, [k == side[a] for k, a in zip(fact_keys, names)]), "inner")
        else:  # stored, so that lookups after it do not run both of its ways again
            cur = materialize(split_join(cur, materialize(side, lk.dim), fact_keys, names).drop(*names), f"lookup_{lk.dim}")
        helpers += names
    return cur.drop(*helpers)


def build_fact(
    bronze: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: FactSpec,
    max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Full-refresh fact: lookups, then the spec's columns (ids by name, measures by expression)."""
    resolved = resolve_lookups(bronze, dims, spec.lookups, max_broadcast_rows)
    return resolved.select(*[F.expr(e).alias(c) for c, e in spec.columns])


# ---------------------------------------------------------------------------
# Integrity checks (declared constraints re-aimed as a violations report)


def fk_orphans(child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    """Child rows whose non-null key has no parent row (``FOREIGN KEY``)."""
    cond = reduce(lambda a, b: a & b, [child[c] == parent[p] for c, p in zip(child_keys, parent_keys)])
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_keys])
    return child.filter(nonnull).join(parent.select(*parent_keys), cond, "left_anti")


def integrity_report(
    child: DataFrame,
    *,
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    foreign_keys: Sequence[tuple[Sequence[str], DataFrame, Sequence[str], str]] = (),
) -> DataFrame:
    """One row per check: (check_type, check_name, n_violations BIGINT).

    ``not_null``: columns that must not be NULL (rows counted);
    ``unique``: key column lists (number of key values occurring more than once);
    ``foreign_keys``: (child cols, parent frame, parent cols, name) (orphan rows).
    All NOT NULL checks share one aggregation pass over the child.
    """
    parts: list[DataFrame] = []
    if not_null:
        counts = child.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in not_null])
        stack = ", ".join(f"'{c}', coalesce(`{c}`, 0)" for c in not_null)
        parts.append(
            counts.selectExpr(f"stack({len(not_null)}, {stack}) AS (check_name, n_violations)").select(
                F.lit("not_null").alias("check_type"), "check_name", F.col("n_violations").cast("bigint")
            )
        )
    for cols in unique:
        dup = child.groupBy(*cols).count().filter(F.col("count") > 1)
        parts.append(
            dup.agg(F.count(F.lit(1)).alias("n_violations")).select(
                F.lit("unique").alias("check_type"), F.lit(",".join(cols)).alias("check_name"), F.col("n_violations").cast("bigint")
            )
        )
    for child_keys, parent, parent_keys, name in foreign_keys:
        # rows per key first: combines map-side, so a hot key is one row in the join
        per_key = child.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("__rows"))
        orphans = fk_orphans(per_key, child_keys, parent, parent_keys)
        parts.append(
            orphans.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("n_violations")).select(
                F.lit("foreign_key").alias("check_type"), F.lit(name).alias("check_name"), F.col("n_violations").cast("bigint")
            )
        )
    if not parts:
        raise ValueError("no checks requested")
    return reduce(DataFrame.unionByName, parts)
