"""Gold layer: denormalised dashboards and KPI views.

``denormalise`` joins a fact to dimensions by surrogate id (unique on the
dimension side, so no fan-out) and picks display columns. ``aggregate_dashboard``
sums by display columns. With every dimension under the broadcast bound it
replaces each id by the number of its display values map-side and aggregates once
by these numbers (partial aggregation before the only shuffle, so a hot group never
reaches one task as raw rows); the texts join the groups. Otherwise it first
reduces the fact by its id columns so the shuffled joins see fewer rows, then
aggregates again by display columns (names may repeat across ids).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.exprs import safe_ratio
from strata.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, bounded_broadcast, fits_broadcast, keep_row_bound

SUM_TYPE = "decimal(38,2)"  # SUM(DECIMAL(18,2)) keeps the full precision of the source engine


@dataclass(frozen=True)
class DimJoin:
    """Join ``dims[dim]`` on ``fact_col = dim_id`` and take ``columns`` (output -> dim column)."""

    dim: str
    fact_col: str
    dim_id: str
    columns: tuple[tuple[str, str], ...]


def denormalise(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    joins: Sequence[DimJoin],
    keep: Sequence[str] = (),
    max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Inner star join by id; output = ``keep`` fact columns + every join's columns, in order."""
    cur = fact
    out_cols: list[str] = []
    for i, j in enumerate(joins):
        fid = f"__dj{i}"
        side = keep_row_bound(dims[j.dim].select(F.col(j.dim_id).alias(fid), *[F.col(d).alias(o) for o, d in j.columns]), dims[j.dim])
        side = bounded_broadcast(side, max_broadcast_rows)
        cur = cur.join(side, F.col(j.fact_col) == side[fid], "inner")
        out_cols.extend(o for o, _ in j.columns)
    return cur.select(*keep, *out_cols)


def aggregate_dashboard(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    joins: Sequence[DimJoin],
    measures: Sequence[str],
    max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Group by every joined display column and sum ``measures`` (as ``decimal(38,2)``).

    When every dimension is under the broadcast bound, the joins are map-side:
    equal display values of a dimension have one number, the partial aggregation by
    these numbers (never finer than the ids) combines before the only shuffle, and
    no text is shuffled. When some dimension is larger, its join
    would shuffle the fact, so the fact is first reduced by its id columns and
    the joins run on the reduced rows.
    """
    group_cols = [o for j in joins for o, _ in j.columns]
    sums = [F.sum(m).cast(SUM_TYPE).alias(m) for m in measures]
    if all(fits_broadcast(dims[j.dim], max_broadcast_rows) for j in joins):
        cur, numbers, texts = fact, [], []
        for i, j in enumerate(joins):
            side = dims[j.dim].select(F.col(j.dim_id).alias(f"__dj{i}"), *[F.col(d).alias(o) for o, d in j.columns])
            shown = [o for o, _ in j.columns]
            # one task, at most the rows of a broadcast side
            ranked = side.coalesce(1).withColumn(f"__dn{i}", F.dense_rank().over(Window.orderBy(*shown)))
            cur = cur.join(F.broadcast(ranked.drop(*shown)), F.col(j.fact_col) == F.col(f"__dj{i}"), "inner")
            numbers.append(f"__dn{i}")
            texts.append(ranked.drop(f"__dj{i}").distinct())
        out = cur.groupBy(*numbers).agg(*sums)
        for number, text in zip(numbers, texts):
            out = out.join(F.broadcast(text), number)
        return out.select(*group_cols, *measures)
    ids = list(dict.fromkeys(j.fact_col for j in joins))
    reduced = fact.groupBy(*ids).agg(*sums)
    wide = denormalise(reduced, dims, joins, keep=measures, max_broadcast_rows=max_broadcast_rows)
    return wide.groupBy(*group_cols).agg(*sums)


def add_budget_measures(df: DataFrame, pia: str = "MONTO_PIA", pim: str = "MONTO_PIM", rec: str = "MONTO_RECAUDADO") -> DataFrame:
    """Derived measures of the revenue dashboard: PIM-PIA, PIM-REC and the collection ratio."""
    return df.select(
        "*",
        (F.col(pim) - F.col(pia)).cast(SUM_TYPE).alias("VARIACION_PIM_PIA"),
        (F.col(pim) - F.col(rec)).cast(SUM_TYPE).alias("SALDO_POR_RECAUDAR"),
        safe_ratio(F.col(rec), F.col(pim)).alias("PORC_AVANCE_RECAUDACION"),
    )


def kpi_yearly(dashboard: DataFrame) -> DataFrame:
    """Yearly KPIs; the ratio is recomputed from the sums (ratios are not averaged)."""
    sums = dashboard.groupBy("ANIO").agg(
        *[
            F.sum(c).cast(SUM_TYPE).alias(c)
            for c in ("MONTO_PIA", "MONTO_PIM", "MONTO_RECAUDADO", "VARIACION_PIM_PIA", "SALDO_POR_RECAUDAR")
        ]
    )
    return sums.withColumn("PORC_AVANCE_RECAUDACION", safe_ratio(F.col("MONTO_RECAUDADO"), F.col("MONTO_PIM")))


def string_agg(
    df: DataFrame, group_cols: Sequence[str], value_col: str, sep: str = ",", alias: str | None = None
) -> DataFrame:
    """Per group, its non-NULL values joined with ``sep`` in ascending order,
    duplicates kept (``STRING_AGG(x, sep) WITHIN GROUP (ORDER BY x)``).

    Equal values are counted first, by a combinable aggregation, so a group's one
    row is built from its distinct values; the text itself is as long as all the
    values of the group, which is what the operator returns.
    """
    out = alias or f"{value_col}_agg"
    counted = df.groupBy(*group_cols, F.col(value_col).cast("string").alias("__v")).agg(F.count("*").alias("__n"))
    pair = F.when(F.col("__v").isNotNull(), F.struct("__v", "__n"))
    runs = F.transform(F.array_sort(F.collect_list(pair)), lambda p: F.array_join(F.array_repeat(p["__v"], p["__n"].cast("int")), sep))
    return counted.groupBy(*group_cols).agg(F.when(F.count("__v") > 0, F.array_join(runs, sep)).alias(out))


def kpi_by_department(dashboard: DataFrame) -> DataFrame:
    return dashboard.groupBy("ANIO", "DEPARTAMENTO").agg(
        *[F.sum(c).cast(SUM_TYPE).alias(c) for c in ("MONTO_RECAUDADO", "MONTO_PIM", "SALDO_POR_RECAUDAR")]
    )
