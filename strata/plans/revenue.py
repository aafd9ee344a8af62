"""Revenue (budget execution) star schema: dimension specs, the daily fact and
the dashboard, over a bronze table with the ``ingreso_raw`` column names.

Order of a full load (``load_revenue``): dimensions (each written/materialised
before it is used as a lookup), fact, dashboard. Every dimension is computed
from the same bronze projection; callers should pass a bronze frame that is
cheap to rescan (a parquet table), not an expensive un-materialised join.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from strata.operators.dims import DimensionSpec, load_dimension, load_dimensions, run_concurrently, time_month_spec
from strata.operators.facts import FactSpec, Lookup, build_fact
from strata.operators.gold import DimJoin, add_budget_measures, aggregate_dashboard

MEASURES = ("MONTO_PIA", "MONTO_PIM", "MONTO_RECAUDADO")


def _text(c: str) -> str:
    return f"CAST(`{c}` AS STRING)"


def _simple_dim(name: str, id_col: str, code: str) -> DimensionSpec:
    """Code + name dimension: ``<CODE>``, ``<CODE>_NOMBRE``."""
    return DimensionSpec(
        name=name,
        id_col=id_col,
        columns=((code, _text(code)), (f"{code}_NOMBRE", _text(f"{code}_NOMBRE"))),
        key=(code,),
    )


DIM_EJECUTORA = DimensionSpec(
    name="DIM_EJECUTORA",
    id_col="IdEjecutora",
    columns=(("SEC_EJEC", _text("SEC_EJEC")), ("EJECUTORA", _text("EJECUTORA")), ("EJECUTORA_NOMBRE", _text("EJECUTORA_NOMBRE"))),
    key=("SEC_EJEC",),
)
DIM_ESPECIFICA = DimensionSpec(
    name="DIM_ESPECIFICA",
    id_col="IdEspecifica",
    columns=(
        ("ESPECIFICA", _text("ESPECIFICA")),
        ("ESPECIFICA_NOMBRE", _text("ESPECIFICA_NOMBRE")),
        ("ESPECIFICA_DET", _text("ESPECIFICA_DET")),
        ("ESPECIFICA_DET_NOMBRE", _text("ESPECIFICA_DET_NOMBRE")),
    ),
    key=("ESPECIFICA", "ESPECIFICA_DET"),
    require=("ESPECIFICA IS NOT NULL",),
)
DIM_FUENTE_FINANCIAMIENTO = _simple_dim("DIM_FUENTE_FINANCIAMIENTO", "IdFuenteFinanciamiento", "FUENTE_FINANCIAMIENTO")
DIM_GENERICA = DimensionSpec(
    name="DIM_GENERICA",
    id_col="IdGenerica",
    columns=(
        ("GENERICA", _text("GENERICA")),
        ("GENERICA_NOMBRE", _text("GENERICA_NOMBRE")),
        ("SUBGENERICA", _text("SUBGENERICA")),
        ("SUBGENERICA_NOMBRE", _text("SUBGENERICA_NOMBRE")),
        ("SUBGENERICA_DET", _text("SUBGENERICA_DET")),
        ("SUBGENERICA_DET_NOMBRE", _text("SUBGENERICA_DET_NOMBRE")),
    ),
    key=("GENERICA", "SUBGENERICA", "SUBGENERICA_DET"),
    require=("GENERICA IS NOT NULL",),
)
DIM_NIVEL_GOBIERNO = _simple_dim("DIM_NIVEL_GOBIERNO", "IdNivelGobierno", "NIVEL_GOBIERNO")
DIM_PLIEGO = _simple_dim("DIM_PLIEGO", "IdPliego", "PLIEGO")
DIM_RUBRO = _simple_dim("DIM_RUBRO", "IdRubro", "RUBRO")
DIM_SECTOR = _simple_dim("DIM_SECTOR", "IdSector", "SECTOR")
DIM_TIPO_RECURSO = _simple_dim("DIM_TIPO_RECURSO", "IdTipoRecurso", "TIPO_RECURSO")


def ubigeo_spec(dep: str, dep_name: str, prov: str, prov_name: str, dist: str, dist_name: str) -> DimensionSpec:
    """Location dimension keyed by three integer codes (lenient conversion)."""
    return DimensionSpec(
        name="DIM_UBIGEO",
        id_col="IdUbigeo",
        columns=(
            ("CODIGODEPARTAMENTO", f"try_cast(`{dep}` AS INT)"),
            ("DEPARTAMENTO", _text(dep_name)),
            ("CODIGOPROVINCIA", f"try_cast(`{prov}` AS INT)"),
            ("PROVINCIA", _text(prov_name)),
            ("CODIGODISTRITO", f"try_cast(`{dist}` AS INT)"),
            ("DISTRITO", _text(dist_name)),
        ),
        key=("CODIGODEPARTAMENTO", "CODIGOPROVINCIA", "CODIGODISTRITO"),
    )


DIM_UBIGEO = ubigeo_spec(
    "DEPARTAMENTO_EJECUTORA", "DEPARTAMENTO_EJECUTORA_NOMBRE",
    "PROVINCIA_EJECUTORA", "PROVINCIA_EJECUTORA_NOMBRE",
    "DISTRITO_EJECUTORA", "DISTRITO_EJECUTORA_NOMBRE",
)
DIM_TIEMPO_MES = time_month_spec("ANO_DOC", "MES_DOC")

# load order of the revenue dimensions (the time dimension is shared with other sources)
REVENUE_DIMENSIONS: tuple[DimensionSpec, ...] = (
    DIM_EJECUTORA,
    DIM_ESPECIFICA,
    DIM_FUENTE_FINANCIAMIENTO,
    DIM_GENERICA,
    DIM_NIVEL_GOBIERNO,
    DIM_PLIEGO,
    DIM_RUBRO,
    DIM_SECTOR,
    DIM_TIPO_RECURSO,
    DIM_UBIGEO,
    DIM_TIEMPO_MES,
)


def _lk(dim: DimensionSpec, fact_keys: tuple[str, ...] | None = None, truncate: int | None = 50) -> Lookup:
    return Lookup(
        dim=dim.name,
        dim_id=dim.id_col or dim.key[0],
        dim_keys=dim.key,
        fact_keys=fact_keys or tuple(f"`{k}`" for k in dim.key),
        truncate=truncate,
    )


FACT_INGRESO_DIARIO = FactSpec(
    name="FACT_INGRESO_DIARIO",
    lookups=(
        _lk(DIM_TIEMPO_MES, ("try_add(try_multiply(try_cast(ANO_DOC AS INT), 100), try_cast(MES_DOC AS INT))",), truncate=None),
        _lk(DIM_NIVEL_GOBIERNO),
        _lk(DIM_SECTOR),
        _lk(DIM_PLIEGO),
        _lk(DIM_EJECUTORA),
        _lk(
            DIM_UBIGEO,
            (
                "try_cast(DEPARTAMENTO_EJECUTORA AS INT)",
                "try_cast(PROVINCIA_EJECUTORA AS INT)",
                "try_cast(DISTRITO_EJECUTORA AS INT)",
            ),
            truncate=None,
        ),
        _lk(DIM_RUBRO),
        _lk(DIM_TIPO_RECURSO),
        _lk(DIM_GENERICA),
        _lk(DIM_ESPECIFICA),
    ),
    columns=(
        ("IdTiempo", "IdTiempo"),
        ("IdNivelGobierno", "IdNivelGobierno"),
        ("IdSector", "IdSector"),
        ("IdPliego", "IdPliego"),
        ("IdEjecutora", "IdEjecutora"),
        ("IdUbigeo", "IdUbigeo"),
        ("IdRubro", "IdRubro"),
        ("IdTipoRecurso", "IdTipoRecurso"),
        ("IdGenerica", "IdGenerica"),
        ("IdEspecifica", "IdEspecifica"),
        ("MONTO_PIA", "coalesce(try_cast(MONTO_PIA AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)))"),
        ("MONTO_PIM", "coalesce(try_cast(MONTO_PIM AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)))"),
        ("MONTO_RECAUDADO", "coalesce(try_cast(MONTO_RECAUDADO AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)))"),
    ),
)

DASHBOARD_JOINS = (
    DimJoin("DIM_TIEMPO", "IdTiempo", "IdTiempo", (("ANIO", "ANIO"), ("MES", "MES"))),
    DimJoin("DIM_NIVEL_GOBIERNO", "IdNivelGobierno", "IdNivelGobierno", (("NIVEL_GOBIERNO", "NIVEL_GOBIERNO_NOMBRE"),)),
    DimJoin("DIM_SECTOR", "IdSector", "IdSector", (("SECTOR", "SECTOR_NOMBRE"),)),
    DimJoin("DIM_PLIEGO", "IdPliego", "IdPliego", (("PLIEGO", "PLIEGO_NOMBRE"),)),
    DimJoin("DIM_EJECUTORA", "IdEjecutora", "IdEjecutora", (("EJECUTORA", "EJECUTORA_NOMBRE"),)),
    DimJoin(
        "DIM_UBIGEO", "IdUbigeo", "IdUbigeo",
        (("DEPARTAMENTO", "DEPARTAMENTO"), ("PROVINCIA", "PROVINCIA"), ("DISTRITO", "DISTRITO")),
    ),
    DimJoin("DIM_RUBRO", "IdRubro", "IdRubro", (("RUBRO", "RUBRO_NOMBRE"),)),
    DimJoin("DIM_TIPO_RECURSO", "IdTipoRecurso", "IdTipoRecurso", (("TIPO_RECURSO", "TIPO_RECURSO_NOMBRE"),)),
    DimJoin("DIM_GENERICA", "IdGenerica", "IdGenerica", (("GENERICA", "GENERICA_NOMBRE"),)),
    DimJoin("DIM_ESPECIFICA", "IdEspecifica", "IdEspecifica", (("ESPECIFICA", "ESPECIFICA_NOMBRE"),)),
)


@dataclass
class RevenueModel:
    dims: dict[str, DataFrame]
    fact: DataFrame


def load_revenue_dimensions(
    bronze: DataFrame,
    existing: Mapping[str, DataFrame] | None = None,
    specs: tuple[DimensionSpec, ...] = REVENUE_DIMENSIONS,
    single_pass: bool = False,
) -> dict[str, DataFrame]:
    """Incremental load of every revenue dimension from one bronze batch.

    Default: independent loads submitted concurrently, each scanning only its
    own columns of the (parquet) bronze. ``single_pass=True`` computes all of
    them from one scan with ``GROUPING SETS`` instead -- fewer jobs, but every
    row is expanded once per dimension, so it pays off only when the bronze
    is expensive to rescan (not a columnar table).
    """
    existing = dict(existing or {})
    out: dict[str, DataFrame] = dict(existing)
    if single_pass:
        for name, loaded in load_dimensions(bronze, specs, existing).items():
            out[name] = loaded.dim
        return out
    tasks = {spec.name: (lambda s=spec: load_dimension(bronze, existing.get(s.name), s)) for spec in specs}
    for name, loaded in run_concurrently(tasks).items():
        out[name] = loaded.dim
    return out


def load_revenue_fact(bronze: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Map the time spec's name onto the shared time dimension and build the fact."""
    return build_fact(bronze, dims, FACT_INGRESO_DIARIO)


def revenue_dashboard(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Gold revenue dashboard: 13 display keys, 3 sums, 2 differences, collection ratio."""
    summed = aggregate_dashboard(fact, dims, DASHBOARD_JOINS, MEASURES)
    return add_budget_measures(summed)


def load_revenue(bronze: DataFrame, existing: Mapping[str, DataFrame] | None = None) -> RevenueModel:
    dims = load_revenue_dimensions(bronze, existing)
    return RevenueModel(dims=dims, fact=load_revenue_fact(bronze, dims))
