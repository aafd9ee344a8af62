"""Municipal survey: wide questionnaire rows -> location dimension, question
dimension of (field, answer) pairs, long fact, and its dashboard.

Question columns are chosen from the frame's columns by pattern (default
``P%`` or ``VFI``, case-insensitive), so a new survey vintage needs no code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dims import TIME_SCHEMA, DimensionSpec, ensure_members, load_dimension, run_concurrently, time_member
from strata.operators.facts import FactSpec, Lookup, build_fact
from strata.operators.gold import DimJoin, denormalise
from strata.operators.reshape import SURVEY_INCLUDE, select_columns_like, unpivot_to_text
from strata.plans.revenue import ubigeo_spec

DIM_UBIGEO_SURVEY = ubigeo_spec("ccdd", "Departamento", "ccpp", "Provincia", "ccdi", "Distrito")

ID_COLUMNS = ("ccdd", "ccpp", "ccdi", "Tipomuni")


def question_spec(tag: str) -> DimensionSpec:
    return DimensionSpec(
        name="DIM_PREGUNTA_RENAMU",
        id_col="IdPregunta",
        columns=(
            ("IdPadre", "CAST(NULL AS INT)"),
            ("NOMBRE_CAMPO", "NOMBRE_CAMPO"),
            ("DESCRIPCION", "NOMBRE_CAMPO"),
            ("VALOR", "coalesce(VALOR, '')"),
            ("METADATA", f"'{tag}'"),
        ),
        key=("NOMBRE_CAMPO", "VALOR", "METADATA"),
        require=("NOMBRE_CAMPO IS NOT NULL",),
    )


def survey_long(survey: DataFrame, include: Sequence[str] = SURVEY_INCLUDE, exclude: Sequence[str] = ()) -> DataFrame:
    """Wide survey -> (id columns, NOMBRE_CAMPO, VALOR) with NULL answers kept."""
    cols = select_columns_like(survey.columns, include, exclude)
    ids = [c for c in ID_COLUMNS if c in survey.columns]
    return unpivot_to_text(survey, ids, cols)


def fact_spec(tag: str, year: int) -> FactSpec:
    return FactSpec(
        name="FACT_RENAMU",
        lookups=(
            # the location dimension is not collapsed here: duplicate rows fan out
            Lookup(
                "DIM_UBIGEO", "IdUbigeo",
                ("CODIGODEPARTAMENTO", "CODIGOPROVINCIA", "CODIGODISTRITO"),
                ("try_cast(ccdd AS INT)", "try_cast(ccpp AS INT)", "try_cast(ccdi AS INT)"),
                truncate=None, dedupe=False,
            ),
            Lookup(
                "DIM_PREGUNTA_RENAMU", "IdPregunta",
                ("NOMBRE_CAMPO", "VALOR", "METADATA"),
                ("NOMBRE_CAMPO", "coalesce(VALOR, '')", f"'{tag}'"),
                truncate=None, dedupe=False,
            ),
        ),
        columns=(
            ("IdTiempo", f"CAST({int(year)} AS INT)"),
            ("IdUbigeo", "IdUbigeo"),
            ("TIPOMUNI", "coalesce(try_cast(Tipomuni AS INT), 0)"),
            ("IdPregunta", "IdPregunta"),
        ),
    )


def load_survey(
    survey: DataFrame,
    existing: Mapping[str, DataFrame] | None = None,
    tag: str = "RENAMU_2020",
    year: int = 2020,
    include: Sequence[str] = SURVEY_INCLUDE,
    exclude: Sequence[str] = (),
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Survey load: time member ``year``, locations, questions, full-refresh fact."""
    ex = dict(existing or {})
    dims = dict(ex)
    tiempo = ex.get("DIM_TIEMPO")
    if tiempo is None:
        tiempo = survey.sparkSession.createDataFrame([], TIME_SCHEMA)
    dims["DIM_TIEMPO"] = ensure_members(tiempo, [time_member(year, year)], ["IdTiempo"])
    long = survey_long(survey, include, exclude)
    dims.update(
        run_concurrently(
            {
                "DIM_UBIGEO": lambda: load_dimension(survey, ex.get("DIM_UBIGEO"), DIM_UBIGEO_SURVEY).dim,
                "DIM_PREGUNTA_RENAMU": lambda: load_dimension(long, ex.get("DIM_PREGUNTA_RENAMU"), question_spec(tag)).dim,
            }
        )
    )
    fact = build_fact(long, dims, fact_spec(tag, year))
    return dims, fact


DASHBOARD_JOINS = (
    DimJoin("DIM_TIEMPO", "IdTiempo", "IdTiempo", (("ANIO", "ANIO"),)),
    DimJoin("DIM_UBIGEO", "IdUbigeo", "IdUbigeo", (("DEPARTAMENTO", "DEPARTAMENTO"), ("PROVINCIA", "PROVINCIA"), ("DISTRITO", "DISTRITO"))),
    DimJoin(
        "DIM_PREGUNTA_RENAMU", "IdPregunta", "IdPregunta",
        (("NOMBRE_CAMPO", "NOMBRE_CAMPO"), ("DESCRIPCION", "DESCRIPCION"), ("VALOR", "VALOR"), ("METADATA", "METADATA")),
    ),
)


def survey_dashboard(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    out = denormalise(fact, dims, DASHBOARD_JOINS, keep=("TIPOMUNI",))
    return out.select("ANIO", "DEPARTAMENTO", "PROVINCIA", "DISTRITO", F.col("TIPOMUNI"), "NOMBRE_CAMPO", "DESCRIPCION", "VALOR", "METADATA")
