"""Forms (questionnaire answers) star schema: year-of-application, form and
question dimensions, executing-unit keys from answers, the answers fact
(question lookup depends on the resolved form id) and its dashboard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dims import (
    TIME_SCHEMA,
    DimensionSpec,
    ensure_members,
    load_dimension,
    load_time_years,
    run_concurrently,
    time_member,
)
from strata.operators.facts import FactSpec, Lookup, build_fact
from strata.operators.gold import DimJoin, denormalise
from strata.operators.joins import bounded_broadcast, keep_row_bound
from strata.plans.revenue import ubigeo_spec

DIM_ANIO_APLICACION = DimensionSpec(
    name="DIM_ANIO_APLICACION",
    id_col="IdAnioAplicacion",
    columns=(
        ("ANO_APLICACION", "coalesce(try_cast(ANO_APLICACION AS INT), 0)"),
        ("ANO_APLICACION_INICIO", "coalesce(try_cast(ANO_APLICACION_INICIO AS INT), 0)"),
        ("ANO_APLICACION_FIN", "coalesce(try_cast(ANO_APLICACION_FIN AS INT), 0)"),
        ("FECHA_CIERRE", "0"),
        ("FECHA_PRES_OFICIO", "0"),
        ("FECHA_INI_CIERRE", "0"),
        ("FECHA_ING", "0"),
    ),
    key=("ANO_APLICACION",),
    source_filter="try_cast(ANO_APLICACION AS INT) IS NOT NULL",
    require=(),
)

DIM_FORMULARIO = DimensionSpec(
    name="DIM_FORMULARIO_SISMEPRE",
    id_col="IdFormSismepre",
    columns=(
        ("FORMULARIO_ID", "CAST(FORMULARIO_ID AS STRING)"),
        ("TITULO", "CAST(TITULO AS STRING)"),
        ("SUBTITULO", "CAST(SUB_TITULO AS STRING)"),
        ("ABREVIATURA", "CAST(ABREVIATURA AS STRING)"),
        ("CLASIFICACION", "CAST(CLASIFICACION AS STRING)"),
        ("TIPO_FORMULARIO", "CAST(TIPO_FORMULARIO AS STRING)"),
    ),
    key=("FORMULARIO_ID",),
)

# read from questions joined to the form dimension (the form id is part of the key)
DIM_PREGUNTA = DimensionSpec(
    name="DIM_PREGUNTA_SISMEPRE",
    id_col="IdPreguntaSismepre",
    columns=(
        ("IdFormSismepre", "IdFormSismepre"),
        ("PREGUNTA_ID", "CAST(PREGUNTA_ID AS STRING)"),
        ("PREGUNTA_PADRE_ID", "CAST(coalesce(PREGUNTA_PADRE_ID, 0) AS STRING)"),
        ("DESCRIPCION", "CAST(DESCRIPCION AS STRING)"),
        ("TIPO_CUESTIONARIO_ID", "CAST(TIPO_CUESTIONARIO_ID AS STRING)"),
    ),
    key=("PREGUNTA_ID", "IdFormSismepre"),
    require=("PREGUNTA_ID IS NOT NULL",),
)

# executing units seen only in answers: the code is also the name
DIM_EJECUTORA_RESPUESTAS = DimensionSpec(
    name="DIM_EJECUTORA",
    id_col="IdEjecutora",
    columns=(
        ("SEC_EJEC", "CAST(SEC_EJEC AS STRING)"),
        ("EJECUTORA", "CAST(SEC_EJEC AS STRING)"),
        ("EJECUTORA_NOMBRE", "CAST(SEC_EJEC AS STRING)"),
    ),
    key=("SEC_EJEC",),
)

# executing units from the municipal statistics source: code + municipality name
DIM_EJECUTORA_ESTADISTICA = DimensionSpec(
    name="DIM_EJECUTORA",
    id_col="IdEjecutora",
    columns=(
        ("SEC_EJEC", "CAST(SEC_EJEC AS STRING)"),
        ("EJECUTORA", "CAST(SEC_EJEC AS STRING)"),
        ("EJECUTORA_NOMBRE", "CAST(MUNICIPALIDAD_NOMBRE AS STRING)"),
    ),
    key=("SEC_EJEC",),
    require=("SEC_EJEC IS NOT NULL", "EJECUTORA_NOMBRE IS NOT NULL"),
)

# locations from the municipal statistics source
DIM_UBIGEO_ESTADISTICA = ubigeo_spec(
    "DEPARTAMENTO", "DEPARTAMENTO_NOMBRE", "PROVINCIA", "PROVINCIA_NOMBRE", "DISTRITO", "DISTRITO_NOMBRE"
)

FACT_FORMULARIO = FactSpec(
    name="FACT_FORMULARIO_SISMEPRE",
    lookups=(
        Lookup("DIM_EJECUTORA", "IdEjecutora", ("SEC_EJEC",), ("SEC_EJEC",)),
        Lookup("DIM_ANIO_APLICACION", "IdAnioAplicacion", ("ANO_APLICACION",), ("try_cast(ANO_APLICACION AS INT)",), truncate=None),
        Lookup("DIM_FORMULARIO_SISMEPRE", "IdFormSismepre", ("FORMULARIO_ID",), ("FORMULARIO_ID",), as_col="IdFormulario"),
        Lookup(
            "DIM_PREGUNTA_SISMEPRE",
            "IdPreguntaSismepre",
            ("IdFormSismepre", "PREGUNTA_ID"),
            ("IdFormulario", "PREGUNTA_ID"),
            as_col="IdPregunta",
            truncate=(None, 50),
        ),
    ),
    columns=(
        ("IdEjecutora", "IdEjecutora"),
        ("IdAnioAplicacion", "IdAnioAplicacion"),
        ("PERIODO", "CAST(PERIODO AS STRING)"),
        ("IdFormulario", "IdFormulario"),
        ("IdPregunta", "IdPregunta"),
        ("RESPUESTA_ID", "CAST(RESPUESTA_ID AS STRING)"),
        ("RESPUESTA_TEXTO", "CAST(RESPUESTA_TEXTO AS STRING)"),
        ("RESPUESTA_DECIMAL", "CAST(RESPUESTA_DECIMAL AS STRING)"),
        ("RESPUESTA_ENTERO", "CAST(RESPUESTA_ENTERO AS STRING)"),
        ("RESPUESTA_FECHA", "CAST(RESPUESTA_FECHA AS STRING)"),
    ),
)

DASHBOARD_JOINS = (
    DimJoin("DIM_EJECUTORA", "IdEjecutora", "IdEjecutora", (("SEC_EJEC", "SEC_EJEC"), ("EJECUTORA_NOMBRE", "EJECUTORA_NOMBRE"))),
    DimJoin("DIM_ANIO_APLICACION", "IdAnioAplicacion", "IdAnioAplicacion", (("ANO_APLICACION", "ANO_APLICACION"),)),
    DimJoin(
        "DIM_FORMULARIO_SISMEPRE", "IdFormulario", "IdFormSismepre",
        (("FORMULARIO_ID", "FORMULARIO_ID"), ("TITULO_FORMULARIO", "TITULO"), ("CLASIFICACION", "CLASIFICACION"), ("TIPO_FORMULARIO", "TIPO_FORMULARIO")),
    ),
    DimJoin("DIM_PREGUNTA_SISMEPRE", "IdPregunta", "IdPreguntaSismepre", (("PREGUNTA_ID", "PREGUNTA_ID"), ("DESCRIPCION", "DESCRIPCION"))),
)
DASHBOARD_COLUMNS = (
    "ANO_APLICACION", "PERIODO", "SEC_EJEC", "EJECUTORA_NOMBRE", "FORMULARIO_ID", "TITULO_FORMULARIO",
    "CLASIFICACION", "TIPO_FORMULARIO", "PREGUNTA_ID", "DESCRIPCION", "RESPUESTA_ID", "RESPUESTA_TEXTO",
    "RESPUESTA_DECIMAL", "RESPUESTA_ENTERO", "RESPUESTA_FECHA",
)


def questions_with_form(preguntas: DataFrame, dim_formulario: DataFrame) -> DataFrame:
    """Questions joined to their form's surrogate id (full, untruncated key, no collapse)."""
    forms = keep_row_bound(dim_formulario.select(F.col("FORMULARIO_ID").alias("__fid"), "IdFormSismepre"), dim_formulario)
    keyed = preguntas.withColumn("__fid", F.col("FORMULARIO_ID").cast("string"))
    return keyed.join(bounded_broadcast(forms), on="__fid", how="inner").drop("__fid")


FACT_DIMENSIONS = tuple(x.dim for x in FACT_FORMULARIO.lookups)


def load_forms_dimensions(
    anio: DataFrame | None,
    formulario: DataFrame | None,
    preguntas: DataFrame | None,
    respuestas: DataFrame | None,
    existing: Mapping[str, DataFrame] | None = None,
    estadistica: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Dimension loads of the forms source, in dependency order.

    Time gets the unknown member 0 and the year members of the three
    application-year columns; executing units come first from the statistics
    source (when given) and then from the answers (code as name). Any source may
    be absent: its dimensions stay as they are (questions need their forms, which
    may be stored already).
    """
    ex = dict(existing or {})
    out = dict(ex)

    def time_members():
        if "DIM_TIEMPO" in ex:
            tiempo = ensure_members(ex["DIM_TIEMPO"], [time_member(0, 0)], ["IdTiempo"])
        else:
            tiempo = anio.sparkSession.createDataFrame([(0, 0, None, None, None, None, None)], TIME_SCHEMA)
        return load_time_years(anio, ["ANO_APLICACION", "ANO_APLICACION_INICIO", "ANO_APLICACION_FIN"], tiempo)

    def forms_and_questions():
        form, asked = ex.get("DIM_FORMULARIO_SISMEPRE"), ex.get("DIM_PREGUNTA_SISMEPRE")
        if formulario is not None:
            form = load_dimension(formulario, form, DIM_FORMULARIO).dim
        if preguntas is not None and form is not None:
            asked = load_dimension(questions_with_form(preguntas, form), asked, DIM_PREGUNTA).dim
        return form, asked

    def executing_units():
        ejecutora = ex.get("DIM_EJECUTORA")
        if estadistica is not None:
            ejecutora = load_dimension(estadistica, ejecutora, DIM_EJECUTORA_ESTADISTICA).dim
        if respuestas is not None:
            ejecutora = load_dimension(respuestas, ejecutora, DIM_EJECUTORA_RESPUESTAS).dim
        return ejecutora

    tasks = {"forms": forms_and_questions, "DIM_EJECUTORA": executing_units}
    if anio is not None:
        tasks["DIM_TIEMPO"] = time_members
        tasks["DIM_ANIO_APLICACION"] = lambda: load_dimension(anio, ex.get("DIM_ANIO_APLICACION"), DIM_ANIO_APLICACION).dim
    if estadistica is not None:
        tasks["DIM_UBIGEO"] = lambda: load_dimension(estadistica, ex.get("DIM_UBIGEO"), DIM_UBIGEO_ESTADISTICA).dim
    done = run_concurrently(tasks)
    out["DIM_FORMULARIO_SISMEPRE"], out["DIM_PREGUNTA_SISMEPRE"] = done.pop("forms")
    out.update(done)
    return {name: dim for name, dim in out.items() if dim is not None}


def load_forms_fact(respuestas: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return build_fact(respuestas, dims, FACT_FORMULARIO)


def forms_dashboard(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    keep = ("PERIODO", "RESPUESTA_ID", "RESPUESTA_TEXTO", "RESPUESTA_DECIMAL", "RESPUESTA_ENTERO", "RESPUESTA_FECHA")
    return denormalise(fact, dims, DASHBOARD_JOINS, keep=keep).select(*DASHBOARD_COLUMNS)
