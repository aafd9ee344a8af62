"""Whole-warehouse loads: silver (dimensions, then facts) and gold (dashboards),
persisted as versioned tables under one root folder (``<root>/<layer>/<table>``).

Dimensions are incremental: only rows added by this run are appended (ids
continue after the stored maximum). Facts and dashboards are full refreshes.
Every write is one commit of one table (``sources.tables``), in dependency order: a
run that fails between any two of them leaves all tables readable, and a run of the
same id does what is left and nothing twice. ``Warehouse.journal`` tells all commits.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold
from strata.operators.schema import SchemaChange
from strata.plans import forms, revenue, survey
from strata.session import materialize
from strata.sources.manifest import ingest
from strata.sources.tables import JOURNAL, VersionedTable

# dimension -> surrogate id column (None: the key itself, IdTiempo)
DIMENSIONS = {
    "DIM_EJECUTORA": "IdEjecutora",
    "DIM_ESPECIFICA": "IdEspecifica",
    "DIM_FUENTE_FINANCIAMIENTO": "IdFuenteFinanciamiento",
    "DIM_GENERICA": "IdGenerica",
    "DIM_NIVEL_GOBIERNO": "IdNivelGobierno",
    "DIM_PLIEGO": "IdPliego",
    "DIM_RUBRO": "IdRubro",
    "DIM_SECTOR": "IdSector",
    "DIM_TIPO_RECURSO": "IdTipoRecurso",
    "DIM_UBIGEO": "IdUbigeo",
    "DIM_TIEMPO": None,
    "DIM_ANIO_APLICACION": "IdAnioAplicacion",
    "DIM_FORMULARIO_SISMEPRE": "IdFormSismepre",
    "DIM_PREGUNTA_SISMEPRE": "IdPreguntaSismepre",
    "DIM_PREGUNTA_RENAMU": "IdPregunta",
}


@dataclass
class Warehouse:
    spark: SparkSession
    root: str

    def table(self, layer: str, table: str) -> VersionedTable:
        return VersionedTable(self.spark, os.path.join(self.root, layer, table))

    def read(self, layer: str, table: str) -> DataFrame | None:
        return self.table(layer, table).read()

    def replace(self, layer: str, table: str, df: DataFrame, run_id: str | None = None) -> None:
        self.table(layer, table).replace(df, run_id)

    def stage(self, table: str, df: DataFrame, drop: bool = False, load_id: str | None = None) -> list[SchemaChange]:
        """Append a load to a bronze table, evolving its schema in the log: stored
        files are not rewritten. Returns the schema changes applied. ``drop``: the
        stored table is replaced instead of appended to. A ``load_id`` that the table
        holds is not loaded again."""
        target = self.table("bronze", table)
        if not drop:
            return target.append(df, load_id)
        target.replace(df, load_id)
        return [SchemaChange(f.name, "add", f.dataType.simpleString()) for f in df.schema.fields]

    def journal(self) -> DataFrame:
        """Every commit of every table: layer, table, and the table's own journal."""
        found = None
        for layer, name in self.tables():
            rows = self.table(layer, name).journal().select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "*")
            found = rows if found is None else found.unionByName(rows)
        return found if found is not None else self.spark.createDataFrame([], f"layer string, table string, {JOURNAL}")

    def tables(self) -> list[tuple[str, str]]:
        """(layer, table) of all tables, sorted."""
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        below = lambda p: [s.getPath() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
        return sorted((layer.getName(), t.getName()) for layer in below(Path(self.root)) for t in below(layer))

    def stage_manifest(self, config: Mapping, data_dir: str, drop: bool = False) -> DataFrame:
        """Manifest ingest into bronze: every loaded table staged (``drop``: replaced);
        returns the status report."""
        status, tables = ingest(self.spark, config, data_dir)
        for name, df in tables.items():
            self.stage(name, df, drop)
        return status

    def append_new(self, table: str, final: DataFrame, existing: DataFrame | None, id_col: str | None, run_id: str | None = None) -> None:
        """Append the rows of ``final`` that this run added to ``existing``."""
        target = self.table("silver", table)
        if existing is None:
            target.replace(final, run_id)
            return
        if id_col is not None:
            top = existing.agg(F.max(id_col).alias("m")).collect()[0]["m"] or 0
            new = final.filter(F.col(id_col) > F.lit(top))
        else:
            new = final.join(existing.select("IdTiempo"), "IdTiempo", "left_anti")
        new = materialize(new.select(*existing.columns), table)
        if not new.isEmpty():
            target.append(new, run_id)


@dataclass
class Bronze:
    """Bronze inputs of one silver load (any source may be absent)."""

    ingreso: DataFrame | None = None
    anio: DataFrame | None = None
    formulario: DataFrame | None = None
    preguntas: DataFrame | None = None
    respuestas: DataFrame | None = None
    estadistica: DataFrame | None = None
    survey: DataFrame | None = None
    survey_tag: str = "RENAMU_2020"
    survey_year: int = 2020


def load_silver_all(wh: Warehouse, bronze: Bronze, run_id: str | None = None) -> dict[str, DataFrame]:
    """Budget dimensions -> forms dimensions -> budget fact -> forms fact -> survey.

    Any source may be absent: what depends on it alone is left as it is. Returns the
    planned silver frames (dimensions and facts) after writing them. A second run of
    the same ``run_id`` and sources commits nothing that the first one did.
    """
    existing = {name: wh.read("silver", name) for name in DIMENSIONS}
    dims: dict[str, DataFrame] = {k: v for k, v in existing.items() if v is not None}
    facts: dict[str, DataFrame] = {}
    if bronze.ingreso is not None:
        dims = revenue.load_revenue_dimensions(bronze.ingreso, dims)
    if any(x is not None for x in (bronze.anio, bronze.formulario, bronze.preguntas, bronze.respuestas, bronze.estadistica)):
        dims = forms.load_forms_dimensions(
            bronze.anio, bronze.formulario, bronze.preguntas, bronze.respuestas, dims, bronze.estadistica
        )
    if bronze.ingreso is not None:
        facts["FACT_INGRESO_DIARIO"] = revenue.load_revenue_fact(bronze.ingreso, dims)
    if bronze.respuestas is not None and set(forms.FACT_DIMENSIONS) <= set(dims):
        facts["FACT_FORMULARIO_SISMEPRE"] = forms.load_forms_fact(bronze.respuestas, dims)
    if bronze.survey is not None:
        dims, facts["FACT_RENAMU"] = survey.load_survey(bronze.survey, dims, bronze.survey_tag, bronze.survey_year)

    for name, id_col in DIMENSIONS.items():
        if name in dims:
            wh.append_new(name, dims[name], existing.get(name), id_col, run_id)
    for name, fact in facts.items():
        wh.replace("silver", name, fact, run_id)
    return {**dims, **facts}


def silver_tables(wh: Warehouse) -> dict[str, DataFrame]:
    names = list(DIMENSIONS) + ["FACT_INGRESO_DIARIO", "FACT_FORMULARIO_SISMEPRE", "FACT_RENAMU"]
    return {n: df for n in names if (df := wh.read("silver", n)) is not None}


def load_gold_all(wh: Warehouse, run_id: str | None = None) -> dict[str, DataFrame]:
    """The three dashboards from the stored silver tables (full refresh; a second run
    of the same ``run_id`` is a no-op)."""
    s = silver_tables(wh)
    out: dict[str, DataFrame] = {}
    if "FACT_INGRESO_DIARIO" in s:
        out["INGRESOS_DASHBOARD"] = revenue.revenue_dashboard(s["FACT_INGRESO_DIARIO"], s)
    if "FACT_FORMULARIO_SISMEPRE" in s:
        out["SISMEPRE_DASHBOARD"] = forms.forms_dashboard(s["FACT_FORMULARIO_SISMEPRE"], s)
    if "FACT_RENAMU" in s:
        out["RENAMU_DASHBOARD"] = survey.survey_dashboard(s["FACT_RENAMU"], s)
    for name, df in out.items():
        wh.replace("gold", name, df, run_id)
    return out


def kpi_views(wh: Warehouse) -> Mapping[str, DataFrame]:
    """The two KPI views, evaluated on read from the stored revenue dashboard."""
    dash = wh.read("gold", "INGRESOS_DASHBOARD")
    if dash is None:
        return {}
    return {"vw_kpi_ingresos_anual": gold.kpi_yearly(dash), "vw_ingresos_por_departamento": gold.kpi_by_department(dash)}
