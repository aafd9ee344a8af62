"""Versioned tables: evolution without rewriting, atomic refreshes, failures, journals."""

import os

import pytest

from strata.plans.standins import forms_sources, survey_wide
from strata.plans.warehouse import Bronze, Warehouse, load_gold_all, load_silver_all
from strata.sources.tables import ConcurrentCommit, Version, VersionedTable
from tests.conftest import SF_SMALL, rows


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_dir):
    return VersionedTable(spark, os.path.join(tmp_dir, "t"))


def test_evolution_keeps_stored_files(spark, table):
    assert table.read() is None and table.current() is None
    table.append(spark.createDataFrame([(1, 10)], "k bigint, v int"), "a")
    before = _files(table.path)
    changes = table.append(spark.createDataFrame([(2, "x", "n")], "k bigint, v string, w string"), "b")
    assert {(c.column, c.action) for c in changes} == {("v", "widen"), ("w", "add")}
    assert table.append(spark.createDataFrame([("y", 3)], "v string, k bigint"), "c") == []
    assert table.append(spark.createDataFrame([("y", 3)], "v string, k bigint"), "c") == []  # the same load again
    assert before.items() <= _files(table.path).items()
    assert rows(table.read()) == [(1, "10", None), (2, "x", "n"), (3, "y", None)]
    assert rows(table.read(0)) == [(1, 10)] and table.read(9) is None
    journal = rows(table.journal())
    assert [(v, op, load, n, parts) for v, op, load, n, parts, _ in journal] == [(0, "append", "a", 1, 1), (1, "append", "b", 1, 2), (2, "append", "c", 1, 3)]
    assert journal[1][5] == "widen v string; add w string"


def test_refresh_reads_its_own_table_and_is_one_commit(spark, table):
    table.replace(spark.range(5).toDF("x"), "r1")
    old = table.read()
    assert table.replace(table.read().selectExpr("x + 1 AS x").where("x > 2"), "r2")
    assert rows(table.read()) == [(3,), (4,), (5,)] and old.count() == 5  # readers of the old version keep it
    assert not table.replace(spark.range(1).toDF("x"), "r2")
    table.append(spark.createDataFrame([], "x bigint"))
    assert table.read().count() == 3 and table.vacuum(keep=1) == 1
    assert rows(table.read()) == [(3,), (4,), (5,)] and len(table.versions()) == 1


@pytest.mark.parametrize("step", ["_write", "_commit"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_failure_at_any_step_leaves_the_table(spark, table, monkeypatch, step, when):
    table.append(spark.createDataFrame([(1,)], "k int"), "a")
    real = getattr(VersionedTable, step)

    def failing(self, arg):
        if when == "after":
            real(self, arg)
        raise RuntimeError("lost")

    monkeypatch.setattr(VersionedTable, step, failing)
    with pytest.raises(RuntimeError):
        table.replace(spark.createDataFrame([(2,)], "k int"), "b")
    done = step == "_commit" and when == "after"
    assert rows(table.read()) == ([(2,)] if done else [(1,)])
    monkeypatch.setattr(VersionedTable, step, real)
    assert table.replace(spark.createDataFrame([(2,)], "k int"), "b") is not done
    assert rows(table.read()) == [(2,)]


def test_two_writers_of_one_version(spark, table):
    table.append(spark.createDataFrame([(1,)], "k int"))
    now = table.current()
    assert Version.from_json(now.to_json()) == now
    with pytest.raises(ConcurrentCommit):
        table._commit(now)
    assert rows(table.read()) == [(1,)]


def test_a_broken_run_is_finished_by_the_next(spark, tmp_dir, monkeypatch):
    src = forms_sources(spark, SF_SMALL)
    bronze = Bronze(anio=src["anio"], formulario=src["formulario"], preguntas=src["preguntas"], respuestas=src["respuestas"], survey=survey_wide(spark, SF_SMALL))
    wh = Warehouse(spark, os.path.join(tmp_dir, "wh"))
    real, left = VersionedTable._commit, [4]

    def failing(self, version):
        if left[0] == 0:
            raise RuntimeError("lost")
        left[0] -= 1
        return real(self, version)

    monkeypatch.setattr(VersionedTable, "_commit", failing)
    with pytest.raises(RuntimeError):
        load_silver_all(wh, bronze, "run-1")
    assert wh.journal().count() == 4 and all(wh.read(layer, name).count() >= 0 for layer, name in wh.tables() if wh.table(layer, name).current())
    monkeypatch.setattr(VersionedTable, "_commit", real)
    for _ in range(2):
        load_silver_all(wh, bronze, "run-1")
        load_gold_all(wh, "run-1")
    journal = wh.journal().collect()
    assert len({(r["layer"], r["table"]) for r in journal}) == len(journal) == 11  # one commit a table
    assert wh.read("silver", "FACT_FORMULARIO_SISMEPRE").count() == src["respuestas"].count()


def test_any_forms_source_may_be_absent(spark, tmp_dir):
    src = forms_sources(spark, SF_SMALL)
    wh = Warehouse(spark, os.path.join(tmp_dir, "wh"))
    load_silver_all(wh, Bronze(formulario=src["formulario"]))
    assert [t for _, t in wh.tables()] == ["DIM_FORMULARIO_SISMEPRE"]
    load_silver_all(wh, Bronze(anio=src["anio"], preguntas=src["preguntas"]))
    assert {"DIM_TIEMPO", "DIM_ANIO_APLICACION", "DIM_PREGUNTA_SISMEPRE"} <= {t for _, t in wh.tables()}
    load_silver_all(wh, Bronze(respuestas=src["respuestas"]))
    assert wh.read("silver", "FACT_FORMULARIO_SISMEPRE").count() == src["respuestas"].count()
