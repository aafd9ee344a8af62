import os

from strata.plans.standins import esat_statistics, forms_sources, revenue_bronze, survey_wide
from strata.plans.warehouse import Bronze, Warehouse, kpi_views, load_gold_all, load_silver_all
from strata.session import materialize
from strata.sources.files import read_module_dir, modules_to_parquet
from tests.conftest import SF_SMALL


def _bronze(spark):
    src = forms_sources(spark, SF_SMALL)
    return Bronze(
        ingreso=materialize(revenue_bronze(spark, SF_SMALL), "ingreso_raw"),
        anio=src["anio"],
        formulario=src["formulario"],
        preguntas=src["preguntas"],
        respuestas=src["respuestas"],
        estadistica=esat_statistics(spark, SF_SMALL),
        survey=survey_wide(spark, SF_SMALL),
    )


def test_silver_then_gold_and_rerun_is_incremental(spark, tmp_dir):
    wh = Warehouse(spark, os.path.join(tmp_dir, "wh"))
    bronze = _bronze(spark)
    load_silver_all(wh, bronze)
    counts1 = {n: wh.read("silver", n).count() for n in ("DIM_EJECUTORA", "DIM_UBIGEO", "DIM_TIEMPO", "DIM_PREGUNTA_RENAMU")}
    fact1 = wh.read("silver", "FACT_INGRESO_DIARIO").count()
    assert fact1 == bronze.ingreso.count()  # every stand-in row matches all dimensions

    # ids are dense and unique in the stored dimension
    ids = [r[0] for r in wh.read("silver", "DIM_EJECUTORA").select("IdEjecutora").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    # executing units: budget suppliers first, then statistics customers not seen, then answer roles
    ej = wh.read("silver", "DIM_EJECUTORA")
    n_supp = spark.read.parquet(os.path.join(SF_SMALL, "supplier.parquet")).count()
    n_cust = spark.read.parquet(os.path.join(SF_SMALL, "customer.parquet")).count()
    assert ej.filter("IdEjecutora <= %d" % n_supp).count() == n_supp
    assert ej.count() >= n_cust  # every customer code exists once (codes overlap with suppliers)
    # locations: every customer location exists once the statistics source is loaded
    assert wh.read("silver", "DIM_UBIGEO").select("CODIGODEPARTAMENTO", "CODIGOPROVINCIA", "CODIGODISTRITO").distinct().count() == (
        esat_statistics(spark, SF_SMALL).select("DEPARTAMENTO", "PROVINCIA", "DISTRITO").distinct().count()
    )

    # second run with the same batch: dimensions unchanged, facts fully refreshed
    load_silver_all(wh, bronze)
    counts2 = {n: wh.read("silver", n).count() for n in counts1}
    assert counts2 == counts1
    assert wh.read("silver", "FACT_INGRESO_DIARIO").count() == fact1

    gold = load_gold_all(wh)
    assert set(gold) == {"INGRESOS_DASHBOARD", "SISMEPRE_DASHBOARD", "RENAMU_DASHBOARD"}
    views = kpi_views(wh)
    total = views["vw_kpi_ingresos_anual"].agg({"MONTO_PIM": "sum"}).collect()[0][0]
    expect = bronze.ingreso.agg({"MONTO_PIM": "sum"}).collect()[0][0]
    assert total == expect
    # time dimension holds months, the unknown member 0 and the survey year member
    tiempo = {r[0] for r in wh.read("silver", "DIM_TIEMPO").select("IdTiempo").collect()}
    assert 0 in tiempo and 2020 in tiempo and any(t > 100000 for t in tiempo)


def test_stage_evolves_bronze_schema(spark, tmp_dir):
    wh = Warehouse(spark, os.path.join(tmp_dir, "wh"))
    wh.stage("t_raw", spark.createDataFrame([(1, 10)], "k bigint, v int"))
    # int -> text widening and a new column: the table is rewritten under the evolved schema
    changes = wh.stage("t_raw", spark.createDataFrame([(2, "x", "n")], "k bigint, v string, w string"))
    assert {(c.column, c.action) for c in changes} == {("v", "widen"), ("w", "add")}
    # same schema, columns reordered and one missing: plain append of the aligned rows
    assert wh.stage("t_raw", spark.createDataFrame([("y", 3)], "v string, k bigint")) == []
    got = wh.read("bronze", "t_raw")
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint", "string", "string"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "10", None), (2, "x", "n"), (3, "y", None)]


def test_stage_manifest(spark, tmp_dir):
    data = os.path.join(tmp_dir, "data")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(os.path.join(data, "A_2023.parquet"))
    spark.createDataFrame([(2, 7)], "k int, v int").write.parquet(os.path.join(data, "A_2024.parquet"))
    cfg = {"datasets": [{"S": {"tables": [{"names": ["A"], "years": [2023, 2024], "tablename": "a_raw"}]}}]}
    wh = Warehouse(spark, os.path.join(tmp_dir, "wh"))
    status = wh.stage_manifest(cfg, data)
    assert {r["status"] for r in status.collect()} == {"loaded"}
    assert sorted(tuple(r) for r in wh.read("bronze", "a_raw").collect()) == [(1, "a"), (2, "7")]


def test_module_folder_to_parquet(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "zip")
    os.makedirs(os.path.join(folder, "sub"))
    with open(os.path.join(folder, "mod A.csv"), "w") as fh:
        fh.write('"k";"v"\n"1";"x"\n')
    with open(os.path.join(folder, "sub", "B.CSV"), "w") as fh:
        fh.write('"k";"w"\n"2";"y"\n')
    with open(os.path.join(folder, "notes.txt"), "w") as fh:
        fh.write("ignore me")
    mods = read_module_dir(spark, folder, sep=";")
    assert [m for m, _ in mods] == ["mod A", "sub_B"]
    out = modules_to_parquet(spark, folder, os.path.join(tmp_dir, "out"), "renamu 2024", sep=";")
    assert [os.path.basename(p) for p in out] == ["RENAMU_2024_MOD_A.parquet", "RENAMU_2024_SUB_B.parquet"]
