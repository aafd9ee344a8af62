from decimal import Decimal

from strata.operators.dims import DimensionSpec, load_dimension
from strata.operators.facts import FactSpec, Lookup, build_fact, integrity_report
from strata.operators.gold import DimJoin, add_budget_measures, aggregate_dashboard, kpi_yearly
from tests.conftest import rows

CODE = DimensionSpec(
    name="DIM_C",
    id_col="IdC",
    columns=(("C", "CAST(c AS STRING)"), ("C_NOMBRE", "CAST(cn AS STRING)")),
    key=("C",),
)
FACT = FactSpec(
    name="F",
    lookups=(Lookup("DIM_C", "IdC", ("C",), ("c",)),),
    columns=(("IdC", "IdC"), ("AMT", "coalesce(try_cast(amt AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)))")),
)


def _bronze(spark):
    return spark.createDataFrame(
        [("a", "A", "1.005"), ("a", "A2", "x"), ("b", "B", None), (None, "N", "5"), ("c", "C", "-2")],
        "c string, cn string, amt string",
    )


def test_fact_rows_are_bronze_rows_matching_every_dimension(spark):
    bronze = _bronze(spark)
    dim = load_dimension(bronze, None, CODE).dim
    fact = build_fact(bronze, {"DIM_C": dim}, FACT)
    # NULL code matches nothing; 'a' has two dim rows (two names) -> lowest id, no fan-out
    got = rows(fact)
    assert got == [(1, Decimal("0.00")), (1, Decimal("1.01")), (3, Decimal("0.00")), (4, Decimal("-2.00"))]


def test_dashboard_sums_ratio_and_kpi(spark):
    fact = spark.createDataFrame(
        [(1, 1, Decimal("10.00"), Decimal("20.00"), Decimal("5.00")), (1, 2, Decimal("1.00"), Decimal("0.00"), Decimal("0.00")),
         (2, 1, Decimal("3.00"), Decimal("4.00"), Decimal("1.00"))],
        "IdT int, IdN bigint, MONTO_PIA decimal(18,2), MONTO_PIM decimal(18,2), MONTO_RECAUDADO decimal(18,2)",
    )
    dims = {
        "T": spark.createDataFrame([(1, 2024), (2, 2025)], "IdT int, ANIO int"),
        # two ids share one name: the second aggregation merges them
        "N": spark.createDataFrame([(1, "same"), (2, "same")], "IdN bigint, NAME string"),
    }
    joins = (DimJoin("T", "IdT", "IdT", (("ANIO", "ANIO"),)), DimJoin("N", "IdN", "IdN", (("DEPARTAMENTO", "NAME"),)))
    dash = add_budget_measures(aggregate_dashboard(fact, dims, joins, ("MONTO_PIA", "MONTO_PIM", "MONTO_RECAUDADO")))
    got = {r["ANIO"]: (r["MONTO_PIM"], r["VARIACION_PIM_PIA"], r["SALDO_POR_RECAUDAR"], r["PORC_AVANCE_RECAUDACION"]) for r in dash.collect()}
    assert got[2024] == (Decimal("20.00"), Decimal("9.00"), Decimal("15.00"), Decimal("0.250000"))
    assert got[2025] == (Decimal("4.00"), Decimal("1.00"), Decimal("3.00"), Decimal("0.250000"))
    k = {r["ANIO"]: r["PORC_AVANCE_RECAUDACION"] for r in kpi_yearly(dash).collect()}
    assert k == {2024: Decimal("0.250000"), 2025: Decimal("0.250000")}


def test_dashboard_plans_agree(spark):
    """Broadcast path (join, then one aggregation) == over-the-bound path
    (reduce by ids, shuffled joins, aggregate again)."""
    fact = spark.createDataFrame(
        [(i % 3, i % 5, Decimal(f"{i}.25"), Decimal("1.00"), Decimal("0.50")) for i in range(40)],
        "IdT int, IdN bigint, MONTO_PIA decimal(18,2), MONTO_PIM decimal(18,2), MONTO_RECAUDADO decimal(18,2)",
    )
    dims = {
        "T": spark.createDataFrame([(0, 2024), (1, 2024), (2, 2025)], "IdT int, ANIO int"),
        "N": spark.createDataFrame([(k, f"n{k % 2}") for k in range(5)], "IdN bigint, NAME string"),
    }
    joins = (DimJoin("T", "IdT", "IdT", (("ANIO", "ANIO"),)), DimJoin("N", "IdN", "IdN", (("DEPARTAMENTO", "NAME"),)))
    m = ("MONTO_PIA", "MONTO_PIM", "MONTO_RECAUDADO")
    small = aggregate_dashboard(fact, dims, joins, m)
    large = aggregate_dashboard(fact, dims, joins, m, max_broadcast_rows=0)
    assert rows(small) == rows(large) and len(rows(small)) == 4


def test_zero_pim_ratio_is_zero(spark):
    fact = spark.createDataFrame([(1, Decimal("0.00"), Decimal("0.00"), Decimal("3.00"))],
                                 "IdT int, MONTO_PIA decimal(18,2), MONTO_PIM decimal(18,2), MONTO_RECAUDADO decimal(18,2)")
    dims = {"T": spark.createDataFrame([(1, 2024)], "IdT int, ANIO int")}
    dash = add_budget_measures(aggregate_dashboard(fact, dims, (DimJoin("T", "IdT", "IdT", (("ANIO", "ANIO"),)),),
                                                   ("MONTO_PIA", "MONTO_PIM", "MONTO_RECAUDADO")))
    assert dash.collect()[0]["PORC_AVANCE_RECAUDACION"] == Decimal("0.000000")


def test_integrity_report(spark):
    child = spark.createDataFrame([(1, 1), (1, 1), (2, None), (9, 3)], "k bigint, v bigint")
    parent = spark.createDataFrame([(1,), (2,)], "k bigint")
    rep = integrity_report(child, not_null=["v"], unique=[["k", "v"]], foreign_keys=[(["k"], parent, ["k"], "k->parent")])
    got = {(r["check_type"], r["check_name"]): r["n_violations"] for r in rep.collect()}
    assert got == {("not_null", "v"): 1, ("unique", "k,v"): 1, ("foreign_key", "k->parent"): 1}


def test_dashboard_shuffles_numbers_of_texts(spark):
    from strata.operators.gold import DimJoin, aggregate_dashboard

    # equal names of two ids are one group, NULL names too; id 4 has two rows
    dim = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, None, "x"), (4, "b", None), (4, "c", None), (5, None, "x")], "id int, name string, kind string")
    fact = spark.createDataFrame([(i % 7, i % 2 + 1, i) for i in range(70)], "d int, e int, m int").selectExpr("d", "e", "CAST(m AS DECIMAL(18,2)) AS m")
    joins = [DimJoin("D", "d", "id", (("N", "name"), ("K", "kind"))), DimJoin("D", "e", "id", (("N2", "name"),))]
    sums = {}
    for i in range(70):
        for row in dim.collect():
            if row["id"] == i % 7:
                sums[row["name"], row["kind"], "a"] = sums.get((row["name"], row["kind"], "a"), 0) + i
    out = aggregate_dashboard(fact, {"D": dim}, joins, ["m"])
    assert out.columns == ["N", "K", "N2", "m"] and out.schema["m"].dataType.simpleString() == "decimal(38,2)"
    assert {tuple(r)[:3]: int(r["m"]) for r in out.collect()} == sums and out.count() == len(sums)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line and "sum(" in line]
    assert grouped and all("N#" not in line for line in grouped)
