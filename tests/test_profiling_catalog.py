import json
import os

from strata.operators.profiling import (
    NULLS_AS_VALUE,
    candidate_keys,
    declared_fd_check,
    declared_fd_violations,
    fd_matrix,
    functional_dependencies,
    normalize_2nf,
    parse_declared,
    partial_dependencies,
)
from strata.sources.catalog import available_titles, discover_links, first_matching_link, select_resources
from strata.sources.manifest import build_entries, ingest
from tests.conftest import SF_SMALL, rows


def _fd_frame(spark):
    return spark.createDataFrame(
        [
            ("k1", "a", None, None, 1),
            ("k1", "a", None, "x", 1),
            ("k2", "b", None, None, 2),
            ("k2", "b", None, None, 3),
            (None, "c", None, "y", 4),
        ],
        "k string, dep string, allnull string, mixed string, other int",
    )


def test_fd_null_semantics(spark):
    df = _fd_frame(spark)
    got = {r["dependent"] for r in functional_dependencies(df, "k").collect()}
    # all-NULL column is constant; a {NULL, x} group is not (NULL counts as a value)
    assert got == {"dep", "allnull"}
    ignoring = {r["dependent"] for r in fd_matrix(df, ["k"], nulls="ignore").collect()}
    assert ignoring == {"dep", "allnull", "mixed"}


def test_fd_on_a_sample(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, v string").coalesce(1)
    assert fd_matrix(df, ["k"]).count() == 0  # whole table: k -> v does not hold


def test_fd_matrix_and_declared(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "y")], "id int, g string, h string")
    pairs = {(r["determinant"], r["dependent"]) for r in fd_matrix(df).collect()}
    assert pairs == {("id", "g"), ("id", "h"), ("g", "h"), ("h", "g")}
    decl = parse_declared(["g:h,id", "", "id:g"])
    rep = {(r["determinant"], r["dependent"]): r["n_violations"] for r in declared_fd_check(df, decl).collect()}
    assert rep == {("g", "h"): 0, ("g", "id"): 1, ("id", "g"): 0}


def test_violating_groups_of_declared_dependencies(spark):
    data = [(g, v, n) for n, (g, v) in enumerate([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("c", None), ("c", "z"), (None, "p"), (None, "q"), ("e", None), ("f", "x"), ("f", "z")])]
    df = spark.createDataFrame(data, "g string, v string, n int")
    decl = parse_declared(["g:v,n", "n:v"])

    def found(nulls, groups=10):
        return {
            (r["determinant"], r["dependent"], json.loads(r["key"])["g"]): (r["n_rows"], [json.loads(s)["v"] for s in r["samples"]])
            for r in declared_fd_violations(df, decl, nulls, groups).collect() if r["dependent"] == "v"
        }

    both = {("g", "v", "a"): (3, ["x", "y"]), ("g", "v", "f"): (2, ["x", "z"])}
    assert found("ignore") == both
    assert found(NULLS_AS_VALUE) == both | {("g", "v", "c"): (2, [None, "z"]), ("g", "v", None): (2, ["p", "q"])}
    assert len(found(NULLS_AS_VALUE, 2)) == 2
    for nulls in (NULLS_AS_VALUE, "ignore"):
        counts = {(r["determinant"], r["dependent"]): r["n_violations"] for r in declared_fd_check(df, decl, nulls).collect()}
        assert counts["g", "v"] == len(found(nulls)) and counts["n", "v"] == 0


def test_partial_dependencies_and_2nf(spark):
    df = spark.createDataFrame(
        [(1, 10, "p1", "s10", 5.0), (1, 20, "p1", "s20", 6.0), (2, 10, "p2", "s10", 7.0), (None, 10, "pn", "s10", 1.0)],
        "pk int, sk int, pname string, sname string, qty double",
    )
    deps = {(r["subset"], r["dependent"]) for r in partial_dependencies(df, ["pk", "sk"]).collect()}
    assert deps == {("pk", "pname"), ("sk", "sname")}
    tables = normalize_2nf(df, ["pk", "sk"], nulls=NULLS_AS_VALUE)
    assert set(tables) == {"pk", "sk", "main"}
    assert tables["main"].columns == ["pk", "sk", "qty"]
    # lossless under nulls-as-value: joining back gives the original rows
    back = tables["main"].join(tables["pk"], "pk", "left").join(tables["sk"], "sk", "left")
    assert back.count() == df.count()


def test_candidate_keys_minimal_and_capped(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "a")], "x int, y int, z string")
    keys = sorted(sorted(k) for k in candidate_keys(df))
    assert keys == [["x", "y"], ["x", "z"]]
    dup = spark.createDataFrame([(1, 1), (1, 1)], "x int, y int")
    assert candidate_keys(dup, max_key_size=2) == []


def test_map_columns_are_left_out_and_reported(spark):
    from strata.operators.profiling import unprofiled_columns

    df = spark.createDataFrame([(1, {"a": 1}, "x"), (2, {"b": 2}, "x")], "k int, m map<string,int>, v string")
    assert unprofiled_columns(df) == ["m"]
    pairs = {(r["determinant"], r["dependent"]) for r in fd_matrix(df).collect()}
    assert pairs == {("k", "v")}


def test_select_resources(spark):
    res = spark.createDataFrame(
        [("Ingreso 2024", "http://h/a.csv"), ("Ingreso 2023", "http://h/b.csv"), ("Ingreso 2024", "http://h/c.json"), ("Sin año", "http://h/d.csv")],
        "resource_title string, resource_url string",
    )
    assert rows(select_resources(res, [2024]).select("resource_url")) == [("http://h/a.csv",)]
    assert select_resources(res, download_all=True).count() == 3
    # nothing for 2030: the caller reports what is on offer instead
    assert select_resources(res, [2030]).count() == 0
    assert rows(available_titles(res)) == [("Ingreso 2023",), ("Ingreso 2024",), ("Sin año",)]


def test_link_discovery_and_first_zip(spark):
    html = '<p><a href="/ds/1">RENAMU 2023</a> <a href="https://o/x.zip">data</a> <a class="c" href="/ds/2">renamu 2024</a></p>'
    pages = spark.createDataFrame([(1, "https://portal.example/search?q=1", html)], "page_id long, url string, html string")
    got = rows(discover_links(pages, "renamu", years=[2024]).select("resolved_url", "anchor_text"))
    assert got == [("https://portal.example/ds/2", "renamu 2024")]
    first = first_matching_link(pages, r"\.zip$").collect()[0]
    assert first["href"] == "https://o/x.zip"


def test_manifest_naming_rules():
    cfg = {
        "datasets": [
            {"S": {"database": "db", "schema": "bronze", "tables": [
                {"names": ["INGRESO"], "years": [2024], "variants": {"2025": ["DIARIO"]}, "tablename": "ingreso_raw"},
                {"names": ["R"], "years": [2023], "modules": ["01"], "subdir": "mods", "tablename": "r_raw"},
                {"names": ["Y"], "years": [2022], "type": "csv", "tablename": "y_raw"},
                {"names": ["S1"], "tablename": "s_raw"},
            ]}}
        ]
    }
    got = [(e["file_path"], e["tablename"]) for e in build_entries(cfg)]
    assert got == [
        ("2024-INGRESO.parquet", "ingreso_raw"),
        ("2025-INGRESO-DIARIO.parquet", "ingreso_raw_diario"),
        (os.path.join("mods", "R_2023_modulo_01.parquet"), "r_raw_mod01"),
        ("Y_2022.csv", "y_raw"),
        ("S1.parquet", "s_raw"),
    ]


def test_manifest_ingest_reports_missing_and_failed(spark, tmp_dir):
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(os.path.join(tmp_dir, "A_2023.parquet"))
    spark.createDataFrame([(2, 5)], "k int, w int").write.parquet(os.path.join(tmp_dir, "A_2024.parquet"))
    with open(os.path.join(tmp_dir, "B.parquet"), "w") as fh:
        fh.write("not parquet")
    cfg = {"datasets": [{"S": {"tables": [
        {"names": ["A"], "years": [2023, 2024, 2025], "tablename": "a_raw"},
        {"names": ["B"], "tablename": "b_raw"},
    ]}}]}
    status, tables = ingest(spark, json.loads(json.dumps(cfg)), tmp_dir)
    st = {(r["filename"], r["status"]) for r in status.collect()}
    assert ("A_2023.parquet", "loaded") in st and ("A_2025.parquet", "missing") in st
    assert rows(tables["a_raw"]) == [(1, "a", None), (2, None, 5)]


def test_profiling_in_several_passes_equals_one_pass(spark):
    from strata.operators import profiling as P

    df = spark.createDataFrame([(i, i % 3, i % 2, i // 2, f"s{i % 3}") for i in range(12)], "a int, b int, c int, d int, e string")
    one = {(r["determinant"], r["dependent"]) for r in P.fd_matrix(df).collect()}
    many = {(r["determinant"], r["dependent"]) for r in P.constancy(df, [[c] for c in df.columns], max_sets_per_pass=2).filter("n_violations = 0").collect()}
    assert one == many and ("b", "e") in one and ("e", "b") in one
    keys_one = sorted(sorted(k) for k in P.candidate_keys(df, 3))
    old = P.MAX_SETS_PER_PASS
    P.MAX_SETS_PER_PASS = 2
    try:
        keys_many = sorted(sorted(k) for k in P.candidate_keys(df, 3))
    finally:
        P.MAX_SETS_PER_PASS = old
    assert keys_one == keys_many


def test_key_of_all_columns_is_found(spark):
    df = spark.createDataFrame([(a, b, c, d) for a in (0, 1) for b in (0, 1) for c in (0, 1) for d in (0, 1)], "a int, b int, c int, d int")
    assert [sorted(k) for k in candidate_keys(df)] == [["a", "b", "c", "d"]]


def test_names_with_dots_commas_and_quotes(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0)], ["a.b", "it's, so", "c`d"])
    assert ("a.b", "it's, so") in {tuple(r) for r in fd_matrix(df).collect()}


def test_ingest_same_for_path_and_uri_and_isolates_bad_files(spark, tmp_dir):
    import os

    spark.range(3).write.parquet(os.path.join(tmp_dir, "good.parquet"))
    os.makedirs(os.path.join(tmp_dir, "bad.parquet"))
    with open(os.path.join(tmp_dir, "bad.parquet", "part-0.parquet"), "wb") as fh:
        fh.write(b"no parquet")
    cfg = {"datasets": [{"S": {"tables": [{"names": ["good", "bad", "none"], "tablename": "t"}]}}]}
    for folder in (tmp_dir, "file://" + tmp_dir):
        status, tables = ingest(spark, cfg, folder)
        assert {(r["filename"], r["status"], r["n_rows"]) for r in status.collect()} == {
            ("good.parquet", "loaded", 3), ("bad.parquet", "failed", None), ("none.parquet", "missing", None)
        }
        assert tables["t"].count() == 3


def test_false_row_bound_is_not_recorded(spark):
    from strata.operators.joins import is_bounded

    df = spark.range(1000)
    assert not is_bounded(df, 10) and not is_bounded(df, 100) and is_bounded(df, 1000)


def test_names_with_commas_stay_apart(spark):
    from strata.operators.profiling import label

    df = spark.createDataFrame([(i, i % 3, f"{i}", i % 3) for i in range(9)], ["a", "b", "a,b", "d"])
    assert label(["a", "b"]) == "a,b" and label(["a,b"]) == "`a,b`"
    found = {tuple(r) for r in partial_dependencies(df, ["a", "b", "a,b"]).collect()}
    assert {("a,b", "d"), ("`a,b`", "d"), ("b", "d")} <= found
    assert {"a,b", "`a,b`", "b"} <= set(normalize_2nf(df, ["a", "b", "a,b"]))


def test_nested_maps_are_left_out(spark):
    from strata.operators.profiling import unprofiled_columns

    df = spark.sql("SELECT id, named_struct('m', map('k', id)) AS s, array(map('k', id)) AS a, named_struct('x', id) AS o FROM range(4)")
    assert unprofiled_columns(df) == ["s", "a"]
    assert {tuple(r) for r in fd_matrix(df).collect()} == {("id", "o"), ("o", "id")}
    assert sorted(map(sorted, candidate_keys(df))) == [["id"], ["o"]]


def test_few_witnesses_change_nothing(spark, monkeypatch):
    """Whatever the witness rows are, dependencies and keys are those of all rows."""
    from strata.operators import profiling as P

    df = spark.sql("SELECT id AS a, id % 50 AS b, (id % 50) % 7 AS c, CAST(id % 50 AS STRING) AS d, IF(id = 499, 9, id % 5) AS e, timestamp_micros(id) AS t FROM range(500)")
    results = []
    for n in (1, 40, 20_000):
        monkeypatch.setattr(P, "WITNESS_ROWS", n)
        results.append((sorted(map(tuple, fd_matrix(df).collect())), sorted(map(sorted, candidate_keys(df))), sorted(map(tuple, partial_dependencies(df, ["a", "b"]).collect()))))
    assert results[0] == results[1] == results[2]
    brute = {(x, y) for x in df.columns for y in df.columns if x != y and df.select(x).distinct().count() == df.select(x, y).distinct().count()}
    assert set(results[0][0]) == brute and results[0][1] == [["a"], ["t"]]


def test_manifest_from_any_storage(spark, tmp_dir):
    from strata.sources.manifest import load_manifest

    path = os.path.join(tmp_dir, "m.json")
    with open(path, "w", encoding="utf-8") as fh:
        json.dump({"datasets": [], "name": "é"}, fh, indent=1)
    assert load_manifest(path) == load_manifest("file://" + path, spark) == {"datasets": [], "name": "é"}


def test_combinations_are_keys_by_hash_parts_and_values(spark, monkeypatch):
    from strata.operators import profiling as P

    data = [(i, i % 40, None if i % 2 else i, i if i % 2 else None, float(i // 2)) for i in range(200)]
    df = spark.createDataFrame([*data, (200, 40, None, None, -0.0)], "a int, b int, c int, d int, e double")
    combos = [["a"], ["b"], ["c"], ["c", "d"], ["b", "e"], ["a", "b"], ["e"]]
    expected = [True, False, False, True, True, True, False]
    values = []
    by_value = P._unique_by_value
    monkeypatch.setattr(P, "_unique_by_value", lambda d, k, m=None: values.append((d.count(), k)) or by_value(d, k, m))
    assert P._unique_combos(df, combos) == expected
    # only rows of repeated hashes are compared by value
    assert values and all(n < 201 for n, _ in values)
    # hashes that all collide prove nothing: values decide
    monkeypatch.setattr(P, "_key_hash", lambda d, k: P.F.lit(7).cast("long"))
    assert P._unique_combos(df, combos) == expected
    assert P.column_cardinalities(df) == {"a": 201, "b": 41, "c": 101, "d": 101, "e": 100}


def test_dependencies_are_compared_over_distinct_rows(spark, monkeypatch):
    from strata.operators import profiling as P

    data = [(k % 5, f"n{k % 5}", None if k == 7 else "x", k) for k in range(100)] + [(None, f"m{k}", "x", k) for k in range(3)]
    df = spark.createDataFrame(data, "k int, name string, gap string, n int")
    seen = []
    passes = P._passes
    monkeypatch.setattr(P, "_witnesses", lambda d, c: d.limit(1))
    monkeypatch.setattr(P, "_passes", lambda d, *a: seen.append(d.count()) or passes(d, *a))
    assert P.holding(df.select("k", "name", "gap"), [["k"]], nulls=P.NULLS_IGNORED) == [(0, "gap"), (0, "name")]
    assert P.holding(df.select("k", "name", "gap"), [["k"]], nulls=P.NULLS_AS_VALUE) == []
    assert max(seen) <= 9  # never the whole table


def test_part_supplier_lines_are_dealt_by_rows(spark, monkeypatch):
    from strata.plans import profiling_queries as Q

    monkeypatch.setattr(Q, "ROWS_PER_TASK", 100)
    lines = Q._part_supplier_lines(spark, SF_SMALL)
    assert "REPARTITION_BY_NUM" in lines._jdf.queryExecution().executedPlan().toString()
