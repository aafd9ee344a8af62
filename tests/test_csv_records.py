"""CSV records cut in parallel over the splits of a file, against Python's csv module."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.csv_records import header_names, read_records, split_records
from strata.sources.files import read_csv_repaired, read_dataset
from tests.conftest import rows


def _write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


@pytest.fixture
def small_splits(spark):
    """Splits of 400 bytes: a file of a few kilobytes has many."""
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _field(rng):
    return "".join(rng.choice(['"', ",", "\n", "a", "é", " ", "b", "\n\n", '"",', "x" * 30]) for _ in range(rng.randint(0, 9)))


@pytest.mark.parametrize("seed,quoting", [(1, csv.QUOTE_MINIMAL), (2, csv.QUOTE_ALL), (3, csv.QUOTE_NONNUMERIC)])
def test_records_equal_the_csv_module(spark, tmp_dir, small_splits, seed, quoting):
    rng = random.Random(seed)
    want, paths = [], []
    for k in range(3):
        out = io.StringIO(newline="")
        w = csv.writer(out, quoting=quoting, lineterminator=rng.choice(["\n", "\r\n"]))
        w.writerow(["k", "a", "b, c"])
        body = [[f"{k}-{i}", _field(rng), "y" * 700 + "\n" if i == 5 else _field(rng)] for i in range(30)]
        w.writerows(body)
        paths.append(_write(os.path.join(tmp_dir, f"f{k}.csv"), out.getvalue()))
        want += body
    got = read_records(spark, paths, infer=False).fillna("")
    assert got.columns == ["k", "a", "b, c"]
    assert rows(got) == sorted(tuple(r) for r in want)
    records = split_records(spark, paths)
    assert records.select("file", "block").distinct().count() >= 9 and records.count() == 93


def test_open_quotes_and_stray_quotes(spark, tmp_dir, small_splits):
    stray = _write(os.path.join(tmp_dir, "a.csv"), 'x,y\n' + 'in"side,5"\n' * 40 + '"q" tail,z\n')
    assert read_records(spark, [stray]).where("y = '5\"'").count() == 40
    assert read_records(spark, [stray]).count() == 41
    lost = _write(os.path.join(tmp_dir, "b.csv"), "x,y\n1,2\n" + '3,"never closed\n' + "4,5\n" * 60)
    got = split_records(spark, [lost]).select("record").collect()
    assert len(got) == 3 and max(len(r[0]) for r in got) > 240
    one = _write(os.path.join(tmp_dir, "c.csv"), "\n\n \nx\n\n1\n")
    assert rows(read_records(spark, [one])) == [(1,)]
    assert read_records(spark, [_write(os.path.join(tmp_dir, "d.csv"), "")]).columns == []


def test_more_than_one_task_reads_a_file(spark, tmp_dir, small_splits):
    body = "".join(f'{i},"line one\nline two of {i}"\n' for i in range(200))
    path = _write(os.path.join(tmp_dir, "long.csv"), "id,text\n" + body)
    df = read_dataset(spark, path)
    assert dict(df.dtypes) == {"id": "int", "text": "string"}
    assert rows(df.select("id")) == [(i,) for i in range(200)]
    assert df.where(F.col("text") == F.concat(F.lit("line one\nline two of "), F.col("id").cast("string"))).count() == 200
    tasks = spark.read.option("lineSep", "\n").text(path).select(F.spark_partition_id()).distinct().count()
    assert tasks >= 10


def test_repair_before_cutting(spark, tmp_dir, small_splits):
    body = "".join(f'"{i}","say "hi" C:\\, {i}"\r\n' for i in range(100))
    path = _write(os.path.join(tmp_dir, "r.csv"), chr(0xFEFF) + '"n","t"\r\n' + body + '"n","t"\r\n')
    got = read_csv_repaired(spark, path)
    assert got.columns == ["n", "t"] and got.count() == 101
    assert got.where("n = 'n'").count() == 1 and got.where("t LIKE 'say hi C:%'").count() == 100


def test_headers_and_vintages(spark, tmp_dir):
    assert header_names('a,,"b ""q"", c",A', ",") == ["a0", "_c1", 'b "q", c', "A3"]
    p = _write(os.path.join(tmp_dir, "p.csv"), "a;b\n1;2\n3\n4;5;6\n")
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.IntegerType())])
    assert rows(read_records(spark, [p], sep=";", schema=schema)) == [(1, 2), (3, None), (4, 5)]
    q = _write(os.path.join(tmp_dir, "q.csv"), "b;c\n2.5;x\n")
    assert rows(read_records(spark, [p, q], sep=";").select("b", "c")) == [(None, None), (2.0, None), (2.5, "x"), (5.0, None)]
    with pytest.raises(ValueError):
        read_records(spark, [q], sep=";", schema=T.StructType([T.StructField("z", T.LongType())]))
