"""Shared helpers: table access, shared-storage tables, shipping the package to
executors, prefix sums over partitions, and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

# Rows per Arrow batch: bounds what a Python worker holds of long texts.
ARROW_ROWS = "1000"


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder known, Arrow batches small, package importable on executors."""
    ensure_checkpoint_dir(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, ARROW_ROWS)
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Python workers import this package: from PYTHONPATH if the repository is
    on it, else from a zip that Spark distributes to every executor."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    on_path = (os.environ.get("PYTHONPATH") or "").split(os.pathsep)
    sc = spark.sparkContext
    if root in [os.path.abspath(p) for p in on_path if p] or getattr(sc, "_strata_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="strata-zip-"), "strata_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "strata")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    sc._strata_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder on the shared storage of spark.checkpoint.dir; Hadoop
    removes it when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to shared storage and read back: the table is
    computed once, survives lost executors and is columnar for later scans."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a stored table that no later plan reads."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def running_totals(totals: DataFrame, key: str, value: str) -> DataFrame:
    """(key, base): the sum of ``value`` over all smaller keys. One row per
    write task goes in, so the single-task window stays small: its rows count
    tasks, not data."""
    from pyspark.sql import Window

    w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, F.coalesce(F.sum(value).over(w), F.lit(0)).alias("base"))


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: bigint), the
    component being its smallest node.

    Contraction: each node hooks to its smallest neighbour or itself, the hooks
    are shortened by pointer jumping, and the edges are rewritten onto the
    roots until none is left. Every step is a join or a combinable min, so a
    node with very many links is split like any skewed join key."""
    edges = store(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), label
    )
    hooks = []
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hook = store(hook.select("node", F.least("node", "low").alias("parent")), label)
        while True:  # pointer jumping: parent of parent until nothing moves
            up = hook.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
            jumped = store(
                hook.join(up, "parent").select("node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")),
                label,
            )
            hook = jumped.select("node", "parent")
            if jumped.where("moved").isEmpty():
                break
        hooks.append(hook)
        left = hook.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = hook.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        edges = store(
            edges.join(left, "a").join(right, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            label,
        )
    if not hooks:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = hooks[0].select("node", F.col("parent").alias("component"))
    for hook in hooks[1:]:
        up = hook.select(F.col("node").alias("component"), F.col("parent").alias("higher"))
        out = out.join(up, "component", "left").select("node", F.coalesce("higher", "component").alias("component"))
    return store(out, label)
