"""Session construction and lineage cutting.

Lineage is cut with reliable ``DataFrame.checkpoint`` into the folder named by
``spark.checkpoint.dir``. On a cluster that folder must be shared storage and
must be configured by the deployment; only a local-mode session (tests, bench)
gets a private scratch folder when nothing is configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library relies on. AQE re-plans joins and
# coalesces/splits shuffle partitions at run time (skew join on); the time zone
# is pinned so that timestamp parsing is reproducible.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "strata",
    shuffle_partitions: int | None = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``.

    A folder is created here only for a local-mode session where the setting is
    unset; a cluster session without the setting is an error, because a
    machine-local folder does not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no driver-side context
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named:
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage") from None
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder on shared "
                "storage that every executor and the driver can reach"
            )
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder and return it.

    Used where a later step must see exactly the same rows in the same
    partitions twice (surrogate keys), which a recomputation after an executor
    loss would not guarantee.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder for one stored intermediate table, on the checkpoint storage;
    Hadoop removes it when the application ends."""
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Unlike ``checkpoint`` the result is columnar: later scans read only the
    columns they use and get filters pushed down. Used for an intermediate
    that several later plans scan (e.g. a bronze frame built by joins). ``codec``:
    the compression of its files, the session's if not given.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    stored = df.sparkSession.read.parquet(path)
    setattr(stored, _PATH_ATTR, path)
    return stored


_PATH_ATTR = "_strata_path"


def discard(stored: DataFrame) -> None:
    """Remove the files of a table that ``materialize`` stored and no later plan reads."""
    spark, path = stored.sparkSession, getattr(stored, _PATH_ATTR)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_STORED: dict[tuple, object] = {}


def once_per_input(spark: SparkSession, label: str, paths: list[str], build):
    """``build()`` once for each state of the input files in this application.

    For stored intermediate tables that several queries read (silver and gold):
    the first query builds them, the others read them. The state is the name,
    length and modification time of every file under ``paths``, so changed inputs
    are built anew.
    """
    conf, Path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    state = []
    for p in paths:
        walk = Path(p).getFileSystem(conf).listFiles(Path(p), True)
        while walk.hasNext():
            f = walk.next()
            state.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    key = (spark.sparkContext.applicationId, label, tuple(sorted(state)))
    if key not in _STORED:
        _STORED[key] = build()
    return _STORED[key]
