"""Session helpers: a local session for tests/jobs and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tripcraft") -> SparkSession:
    """Session for tests and local runs. On a cluster, `spark-submit` supplies the session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's `spark.checkpoint.dir`. Only a local-mode session without that setting
    (tests) gets a fresh scratch folder; a cluster session without it is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="tripcraft-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stored(df, name: str):
    """Write an intermediate table to the shared folder; returns it as a scan, and the size of its files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return spark.read.schema(df.schema).parquet(path), size


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def ship_package(spark: SparkSession | None = None) -> None:
    """Make `tripcraft` importable in executor Python workers (pandas UDFs, mapInPandas).

    Zips the package once per process and adds it with `SparkContext.addPyFile` (what
    `spark-submit --py-files` does), once per application."""
    import os
    import zipfile

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    if not _ZIP:
        pkg = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="tripcraft-pyfiles-"), "tripcraft.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for root, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        _ZIP.append(out)
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(sc.applicationId)
