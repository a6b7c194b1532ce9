"""Session and shared-folder helpers.

Library code never builds its own session: every operator takes and returns
DataFrames.  ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

_SHIPPING = threading.Lock()


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "quarry", driver_memory: str = "8g",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster to be."""
    if shuffle_partitions is None:
        shuffle_partitions = 8 if cores == "*" else max(2, 2 * int(cores))
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Python workers import functions by module name.  A zip of the package is
    served by the driver like any ``--py-files`` entry, so a job runs from any
    folder and on machines where the package is not installed.
    """
    with _SHIPPING:  # models are fit from several threads
        _ship(spark.sparkContext)


def _ship(sc) -> None:
    if getattr(sc, "_quarry_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(package)
    target = os.path.join(tempfile.mkdtemp(prefix="quarry-code-"), f"{name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, package)))
    sc.addPyFile(target)
    sc._quarry_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only a ``local[...]`` session that names none, as in
    tests, gets a private folder; on a cluster that is an error, as a folder of
    one machine is not seen by the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}quarry/{name}/{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` once as a parquet table in the shared checkpoint folder and
    read it back: cuts lineage (a lost executor re-reads, never recomputes),
    and later passes -- e.g. a range partitioner's sampling job -- scan the
    columnar copy instead of re-running the upstream joins."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
