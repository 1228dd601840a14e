"""Session helpers: building a session, the shared scratch folder and
size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest lookup side (rows) that is ever broadcast.
BROADCAST_MAX_ROWS = 1_000_000


def _driver_memory() -> str:
    """About 60% of physical memory, at most 16 GiB (local mode runs all
    tasks in the driver JVM)."""
    try:
        with open("/proc/meminfo") as f:
            kb = int(next(line for line in f if line.startswith("MemTotal")).split()[1])
        gb = max(1, min(16, int(kb / 1024 / 1024 * 0.6)))
    except (OSError, StopIteration, ValueError):
        gb = 4
    return f"{gb}g"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "waybatch") -> SparkSession:
    """Session for tests and local runs; on a cluster use the cluster's own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", _driver_memory())
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without one (tests) gets a folder chosen here; a
    cluster session must name a folder every executor can reach.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="waybatch-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/waybatch/{name}-{uuid.uuid4().hex[:12]}"


def row_bound(df: DataFrame, max_rows: int) -> int | None:
    """Row count if it is at most ``max_rows``, else None.

    Reads at most ``max_rows + 1`` rows, so the check is bounded.
    """
    n = df.limit(max_rows + 1).count()
    return n if n <= max_rows else None


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint behind a checked row bound; otherwise a plain join."""
    return F.broadcast(df) if row_bound(df, max_rows) is not None else df


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path (or glob) matches anything on its Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath)
    return found is not None and len(found) > 0


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a scratch folder of this library on its Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes ``waybatch`` importable by Python workers (pandas functions
    refer to it by module name), like ``--py-files``: the package is zipped
    on the driver once per application and handed to ``addPyFile``, which
    serves it to every executor. Harmless where it is installed already."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import waybatch

    pkg_dir = os.path.dirname(os.path.abspath(waybatch.__file__))
    root = os.path.dirname(pkg_dir)
    fd, zip_path = tempfile.mkstemp(prefix="waybatch-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, names in os.walk(pkg_dir):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zip_path)
    _SHIPPED.add(sc.applicationId)
