"""Session helpers: a local session for tests/bench and the shared folder for lineage cuts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sevlab",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A local session configured as the tests and the bench use it.

    On a cluster, build the session with the deployer's settings instead; the library never
    sets session configs itself.
    """
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
        .config("spark.driver.memory", os.environ.get("SEVLAB_DRIVER_MEMORY", "16g"))
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="sevlab-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per application. Spark's own file transfer
    takes it there, so workers need neither the driver's folder nor its search path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):  # a package that was itself imported from an archive is there already
        archive = os.path.join(tempfile.mkdtemp(prefix="sevlab-package-"), "sevlab.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(root)))
        sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    It is read from the session. Only where it is unset (local tests, the bench) a
    private folder is created and registered, so that lineage cuts and model files work.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder on shared storage (HDFS/S3/...): "
                             "lineage cuts and model files must be visible to every executor")
        d = tempfile.mkdtemp(prefix="sevlab-ckpt-")  # local mode only: driver and executors share this disk
        sc.setCheckpointDir(d)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never a machine-local temp dir on a cluster).
    It is deleted by ``release_scratch``, at the latest when the program ends."""
    path = f"{shared_dir(spark)}/sevlab/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_release_at_exit, spark)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Delete every scratch folder that this program has made; frames that read them must not be used
    afterwards. Returns how many there were."""
    n = 0
    while _SCRATCH:
        n += delete_path(spark, _SCRATCH.pop())
    return n


def _release_at_exit(spark: SparkSession) -> None:
    try:
        release_scratch(spark)
    except Exception:  # the JVM may be gone by then; its scratch folder outlives it only in that case
        _SCRATCH.clear()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a folder on the session's file system (HDFS/S3/local), e.g. a
    scratch copy that is no longer read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))
