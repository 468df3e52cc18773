"""Session settings shared by the tests, the bench and command-line use."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as a zip, for functions that run there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "quillmesh_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that local folders are shared."""
    return spark.sparkContext.master.split("[")[0] == "local"


def durable(df: DataFrame) -> DataFrame:
    """A checkpoint in the cluster's shared folder; one of our own only in local mode."""
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quillmesh-"))
    return df.checkpoint()


def session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session. On a cluster, spark-submit settings win over these."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quillmesh")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quillmesh-")
    return base.rstrip("/")


_work: dict[str, SparkSession] = {}


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; what is written there goes when the driver's Python ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _work[path] = spark
    return path


@atexit.register
def _remove_work() -> None:
    for path, spark in _work.items():
        if SparkContext._active_spark_context is spark.sparkContext:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
