"""Session helpers.

The library never decides where a cluster keeps its files: the checkpoint folder is read
from ``spark.checkpoint.dir``; only when that is unset (unit tests, a laptop) does
:func:`checkpoint_dir` create a scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_spark(
    app: str = "sparkloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session or build one with scale-minded defaults.

    AQE stays on so shuffle partitions are coalesced and skewed join partitions split at
    run time; ``shuffle_partitions`` should be sized so one partition fits executor memory
    at the target scale (for 100 TB of input this is thousands, for tests a handful).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of intermediate tables are removed once nothing references them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster, or a scratch one when unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="sparkloom-ckpt-")  # one machine: tests, a laptop
    spark.sparkContext.setCheckpointDir(scratch)
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


def _scratch_root(spark: SparkSession) -> str:
    # one folder per application, so dropping it never touches another job's tables
    return os.path.join(checkpoint_dir(spark), f"sparkloom-{spark.sparkContext.applicationId}")


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A location under the checkpoint folder for intermediate tables written by a job."""
    return os.path.join(_scratch_root(spark), name)


def drop_scratch_tables(spark: SparkSession) -> None:
    """Delete this application's intermediate tables (call once their readers are done)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def materialize(df, known: bool = False):
    """Write ``df`` as a Parquet table under the checkpoint folder and read it back.

    This cuts the lineage like a reliable checkpoint (the files live in the shared folder,
    so a lost executor costs a re-read, never a recomputation), but computes ``df`` once
    (an eager RDD checkpoint runs the plan a second time to write it unless cached), stores
    it columnar, and gives later plans a file scan with column pruning and real size
    statistics. Used before iterative algorithms and for intermediates read several times.
    With ``known``, the schema is taken from ``df``, which saves the job that reads it from a file.
    """
    spark = df.sparkSession
    path = scratch_table_path(spark, f"{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return (spark.read.schema(df.schema) if known else spark.read).parquet(path)


def materialize_bucketed(df, column: str, buckets: int):
    """:func:`materialize`, clustered by ``column``: joins and cogroups on it that run with as many
    partitions read the files as they lie instead of shuffling them. Spark writes buckets only
    through its catalog; the entry is dropped at once, since the returned plan knows the files."""
    spark = df.sparkSession
    name = f"sparkloom_{uuid.uuid4().hex}"
    path = scratch_table_path(spark, name)
    df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column).option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application.

    Arrow and Pandas kernels are pickled by reference, so a worker must be able to import
    ``sparkloom`` whatever folder it was started in. Spark copies the zip to every executor.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    name = f"sparkloom-{spark.sparkContext.applicationId}.zip"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    # Spark's file server streams the zip from this driver-side file for as long as the
    # application runs; executors never read the folder itself
    folder = tempfile.mkdtemp(prefix="sparkloom-zip-")
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for at, _, names in os.walk(package):
            for source in sorted(names):
                if source.endswith(".py"):
                    full = os.path.join(at, source)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
