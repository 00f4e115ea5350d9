"""Session settings and the shared folder every job writes intermediate tables to."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "skylake", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the library is tested with; `conf` adds or overrides some."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's `spark.checkpoint.dir`.

    Only a local-mode session, where driver and executors are one process, may go without the
    setting; it then gets one temporary folder, which is removed when the process ends. On a cluster a
    `file:` folder is refused: every machine would have one of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    local = context.master.startswith("local")
    if configured and not local and configured.startswith("file:"):
        raise RuntimeError(f"spark.checkpoint.dir must be shared by all executors, not {configured}")
    if configured:
        return configured.rstrip("/")
    if not local:
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if context.applicationId not in _LOCAL_DIRS:
        folder = tempfile.mkdtemp(prefix="skylake-")
        _LOCAL_DIRS[context.applicationId] = folder
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _LOCAL_DIRS[context.applicationId]


def scratch_root(spark: SparkSession) -> str:
    """Folder of the intermediate tables of this application."""
    return f"{shared_dir(spark)}/skylake/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the application's folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it when no result that reads them is needed any more."""
    remove(spark, scratch_root(spark))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application wrote."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Compute `df` once, write it to the shared folder and return the written table.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the plan) and gives
    the result a size that can be checked.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs that nothing refers to any more. It does so when the driver's heap is collected, which a
    large heap may put off until disks are full; call it after a large shuffle was settled."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
