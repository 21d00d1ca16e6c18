"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied only where the cluster (or the caller) has not set a value.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles methods of more than 8000 bytes of code; a stage
    # whose one generated method is larger runs interpreted. Below this limit
    # Spark generates smaller methods for it instead (the rule CASE: half the time).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "tally",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the engine defaults.

    On a cluster leave ``master`` unset and let spark-submit decide; tests
    pass ``local[*]``. The UI stays off: no server is started.
    """
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when nothing is configured and
    the master is local (tests, laptops) do we create a folder of our own;
    on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="tally-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under the shared checkpoint location."""
    return os.path.join(ensure_checkpoint_dir(spark), "tally", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint location.

    Used for tables and files that a query writes and reads back. Results
    that are not yet computed may still read them; ``clean_scratch`` removes
    them when an application is done.
    """
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


_NAMED: dict[str, str] = {}


def note_table(spark: SparkSession, name: str, root: str) -> None:
    """Remember a catalog name given to files under ``root``."""
    _NAMED[name] = root


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the scratch location, and the catalog names given to it."""
    root = scratch_root(spark)
    for name in [n for n, where in _NAMED.items() if where.startswith(root)]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        del _NAMED[name]
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)
