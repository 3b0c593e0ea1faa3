"""Spark session conventions shared by every job.

* UTC session time zone (the reference treats every timestamp as UTC).
* AQE on: runtime coalescing, skew-join splitting and size-checked
  broadcast conversion (``autoBroadcastJoinThreshold`` is the size check).
* ANSI stays on (Spark 4 default); code uses ``try_divide`` / ``nullif``.
* The checkpoint directory is read from the session; a scratch folder is
  only set when none is configured (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickwise", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the conventions above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conventions(spark)
    ship_package(spark)
    return spark


def apply_conventions(spark: SparkSession) -> None:
    """Set the runtime SQL options on an existing session (driver-made sessions)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's ``spark.checkpoint.dir``.

    Only when a session on one machine (``local[..]``) has none, a scratch folder is created
    and registered. On a cluster a machine-local path would lose files: an error is raised.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tickwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint directory.

    Used at operator boundaries whose plans are referenced many times (the
    feature table, the training frame), so the optimizer sees a scan instead
    of a deep tree, and a lost executor re-reads files instead of recomputing.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 executor_memory_gb: float, target_partition_mb: int = 256) -> dict:
    """Size shuffle and scan partitions for a cluster run.

    * scan splits of ``target_partition_mb`` (``spark.sql.files.maxPartitionBytes``);
    * shuffle partitions so that one partition is about ``target_partition_mb``
      of input, at least 3 waves over all cores, and a multiple of the core count;
    * AQE coalesces small partitions back to the same advisory size and splits
      skewed ones (> 5x median and > 1 GiB);
    * broadcast threshold stays small relative to executor memory, since AQE
      applies it to *measured* sizes.
    """
    cores = executors * cores_per_executor
    by_size = -(-input_bytes // (target_partition_mb << 20))
    parts = max(3 * cores, by_size)
    parts = -(-parts // cores) * cores
    broadcast_mb = max(10, min(512, int(executor_memory_gb * 1024 * 0.02)))
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": f"{broadcast_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": f"{broadcast_mb}m",
    }


def ship_package(spark: SparkSession) -> None:
    """Make ``tickwise`` importable in Python workers (pandas UDFs, mapInPandas).

    Functions passed to ``applyInPandas``/``mapInPandas`` are pickled by
    reference to this package, so every executor needs it. The package is
    zipped once per SparkContext and distributed with ``addPyFile`` (Spark's
    file server ships it to each executor), whatever the driver's working
    directory is.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tickwise_shipped", False):
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="tickwise-pkg-")
    zip_path = os.path.join(out_dir, "tickwise.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zip_path)
    sc._tickwise_shipped = True
