"""Session helpers.

Every job in the package takes a ``SparkSession`` from its caller; this
module only builds one for tests, benches and scripts, and resolves the
shared working folder from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a local run needs; on a cluster the deployment supplies its own.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join sides above this size are never broadcast; Spark falls back to a
    # shuffled join.  AQE re-checks with runtime sizes.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names it in ``spark.checkpoint.dir`` (or has already called
    ``setCheckpointDir``); only when neither is set (local tests) do we make
    one, so jobs never fall back to a machine-local folder on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(scratch and checkpoint data must survive executor loss)")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(path)
    # setCheckpointDir creates a unique sub-folder; hand out that one.
    return sc.getCheckpointDir() or path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run.

    It goes with the driver: results read from it are lazy until then."""
    from tessera.sources.fs import HadoopFS
    root = ensure_checkpoint_dir(spark)
    sep = "" if root.endswith("/") else "/"
    path = f"{root}{sep}{name}-{uuid.uuid4().hex[:12]}"
    HadoopFS(spark).delete_on_exit(path)
    return path


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["local_session", "ensure_checkpoint_dir", "scratch_dir",
           "local_fs_path"]
