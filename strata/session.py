"""Session construction and the shared work folder.

Jobs that must cut lineage or write intermediate tables use the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that is unset (local
runs, tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# The defaults the library runs with.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # Delete checkpoint files of frames that are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    A live session is returned as it is, and a launcher's master and shuffle
    partitions stand, unless they are passed here.  With neither, the master
    is ``local[$STRATA_CPUS or 8]`` with as many shuffle partitions.
    """
    live = SparkSession.getActiveSession()
    if live is not None and master is None and shuffle_partitions is None and not extra:
        return live   # its settings are its owner's
    launched = "SPARK_ENV_LOADED" in os.environ or "spark.master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "") \
        or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "") or "PYSPARK_GATEWAY_PORT" in os.environ
    cpus = int(os.environ.get("STRATA_CPUS", "8"))
    builder = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF) if live is None else {}
    if master or not (launched or live is not None):
        builder = builder.master(master or f"local[{cpus}]")
        conf["spark.sql.shuffle.partitions"] = str(cpus)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir`` if the cluster
    set it, else the context's checkpoint dir, else - in local mode only
    (tests, laptops) - a fresh local folder."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        # Executors cannot see a folder on the driver's disk.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(local)
    return local


def work_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint root for intermediate tables,
    landing files and streaming checkpoints."""
    root = checkpoint_root(spark) + "/strata-work"
    leaf = "/".join(p.strip("/") for p in parts if p)
    if unique:
        leaf = (leaf + "/" if leaf else "") + uuid.uuid4().hex[:12]
    return root + ("/" + leaf if leaf else "")


def materialize(df):
    """Compute ``df`` once into the shared checkpoint folder and cut its
    lineage (reused several times, and a lost executor does not force a
    recomputation from the sources).  Never a local checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
