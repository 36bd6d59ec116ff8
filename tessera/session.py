"""Session construction and shared-storage scratch locations.

The library never picks a machine-local folder on its own: anything it
has to materialise (lineage cuts, staged files, streaming state) goes
under the folder the cluster names in ``spark.checkpoint.dir``.  Only
when that setting is absent (a laptop, a unit test) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants.  AQE re-plans joins and
# partition counts at runtime from real shuffle sizes; skew-join splits
# hot partitions of inner/outer joins; UTC keeps date parts stable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with our defaults; explicit ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, set from the session conf.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and
    is used as is; without it a cluster is refused, as executors would
    write to disks of their own.  Only a local master gets a temporary
    folder (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}-{uuid.uuid4().hex[:12]}"


def partition_settings(input_bytes: int, total_cores: int,
                       target_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing from the input size and the cluster's cores.

    Scan splits stay at ``target_bytes``; the initial shuffle partition
    count is the larger of 2x cores and input / target (so a partition of
    the biggest shuffle fits an executor's memory); AQE then
    coalesces small partitions to the advisory size at runtime.
    """
    n = str(max(2 * total_cores, -(-input_bytes // target_bytes)))
    return {"spark.sql.files.maxPartitionBytes": str(target_bytes),
            "spark.sql.shuffle.partitions": n,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": n,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)}


def input_bytes(paths: list[str]) -> int:
    """Total size of local input files (used by the bench)."""
    total = 0
    for p in paths:
        if os.path.isdir(p):
            for root, _dirs, files in os.walk(p):
                total += sum(os.path.getsize(os.path.join(root, f)) for f in files)
        elif os.path.exists(p):
            total += os.path.getsize(p)
    return total
