"""Session helpers.

The library never creates a module-level session.  Durable intermediate data
(checkpoints of iterative jobs, staged files) goes to the folder named by
``spark.checkpoint.dir``; a private folder is chosen only when that setting is
unset, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[*]", app: str = "quarry", **conf: str) -> SparkSession:
    """Get or create a session with settings suited to local runs."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at ``input_bytes / target_partition_bytes``
    (at least 2 per core) so the largest shuffle of a scan-sized table keeps
    partitions near the target; AQE then coalesces small ones and splits
    skewed ones (a partition over 5x the median and 1 GiB), so a key holding
    a third of the rows does not become one task.  Scan splits stay at
    128 MiB so tasks fit comfortably in executor memory.  Broadcasts stay
    behind Spark's size check (64 MiB, measured at run time by AQE).
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, registered on the context.

    It is the folder that ``spark.checkpoint.dir`` names, as it is named there
    (a URI stays a URI).  Where the setting is unset, a local session (tests)
    gets a folder of its own; any other master is refused, because executors
    could not read each other's files.  Every call returns the same folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named and not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not named:
        if sc.applicationId not in _LOCAL:
            made = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_SCRATCH", "/tmp"))
            _LOCAL[sc.applicationId] = f"file:{made}"
        named = _LOCAL[sc.applicationId]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def is_local(spark: SparkSession) -> bool:
    """Whether driver and tasks share one machine."""
    return spark.sparkContext.master.split("[")[0] == "local"


def stage_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared scratch folder for staged (derived) files."""
    return "/".join([scratch_dir(spark), "stage", *parts])
