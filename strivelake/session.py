"""Session helpers: UTC session, scratch folders under the shared checkpoint dir."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "strivelake",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster the submitter sets master/conf."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every plan relies on (calendar years and ISO text in UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a purely local session (tests) may do without the setting: it gets a private
    folder, registered so later lineage cuts land in one place. On a cluster a
    machine-local folder would scatter the files, so a missing setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir() \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strivelake-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the checkpoint root for one run of one job.

    Spark's writers create it in whichever file system the checkpoint folder lives.
    """
    return f"{checkpoint_root(spark)}/strivelake/{name}-{uuid.uuid4().hex[:12]}"


# Target bytes per task for scans and shuffles on a cluster (fits executor memory
# with room for sort/aggregation buffers; AQE coalesces smaller partitions).
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_settings(input_bytes: int, *, target_bytes: int = TARGET_PARTITION_BYTES,
                     broadcast_bytes: int = 64 * 1024 * 1024) -> dict[str, str]:
    """Runtime SQL settings sized from the input volume.

    The initial shuffle partition count covers the whole input at the target
    size (an upper bound: partial aggregates and WindowGroupLimit shrink most
    shuffles, and AQE coalesces the partitions that come out small); skewed
    partitions are split by AQE skew join.
    """
    shuffle = max(200, -(-int(input_bytes) // target_bytes))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


def apply_cluster_settings(spark: SparkSession, input_bytes: int, **kw) -> dict[str, str]:
    conf = cluster_settings(input_bytes, **kw)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
