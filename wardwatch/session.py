"""Session defaults and the shared folder that jobs keep intermediate tables in."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the operators rely on. Set on a new session, or given to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # In a message with a repeated key the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Checkpoints go away with the frames that use them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Bytes of one shuffle partition that sort well in an executor's memory.
PARTITION_BYTES = 256 * 1024**2
FEWEST_PARTITIONS = 200


def sized_for(shuffled_bytes: int) -> dict[str, str]:
    """Shuffle partitions for a job that shuffles about this much at once.

    Adaptive execution joins partitions that come out small, but it cannot cut those of
    an aggregate or a window, so a large job has to start with enough of them.
    """
    count = max(FEWEST_PARTITIONS, math.ceil(shuffled_bytes / PARTITION_BYTES))
    return {"spark.sql.shuffle.partitions": str(count)}


def build_session(name: str = "wardwatch", **conf: str) -> SparkSession:
    """A session with our defaults; ``conf`` adds to them or replaces them."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Where it is unset, a checkpoint folder set on the context does as well, and a local
    session (as in tests) gets a folder of its own. On a cluster a machine-local folder
    would be lost with its machine, so we refuse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder, so later steps survive a lost executor."""
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
