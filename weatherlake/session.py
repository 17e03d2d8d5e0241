"""Session builder and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Options every job here wants.  ANSI mode stays on (the Spark 4 default): parsing goes
# through the try_* functions, so bad text becomes NULL and real bugs still fail.
OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where the join output feeds an aggregate on the
    # same key: the extra exchange is cheaper than one task holding the hot key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Window state lives on disk beside the executor instead of in its heap, and is backed
    # up to the checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "weatherlake", master: str | None = None, **options: str) -> SparkSession:
    """Create (or reuse) a session; keyword options use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in OPTIONS.items():
        builder = builder.config(key, value)
    for key, value in options.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a scratch folder is used on a local master only; on a
    cluster a machine-local folder would be lost with its executor, so we refuse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="weatherlake-checkpoint-"))
    return context.getCheckpointDir()
