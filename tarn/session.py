"""Session settings and the shared folder for checkpoints and scratch files."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "tarn", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, whose
    executors are this very machine, may fall back to a fresh temporary folder, which goes
    when the program ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            configured = tempfile.mkdtemp(prefix="tarn-")
            atexit.register(shutil.rmtree, configured, ignore_errors=True)
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier call has handed out."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from the stored rows.

    For results read several times: a lost executor costs a re-read of its files,
    not a recomputation of everything upstream.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from the files.

    Like :func:`materialise`, but what is read later is pruned by column, filtered on reading and of
    a size that Spark knows when it plans a join.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
