"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# For spark-submit or SparkSession.builder; none of them names a master or a machine.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.streaming.schemaInference": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The call site of every single column expression, of use only in error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Stages with many columns generate methods beyond the size the JVM compiles by default.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in a local session."""
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="penstock-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared folder, so later reads see the same rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """The small side of a join: computed, counted, and broadcast only if it is small.

    Beyond `most_rows` it is left to Spark, whose join then shuffles both sides and splits skewed
    keys.
    """
    fixed = pinned(df)
    return F.broadcast(fixed) if fixed.limit(most_rows + 1).count() <= most_rows else fixed
