"""Session settings the operators count on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the next operator wanted its partitioning:
    # one more exchange is cheaper than one task with a third of the trades.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of one key that a merge join holds as they are; more go through a sorter,
    # which is read several times slower for each row of the other side.
    "spark.sql.sortMergeJoinExec.buffer.in.memory.threshold": "65536",
    # A task gets as many bytes as these, however large the tables are: what an aggregate or a
    # sort holds of narrow rows is many times that.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # Where every partition of the smaller side is this small, it is hashed and neither side
    # is sorted: wide rows then pass a join without being held or spilled.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings; sizes (cores, shuffle partitions) stay the cluster's."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


#: Bytes of rows that go to Python at once; Spark's own limit is 64 MB.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> SparkSession:
    """Whole texts go to Python in batches of bounded bytes: a batch is held several times over,
    by the executor, the worker process and what it makes of it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in `spark.checkpoint.dir`.

    Only where that is unset (local tests) a fresh temporary folder is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else tempfile.mkdtemp(prefix="tradevigil-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
