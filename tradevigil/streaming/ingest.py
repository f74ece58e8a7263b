"""File-arrival ingest: a stream of landed files, loaded batch by batch as a batch run loads them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradevigil.plans.stages import Stages
from tradevigil.schemas import FEEDS, FeedSpec
from tradevigil.sources.feeds import LOAD_COLUMNS, load_files

BatchStep = Callable[[DataFrame], None]


def landing_stream(spark: SparkSession, src_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """(file_path) of the *.csv files of a folder as they land; contents are not read."""
    landed = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(src_dir)
    )
    return landed.select(F.col("_metadata.file_path").alias("file_path"))


def ingest_stream(
    spark: SparkSession,
    feed: FeedSpec | str,
    src_dir: str,
    checkpoint: str,
    table: str | None = None,
    then: BatchStep | None = None,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Take in what has landed, then stop; the checkpoint remembers the files.

    A micro-batch is a list of files, loaded as a batch run loads them: every row, into
    the same table and ledger (beside `table`). Files the ledger holds are not loaded again,
    so a replayed batch, a lost checkpoint or an earlier batch run adds nothing. `then` gets
    the stored rows of each batch, without the load columns.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    target = table or feed.table
    ledger = ".".join([*target.split(".")[:-1], feed.ledger])

    def store(batch: DataFrame, batch_id: int) -> None:
        paths = [r["file_path"] for r in batch.collect()]  # names, at most `files_per_trigger`
        if not paths:
            return
        rows = load_files(batch.sparkSession, paths, target, ledger, feed.dates, feed.doubles)
        if rows is None:
            return
        # batches run in a session of their own; let the caller's see the new files
        spark.catalog.refreshTable(target)
        if then is not None:
            then(rows.drop(*LOAD_COLUMNS))

    return (
        landing_stream(spark, src_dir, files_per_trigger)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def feature_step(database: str) -> BatchStep:
    """Per-batch step that brings base, proximity, store and investigated trades up to date.

    It takes the files that the batch has added to the trades, found by the stage ledger, so a
    replayed batch changes nothing and a step that stopped is completed by the next. New
    trades join the dimension and network tables as they stand and are measured by the
    clients' stored state: of old trades only the keys are read.
    """

    def step(batch: DataFrame) -> None:
        stages = Stages(batch.sparkSession, database)
        stages.grow_base(unique=True)
        stages.grow_store(proximity_of_batch=True)
        stages.grow_iq_trades()

    return step
