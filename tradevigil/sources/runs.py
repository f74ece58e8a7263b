"""Which files of its source tables a stage has taken, so that it reads new ones only.

A stage plans a batch (the files it has not taken yet), writes its rows, then enters
the batch as done. If it stops in between, the next run finds the planned batch and
repeats just that, with the same files; its writes then skip what is there already.
Where files that were taken are gone, the table was written anew: such a batch is marked, as
its rows may be old ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tradevigil.sources.tables import append, partition_columns

PLANNED, REWRITTEN, DONE = "planned", "rewritten", "done"


@dataclass(frozen=True)
class Batch:
    """Files of source tables for one run of a stage."""

    id: str
    files: dict[str, list[str]]
    before: dict[str, list[str]]  # files of the sources that the stage took earlier
    again: bool  # an earlier run of it stopped, so some of its rows may be stored
    rewritten: bool  # a source was written anew, so its rows may be old ones


class StageLedger:
    """The ledger table of the stages of one database."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def _entries(self, stage: str) -> list[Row]:
        if not self.spark.catalog.tableExists(self.name):
            return []
        return self.spark.table(self.name).where(F.col("stage") == stage).orderBy("entered").collect()

    def _enter(self, rows: list[tuple]) -> None:
        given = self.spark.createDataFrame(rows, "stage string, source string, file_path string, batch string, state string")
        append(given.coalesce(1).withColumn("entered", F.current_timestamp()), self.name)

    def _files(self, source: str) -> list[str]:
        if not self.spark.catalog.tableExists(source):
            return []
        self.spark.catalog.refreshTable(source)
        return self.spark.table(source).inputFiles()

    def batches(self, stage: str, sources: Sequence[str]) -> list[Batch]:
        """Batches to run, oldest first: those that stopped, then one of the files nobody took.

        File names pass the driver, as they do when a table is read.
        """
        entries = self._entries(stage)
        done = {r["batch"] for r in entries if r["state"] == DONE}
        planned: dict[str, list[Row]] = {}
        for r in entries:
            if r["state"] != DONE:
                planned.setdefault(r["batch"], []).append(r)
        there = {s: set(self._files(s)) for s in sources}
        taken: dict[str, set[str]] = {s: set() for s in sources}
        found = []
        for batch in sorted(planned, key=lambda b: b not in done):  # stopped ones last, in their order
            files: dict[str, list[str]] = {}
            for r in planned[batch]:
                files.setdefault(r["source"], []).append(r["file_path"])
            if batch not in done:
                rewritten = any(r["state"] == REWRITTEN for r in planned[batch])
                found.append(Batch(batch, files, _kept(taken, there), True, rewritten))
            for source, names in files.items():
                taken.setdefault(source, set()).update(names)
        new = {s: sorted(there[s] - taken[s]) for s in sources if there[s] - taken[s]}
        if new:
            rewritten = any(taken[s] - there[s] for s in new)
            batch = Batch(uuid.uuid4().hex, new, _kept(taken, there), False, rewritten)
            state = REWRITTEN if rewritten else PLANNED
            self._enter([(stage, s, f, batch.id, state) for s, files in new.items() for f in files])
            found.append(batch)
        return found

    def finish(self, stage: str, batch: Batch) -> None:
        self._enter([(stage, None, None, batch.id, DONE)])

    def _read(self, source: str, files: Sequence[str]) -> DataFrame:
        table = self.spark.table(source)
        kept = table.drop(*partition_columns(self.spark, source))
        if not files:
            return self.spark.createDataFrame([], kept.schema)
        return self.spark.read.schema(kept.schema).parquet(*[unquote(f) for f in files])

    def rows(self, source: str, batch: Batch) -> DataFrame:
        """The batch's rows of one source (a table that exists), without its partition columns."""
        return self._read(source, batch.files.get(source, []))

    def earlier(self, source: str, batch: Batch) -> DataFrame:
        """Rows of the source that the stage has taken before this batch."""
        return self._read(source, batch.before.get(source, []))


def _kept(taken: dict[str, set[str]], there: dict[str, set[str]]) -> dict[str, list[str]]:
    return {s: sorted(names & there.get(s, set())) for s, names in taken.items()}


def write_batch(df: DataFrame, name: str, batch: str) -> None:
    """The rows as partition `_batch` of the table; what a stopped run left of it goes."""
    spark = df.sparkSession
    rows = df.withColumn("_batch", F.lit(batch))
    if not spark.catalog.tableExists(name):
        rows.write.format("parquet").partitionBy("_batch").saveAsTable(name)
        return
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (_batch = '{batch}')")
    rows.select(*spark.table(name).columns).write.mode("append").format("parquet").partitionBy("_batch").saveAsTable(name)


def keep_only(spark: SparkSession, name: str, batch: str) -> None:
    """Drop all other batches of the table."""
    for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
        other = r["partition"].split("=", 1)[1]
        if other != batch:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (_batch = '{other}')")
