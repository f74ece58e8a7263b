"""Batch ingest of landed CSV feeds: list, compare with the ledger, cast, append.

Raw tables carry two extra columns, `_source_file` and the partition column
`_load_id`. A load writes its rows as one new partition and then its ledger rows. If it
stops in between, the next run finds a partition the ledger does not know and enters
its files before it looks for new ones, so no file is loaded twice or lost. Streams load
by the same steps into the same layout. Columns are matched by name: files may bring them
in any order, leave some out (NULL) or add new ones (the table is widened). Case and white
space around names do not count. A file whose header names a column twice is entered in the
ledger with that error and without rows; the others are loaded. A feed has one writer at a time.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tradevigil.functions import columns as fx
from tradevigil.schemas import FEEDS, FeedSpec
from tradevigil.sources.tables import FORMAT, append, partition_columns, quoted, table_or_empty

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("load_ts", T.TimestampType()),
        T.StructField("_load_id", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
FILES_PER_LOAD = 10_000
LOAD_COLUMNS = ("_source_file", "_load_id")


def list_csv_files(spark: SparkSession, src_dir: str) -> DataFrame:
    """(file_path) of the landed *.csv files, any case; contents are not read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").load(src_dir)
    return listing.select(F.col("_metadata.file_path").alias("file_path"))


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header-driven scan, every cell as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(paths)


def cast_columns(df: DataFrame, dates: Sequence[str] = (), doubles: Sequence[str] = ()) -> DataFrame:
    """Cast the listed columns where present; cells that do not parse become NULL."""
    own = {c.lower(): c for c in df.columns}
    casts = {own[c.lower()]: F.try_to_date(own[c.lower()]) for c in dates if c.lower() in own}
    casts |= {own[c.lower()]: fx.as_double(own[c.lower()]) for c in doubles if c.lower() in own}
    return df.withColumns(casts)


def header_names(header: str) -> list[str]:
    """Column names of a header line, trimmed; ValueError where one comes twice, whatever its case."""
    names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")]))]
    lower = [n.lower() for n in names if n]
    twice = sorted({n for n in lower if lower.count(n) > 1})
    if twice:
        raise ValueError(f"header names a column twice: {', '.join(twice)}")
    return names


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    return files.join(ledger.select("file_path"), "file_path", "left_anti")


def _enter_unlisted_loads(spark: SparkSession, raw_table: str, ledger_table: str) -> None:
    """Ledger rows for partitions a stopped run left behind."""
    if not spark.catalog.tableExists(raw_table):
        return
    ledger = table_or_empty(spark, ledger_table, LEDGER_SCHEMA)
    loads = spark.sql(f"SHOW PARTITIONS {raw_table}").select(F.substring_index("partition", "=", -1).alias("_load_id"))
    unlisted = [r["_load_id"] for r in loads.join(ledger.select("_load_id"), "_load_id", "left_anti").collect()]
    if unlisted:
        left_behind = spark.table(raw_table).where(F.col("_load_id").isin(unlisted))
        _enter(left_behind.select(F.col("_source_file").alias("file_path"), "_load_id").distinct(), ledger_table)


def _enter(files: DataFrame, ledger_table: str) -> None:
    spark = files.sparkSession
    if spark.catalog.tableExists(ledger_table) and "error" not in spark.table(ledger_table).columns:
        spark.sql(f"ALTER TABLE {ledger_table} ADD COLUMNS (error string)")
    error = F.col("error") if "error" in files.columns else F.lit(None).cast("string").alias("error")
    append(files.select("file_path", F.current_timestamp().alias("load_ts"), "_load_id", error), ledger_table)


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    while part := list(islice(rows, size)):
        yield part


def incremental_load_from_dir(
    spark: SparkSession,
    src_dir: str,
    raw_table: str,
    processed_meta_table: str,
    date_cast_columns: Sequence[str] = (),
    numeric_cast_columns: Sequence[str] = (),
    files_per_load: int = FILES_PER_LOAD,
) -> DataFrame | None:
    """Load the files of a folder that no earlier run has loaded; None when there are none.

    Only file names pass the driver, `files_per_load` at a time. Returns this run's
    rows as stored.
    """
    _enter_unlisted_loads(spark, raw_table, processed_meta_table)
    ledger = table_or_empty(spark, processed_meta_table, LEDGER_SCHEMA)
    fresh = new_files(list_csv_files(spark, src_dir), ledger).orderBy("file_path")
    loads = []
    for part in _chunks((r["file_path"] for r in fresh.toLocalIterator()), files_per_load):
        loads.append(_load(spark, part, raw_table, processed_meta_table, date_cast_columns, numeric_cast_columns))
    if not loads or not spark.catalog.tableExists(raw_table):
        return None
    return spark.table(raw_table).where(F.col("_load_id").isin(loads))


def load_files(
    spark: SparkSession,
    paths: Sequence[str],
    raw_table: str,
    processed_meta_table: str,
    date_cast_columns: Sequence[str] = (),
    numeric_cast_columns: Sequence[str] = (),
) -> DataFrame | None:
    """Load those of the named files that the ledger does not hold; the rows of all of them as stored.

    Naming files again adds nothing, whether a batch or a stream loaded them first.
    None where no file was ever stored.
    """
    _enter_unlisted_loads(spark, raw_table, processed_meta_table)
    named = spark.createDataFrame([(p,) for p in paths], "file_path string")
    ledger = table_or_empty(spark, processed_meta_table, LEDGER_SCHEMA)
    fresh = sorted(r["file_path"] for r in new_files(named, ledger).distinct().collect())
    if fresh:
        _load(spark, fresh, raw_table, processed_meta_table, date_cast_columns, numeric_cast_columns)
    if not spark.catalog.tableExists(raw_table):
        return None
    spark.catalog.refreshTable(processed_meta_table)
    entered = spark.table(processed_meta_table).join(named, "file_path", "left_semi")
    loads = [r["_load_id"] for r in entered.select("_load_id").distinct().collect()]
    stored = spark.table(raw_table).where(F.col("_load_id").isin(loads))
    return stored.join(named.withColumnRenamed("file_path", "_source_file"), "_source_file", "left_semi")


def _load(
    spark: SparkSession, paths: list[str], raw_table: str, ledger_table: str, dates: Sequence[str], doubles: Sequence[str]
) -> str:
    load_id = uuid.uuid4().hex
    parts, refused = [], {}
    for header, same_header in _by_header(spark, paths).items():
        try:
            names = header_names(header)
        except ValueError as error:
            refused |= dict.fromkeys(same_header, str(error))
            continue
        rows = read_csv(spark, same_header)
        rows = rows.select(*[F.col(quoted(c)).alias(n or c) for c, n in zip(rows.columns, names, strict=False)], F.col("_metadata.file_path").alias("_source_file"))
        parts.append(cast_columns(rows, dates, doubles))
    if parts:
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        _append_load(every.withColumn("_load_id", F.lit(load_id)), raw_table)
    entries = [(p, load_id, refused.get(p)) for p in paths]
    _enter(spark.createDataFrame(entries, "file_path string, _load_id string, error string"), ledger_table)
    return load_id


def _by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files by their header line, as a CSV scan names all its columns by one file.

    One pass over the lines; a header per file comes back. Files without a line are left out.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        "value",
        F.input_file_block_start().alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    present = lines.where((F.col("block") == 0) & (F.trim("value") != ""))
    first = present.groupBy("file_path").agg(F.min_by("value", "line").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first.orderBy("file_path").toLocalIterator():
        groups.setdefault(row["header"], []).append(row["file_path"])
    return groups


def _append_load(rows: DataFrame, raw_table: str) -> None:
    """Add a load's partition; the table is widened by columns it does not know yet."""
    spark = rows.sparkSession
    if spark.catalog.tableExists(raw_table):
        if partition_columns(spark, raw_table) != ["_load_id"]:
            raise ValueError(f"{raw_table} is not partitioned by _load_id, so loads cannot be told apart in it")
        known = {f.name.lower() for f in spark.table(raw_table).schema}
        added = [f for f in rows.schema if f.name.lower() not in known]
        if added:
            columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {raw_table} ADD COLUMNS ({columns})")
        own = {f.name.lower() for f in rows.schema}
        for f in spark.table(raw_table).schema:
            if f.name.lower() not in own:
                rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        rows = rows.select(*[quoted(c) for c in spark.table(raw_table).columns])
    rows.write.mode("append").format(FORMAT).partitionBy("_load_id").saveAsTable(raw_table)


def load_feed(spark: SparkSession, feed: FeedSpec | str, src_dir: str, database: str | None = None) -> DataFrame | None:
    """One of the five declared feeds, into its table and ledger."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    prefix = f"{database}." if database else ""
    return incremental_load_from_dir(
        spark, src_dir, prefix + feed.table, prefix + feed.ledger, feed.dates, feed.doubles
    )


def feed_table(spark: SparkSession, feed: FeedSpec | str, database: str | None = None) -> DataFrame:
    """All loaded rows of a feed without the load columns; no rows where nothing is loaded."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    prefix = f"{database}." if database else ""
    return table_or_empty(spark, prefix + feed.table, feed.raw_schema).drop(*LOAD_COLUMNS)


def feed_sends(spark: SparkSession, feed: FeedSpec | str, database: str | None = None) -> DataFrame:
    """All loaded rows of a feed with `sent`, the time of their load; NULL for rows of no known load."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    prefix = f"{database}." if database else ""
    rows = table_or_empty(spark, prefix + feed.table, feed.raw_schema)
    if "_load_id" not in rows.columns:
        return rows.withColumn("sent", F.lit(None).cast("timestamp"))
    ledger = table_or_empty(spark, prefix + feed.ledger, LEDGER_SCHEMA)
    loads = ledger.groupBy("_load_id").agg(F.min("load_ts").alias("sent"))
    return rows.join(loads, "_load_id", "left").drop(*LOAD_COLUMNS)
