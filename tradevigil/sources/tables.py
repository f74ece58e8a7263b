"""Catalog tables: read, create, replace, keyed append, correction, reset."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tradevigil.operators.joins import not_yet_in, one_per_key

FORMAT = "parquet"


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows of the declared schema where it does not exist yet."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def append(df: DataFrame, name: str) -> None:
    """Add rows, creating the table when it is missing; columns are matched by name."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.mode("append").format(FORMAT).saveAsTable(name)
    else:
        df.write.format(FORMAT).saveAsTable(name)


def create_if_missing(df: DataFrame, name: str) -> bool:
    """Create the table from the query unless it exists; True when created."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    df.write.format(FORMAT).saveAsTable(name)
    return True


def replace(df: DataFrame, name: str, reads_itself: bool = False) -> None:
    """Create the table or replace its rows and schema; what it is partitioned by stays.

    A `df` that reads the table itself is written beside it and swapped in, see `swap_table`;
    others are written over it.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format(FORMAT).saveAsTable(name)
        return
    kept = [c for c in partition_columns(spark, name) if c in df.columns]
    if reads_itself and not kept:
        swap_table(df, name)
        return
    if reads_itself:
        if len(kept) > 1:
            raise ValueError(f"{name} is partitioned by several columns, which cannot be swapped in")
        new = [r["value"] for r in df.select(F.col(kept[0]).cast("string").alias("value")).distinct().collect()]
        old = [r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
        swap_partitions(df, name, kept[0], sorted({*new, *old}))
        return
    df.write.mode("overwrite").option("overwriteSchema", "true").format(FORMAT).partitionBy(*kept).saveAsTable(name)


# ---- swapping in ---------------------------------------------------------------

#: Suffix of the table that says which folders are to be swapped in.
SWAP = "__swap"


def location(spark: SparkSession, name: str, partition: str | None = None) -> str:
    """Folder of the table, or of one of its partitions (`column='value'`)."""
    part = f" PARTITION ({partition})" if partition else ""
    rows = spark.sql(f"DESCRIBE FORMATTED {name}{part}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _beside(spark: SparkSession, name: str) -> str:
    """A new folder next to the table's database."""
    return f"{location(spark, name).rstrip('/')}__next-{uuid.uuid4().hex[:8]}"


def _add_columns(df: DataFrame, name: str) -> None:
    """Columns of `df` that the table does not have; rows it holds show NULL there."""
    spark = df.sparkSession
    known = {f.name.lower(): f.dataType for f in spark.table(name).schema}
    if any(known.get(f.name.lower(), f.dataType) != f.dataType for f in df.schema):
        raise ValueError(f"{name}: a column's type cannot change in place")
    added = [f for f in df.schema if f.name.lower() not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{quoted(f.name)} {f.dataType.simpleString()}' for f in added)})")


def swap_table(df: DataFrame, name: str) -> None:
    """Replace an unpartitioned table by `df`, which may read it: written beside, then one change of place.

    A stop before that change leaves the old table, after it the new one. Columns the table
    does not have yet are added before it (old rows show NULL); columns must not change their type.
    """
    spark = df.sparkSession
    old, new = location(spark, name), _beside(spark, name)
    df.write.format(FORMAT).save(new)
    _add_columns(df, name)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(name)
    _remove(spark, old)


def swap_partitions(df: DataFrame, name: str, column: str, values: Sequence[str]) -> None:
    """Replace partitions of a table by the rows of `df`, which may read them; all or none of them.

    The new rows are written beside the table. What is to be swapped is then entered in a
    table `<name>__swap`; from there on the swap is only ever completed (`recover`), before that
    only the old partitions are seen. A named partition without new rows goes, one the table
    does not have yet is added.
    """
    spark = df.sparkSession
    if not values:
        return
    new = _beside(spark, name)
    df.where(F.col(column).isin(list(values))).write.format(FORMAT).partitionBy(column).save(new)
    written = spark.read.parquet(new).select(F.col(column).cast("string")).distinct() if _has_files(spark, new) else None
    filled = {r[0] for r in written.collect()} if written is not None else set()
    there = {r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    rows = []
    for v in values:
        spec = f"{column}='{v}'"
        rows.append((spec, location(spark, name, spec) if v in there else None, f"{new}/{column}={v}" if v in filled else None))
    _add_columns(df, name)
    plan = spark.createDataFrame(rows, "spec string, old string, new string").coalesce(1)
    plan.write.format(FORMAT).saveAsTable(f"{name}{SWAP}")
    recover(spark, name)


def _has_files(spark: SparkSession, path: str) -> bool:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return not found.select("path").isEmpty()


def recover(spark: SparkSession, name: str) -> None:
    """Complete a swap that a stopped run left entered; nothing to do in all other cases."""
    entered = f"{name}{SWAP}"
    if not spark.catalog.tableExists(entered):
        return
    rows = spark.table(entered).collect()  # one per partition
    for r in rows:
        if r["new"] is None:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({r['spec']})")
        elif r["old"] is None:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({r['spec']}) LOCATION '{r['new']}'")
        else:
            spark.sql(f"ALTER TABLE {name} PARTITION ({r['spec']}) SET LOCATION '{r['new']}'")
    spark.catalog.refreshTable(name)
    spark.sql(f"DROP TABLE {entered}")
    for r in rows:
        if r["old"] and r["new"]:
            _remove(spark, r["old"])


def recover_all(spark: SparkSession, database: str) -> None:
    """`recover` for every table of a database: for the start of a run."""
    for t in spark.catalog.listTables(database):
        if t.name.endswith(SWAP):
            recover(spark, f"{database}.{t.name.removesuffix(SWAP)}")


def append_unseen(df: DataFrame, name: str, keys: Sequence[str], latest_by: str | None = None, unique: bool = False) -> None:
    """Append the rows whose key the table does not hold yet (NULLs compare equal).

    Running it twice adds nothing. With `unique`, a key that comes several times in
    the batch itself is taken once: the latest by `latest_by`, or the smallest row.
    """
    spark = df.sparkSession
    if unique or latest_by:
        df = one_per_key(df, list(keys), latest_by)
    if spark.catalog.tableExists(name):
        df = not_yet_in(df, spark.table(name), list(keys))
    append(df, name)


def corrected(df: DataFrame, fixes: DataFrame, key: str, column: str) -> DataFrame:
    """`column` replaced by the value `fixes` holds for the row's key, where it holds one."""
    new = fixes.select(key, F.col(column).alias("fixed_value"))
    return (
        df.join(new, key, "left")
        .withColumn(column, F.coalesce("fixed_value", column))
        .select(*df.columns)
    )


def correct_table(spark: SparkSession, name: str, fixes: DataFrame, key: str, column: str) -> None:
    """Apply keyed corrections to a stored table.

    The new rows are written beside the old ones and swapped in, of a partitioned table only
    the partitions that hold a fixed key. A stop at any step leaves the old rows or, after
    `recover`, the new ones.
    """
    recover(spark, name)
    rows = spark.table(name)
    split = partition_columns(spark, name)
    if len(split) != 1:
        replace(corrected(rows, fixes, key, column), name, reads_itself=True)
        return
    touched = rows.join(fixes.select(key), key, "left_semi").select(F.col(split[0]).cast("string").alias("value"))
    values = sorted(r["value"] for r in touched.distinct().collect())
    swap_partitions(corrected(rows, fixes, key, column), name, split[0], values)


def clear_tables(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """Empty the tables that exist and keep their schemas; returns their names."""
    cleared = [n for n in names if spark.catalog.tableExists(n)]
    for name in cleared:
        spark.sql(f"TRUNCATE TABLE {name}")
    return cleared


def preview(df: DataFrame, rows: int = 1000, by: Sequence[str] = ()) -> DataFrame:
    """A few rows to look at, in a stable order when `by` is given."""
    return (df.orderBy(*by) if by else df).limit(rows)
