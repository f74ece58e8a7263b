"""Intermediate tables in the shared folder: they cut lineage and outlive executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradevigil.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """`stored`, and the folder, for tables that go before the job is over."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that `df` does not have itself, in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, by: int) -> Column:
    """crc32 of the value as text, modulo `by`; NULL counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text) % F.lit(by)
