"""Dimension rows that are sent again: the latest one, or the one known on a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tradevigil.operators.joins import all_of, one_per_key


def latest(sends: DataFrame, key: Sequence[str], sent: str) -> DataFrame:
    """One row per key: the one sent last, without the time; ties by the row itself."""
    return one_per_key(sends, list(key), sent).drop(sent)


def versioned(sends: DataFrame, key: Sequence[str], sent: str) -> DataFrame:
    """One row per key with `versions`: its rows in the order they were sent, each with when.

    A list is as long as its key was sent often, whatever the number of facts. Rows without a
    key cannot be looked up and go; a row without a time counts as sent before all others.
    """
    rest = [c for c in sends.columns if c not in (*key, sent)]
    entry = F.struct(F.col(sent).alias("since"), *rest)
    present = all_of([F.col(k).isNotNull() for k in key])
    return sends.where(present).groupBy(*key).agg(F.sort_array(F.collect_set(entry)).alias("versions"))


def as_of(facts: DataFrame, sends: DataFrame, key: Sequence[str], day: str, sent: str) -> DataFrame:
    """Facts with the attributes their key had on the fact's day; NULL for unknown keys.

    A fact older than the key's first row, or without a day, takes the first row. The join
    is many-to-one: a hot key is not multiplied by its versions.
    """
    versions = versioned(sends, key, sent)
    attributes = [c for c in sends.columns if c not in (*key, sent)]
    joined = facts.join(versions, list(key), "left")
    known = F.filter("versions", lambda v: v["since"].isNull() | (v["since"] <= F.col(day)))
    chosen = F.coalesce(F.try_element_at(known, F.lit(-1)), F.try_element_at("versions", F.lit(1)))
    return joined.withColumn("chosen_version", chosen).select(
        *[F.col(c) for c in facts.columns], *[F.col(f"chosen_version.{c}").alias(c) for c in attributes]
    )
