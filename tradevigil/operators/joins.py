"""Joins that stay exact under NULL keys and stay parallel under hot keys.

Many-to-one joins (a trade to its client) are plain joins: AQE cuts a skewed
partition of the trade side by map output, and the one-row-per-key side is small
per key. Many-to-many joins are different: a key with modest inputs can have a huge
product, which size-based skew handling does not see. `pair_join` therefore cuts
such keys into a grid by their *product*: rows of the left side go to one grid row
and are copied to all grid columns, rows of the right side the other way round, so
each pair meets in exactly one cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradevigil.session import scratch_path

PAIRS_PER_TASK = 8_000_000
# Bounds of what is broadcast and of the copies made. A longer list of hot keys is not
# broadcast but joined as it is, so every hot key is cut.
MAX_HOT_KEYS = 10_000
MAX_CUTS = 4_096
# Tasks of a join in cells, where the session's own number is smaller.
MAX_TASKS = 2_000


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    return all_of([left[k].eqNullSafe(right[k]) for k in keys])


def not_yet_in(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new` whose key is not in `existing`; NULL key parts count as equal."""
    seen = existing.select(*[F.col(k).alias(f"seen_{k}") for k in keys])
    unseen = all_of([F.col(k).eqNullSafe(F.col(f"seen_{k}")) for k in keys])
    return new.join(seen, unseen, "left_anti")


def one_per_key(df: DataFrame, keys: Sequence[str], latest_by: str | None = None) -> DataFrame:
    """One row per key: the latest by a column, or else the smallest row.

    Both are plain aggregates with map-side combine, and repeatable.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    if latest_by is None:
        chosen = F.min(row)
    else:
        chosen = F.max_by(row, F.struct(F.col(latest_by), row))
    picked = df.groupBy(*keys).agg(chosen.alias("picked"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"picked.{c}") for c in df.columns])


def repeats_settled(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`one_per_key` (the smallest row) where few keys repeat: only rows of those are compared.

    The keys that repeat are stored below the shared folder, so that they are known before
    the rows are planned, which then are neither shuffled nor sorted for it.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "repeated_keys")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts.where(F.col("n") > 1).select(*keys).write.parquet(path)
    repeated = spark.read.schema(df.select(*keys).schema).parquet(path)
    if repeated.isEmpty():
        return df
    own = repeated.select(*[F.col(k).alias(f"repeated_{k}") for k in keys])
    again = df.join(own, all_of([F.col(k).eqNullSafe(F.col(f"repeated_{k}")) for k in keys]), "left_semi")
    return not_yet_in(df, repeated, keys).unionByName(one_per_key(again, keys))


def ordered_numbers(df: DataFrame, column: str) -> DataFrame:
    """(column, number): the distinct non-NULL values, numbered in their order.

    Least and greatest values of many rows are then found by number in a hash aggregate;
    of text they would need all rows sorted. Store it: evaluated anew, it may number otherwise.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    placed = values.repartitionByRange(column).sortWithinPartitions(column)
    return placed.withColumn("number", F.monotonically_increasing_id())


def numbered(df: DataFrame, numbers: DataFrame, column: str) -> DataFrame:
    """`df` with the values of `column` replaced by their number; NULL stays."""
    return df.join(numbers, column, "left").withColumn(column, F.col("number")).drop("number")


def named(df: DataFrame, numbers: DataFrame, value: str, columns: Sequence[str]) -> DataFrame:
    """`df` with the numbers in `columns` replaced by the values they stand for."""
    order = df.columns
    for column in columns:
        df = df.join(numbers.select(F.col("number").alias(column), F.col(value).alias("_named")), column, "left")
        df = df.withColumn(column, F.col("_named")).drop("_named")
    return df.select(*order)


def row_numbers(df: DataFrame) -> DataFrame:
    """The distinct rows of `df` with a `number`, and how many `copies` of each there are.

    Rows of many pairs are then grouped by one number instead of by all columns. Store it:
    evaluated anew, it may number otherwise.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.withColumn("number", F.monotonically_increasing_id())


def rows_per_key(df: DataFrame, on: Sequence[str], alias: str) -> DataFrame:
    """How many rows each non-NULL key holds."""
    present = all_of([F.col(k).isNotNull() for k in on])
    return df.where(present).groupBy(*on).agg(F.count(F.lit(1)).alias(alias))


def most_rows(df: DataFrame, on: Sequence[str]) -> int:
    """Rows of the fullest key: one aggregate, one number back."""
    return rows_per_key(df, on, "n").agg(F.max("n")).first()[0] or 0


def hot_grid(
    left_counts: DataFrame, right_counts: DataFrame, on: Sequence[str], pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame | None:
    """Keys with more pairs than one task should make, with grid height and width.

    Counts (or upper bounds of them) come as key columns plus `left_rows` /
    `right_rows`. This runs: at most MAX_HOT_KEYS keys (and one more, to tell) reach the
    driver and go back out as a broadcast; if there are more, the list stays distributed.
    None when no key is hot, which leaves a plain join to plan.
    """
    cells = F.col("left_rows").cast("double") * F.col("right_rows") / F.lit(pairs_per_task)
    balance = F.sqrt(F.col("cells") * F.col("left_rows") / F.col("right_rows"))
    height = F.greatest(F.lit(1.0), F.least(F.ceil(balance), F.ceil(F.col("cells")), F.lit(float(MAX_CUTS))))
    width = F.least(F.ceil(F.col("cells") / F.col("height")), F.lit(float(MAX_CUTS)))
    hot = (
        left_counts.join(right_counts, list(on))
        .withColumn("cells", cells)
        .where(F.col("cells") > 1)
        .withColumn("height", height.cast("int"))
        .withColumn("width", width.cast("int"))
        .select(*on, "height", "width")
    )
    rows = hot.limit(MAX_HOT_KEYS + 1).collect()
    if len(rows) > MAX_HOT_KEYS:
        return hot
    return F.broadcast(hot.sparkSession.createDataFrame(rows, hot.schema)) if rows else None


def counted_grid(
    left: DataFrame, right: DataFrame, on: Sequence[str], pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame | None:
    """`hot_grid` from the inputs themselves; one pass over their key columns."""
    return hot_grid(rows_per_key(left, on, "left_rows"), rows_per_key(right, on, "right_rows"), on, pairs_per_task)


def pair_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_left: Sequence[str],
    spread_right: Sequence[str],
    grid: DataFrame | None,
) -> DataFrame:
    """Inner many-to-many equi-join with the keys in `grid` cut into its cells.

    `spread_left` / `spread_right` name columns that tell the rows of one key apart.
    The number of tasks is fixed then: adaptive planning counts bytes of rows, not their
    products, and would put all cells of small inputs into one task. The rows of a cell are
    merged, whatever their bytes: a hash join of an outer side notes every pair it makes.
    """
    on = list(on)
    if grid is None:
        return left.join(right, on)
    dealt_left, dealt_right = _cells(left, right, on, spread_left, spread_right, grid)
    return dealt_left.join(dealt_right.hint("merge"), _cell(on)).drop(*_CELL)


_CELL = ("grid_row", "grid_col")


def _cell(on: Sequence[str]) -> list[str]:
    return [*on, *_CELL]


def _cells(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_left: Sequence[str],
    spread_right: Sequence[str],
    grid: DataFrame,
    lonely: Column | None = None,
) -> list[DataFrame]:
    """Both sides with their cells, each dealt among a fixed number of tasks by cell.

    There are about as many tasks as cells, up to `MAX_TASKS`: a task's first pairs run
    before its code is compiled, and few long tasks would make most of theirs so. Left rows
    marked `lonely` have no partner in any cell; they are spread among rows of cells.
    """
    cells = grid.agg(F.sum(F.col("height").cast("long") * F.col("width"))).first()[0]
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(cells, MAX_TASKS))

    def cut(df: DataFrame, spread: Sequence[str], own: str, other: str, own_cut: str, other_cut: str, anywhere=None) -> DataFrame:
        # Not rand(): a task that is run again must send each row to the same cell.
        code = F.xxhash64(*spread)
        home = F.coalesce(F.pmod(code, F.col(own)), F.lit(0))
        if anywhere is not None:
            home = F.when(anywhere, F.pmod(code, F.lit(tasks))).otherwise(home)
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        return (
            df.join(grid, list(on), "left")
            .withColumn(own_cut, home.cast("int"))
            .withColumn(other_cut, copies)
            .drop("height", "width")
        )

    cut_left = cut(left, spread_left, "height", "width", *_CELL, anywhere=lonely)
    cut_right = cut(right, spread_right, "width", "height", *reversed(_CELL))
    return [side.repartition(tasks, *_cell(on)) for side in (cut_left, cut_right)]


def pair_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_left: Sequence[str],
    spread_right: Sequence[str],
    grid: DataFrame | None,
) -> DataFrame:
    """Left outer form of `pair_join`.

    A copied left row must not be padded once per grid cell, so rows are padded only where
    their key has no partner at all. All pairs come out of one join, which the fold above it
    reads row by row without a copy.
    """
    on = list(on)
    if grid is None:
        return left.join(right, on, "left")
    partners = right.select(*on).distinct().withColumn("_partner", F.lit(1))
    marked = left.join(partners, on, "left")
    lonely = F.col("_partner").isNull()
    dealt_left, dealt_right = _cells(marked, right, on, spread_left, spread_right, grid, lonely)
    joined = dealt_left.join(dealt_right.withColumn("_met", F.lit(1)).hint("merge"), _cell(on), "left")
    return joined.where(F.col("_met").isNotNull() | lonely).drop(*_CELL, "_partner", "_met")
