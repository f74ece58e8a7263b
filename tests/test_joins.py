import pytest
from pyspark.sql import functions as F

from tradevigil.operators import joins
from tradevigil.operators.joins import (
    counted_grid,
    not_yet_in,
    one_per_key,
    pair_join,
    pair_left_join,
    repeats_settled,
    rows_per_key,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key on both sides, NULL keys, and keys on one side only."""
    left = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))
        ).alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 30 + 20).cast("string"))
        ).alias("k"),
        F.col("id").alias("r"),
    )
    return left, right


@pytest.mark.parametrize("pairs_per_task", [1, 7, 500, 10**9])
def test_grid_join_equals_plain_join(skewed, same_rows, pairs_per_task):
    left, right = skewed
    grid = counted_grid(left, right, ["k"], pairs_per_task)
    assert (grid is None) == (pairs_per_task == 10**9)
    same_rows(pair_join(left, right, ["k"], ["l"], ["r"], grid), left.join(right, "k"))
    same_rows(pair_left_join(left, right, ["k"], ["l"], ["r"], grid), left.join(right, "k", "left"))


def test_grid_cells_hold_a_bounded_share(skewed):
    left, right = skewed
    grid = {r["k"]: (r["height"], r["width"]) for r in counted_grid(left, right, ["k"], 1000).collect()}
    assert set(grid) == {"hot"}
    height, width = grid["hot"]
    assert 200 * 100 / (height * width) <= 1000


def test_every_hot_key_is_cut(skewed, same_rows, monkeypatch):
    left, right = skewed
    few = {tuple(r) for r in counted_grid(left, right, ["k"], 7).collect()}
    monkeypatch.setattr(joins, "MAX_HOT_KEYS", 1)
    grid = counted_grid(left, right, ["k"], 7)
    assert {tuple(r) for r in grid.collect()} == few and len(few) > 2
    same_rows(pair_join(left, right, ["k"], ["l"], ["r"], grid), left.join(right, "k"))
    same_rows(pair_left_join(left, right, ["k"], ["l"], ["r"], grid), left.join(right, "k", "left"))


def test_rows_per_key_skips_null_keys(skewed):
    assert rows_per_key(skewed[0], ["k"], "n").where("k IS NULL").count() == 0


def test_not_yet_in_is_null_safe(spark):
    new = spark.createDataFrame([(None, "e1"), ("t1", "e1"), ("t2", None)], "trade_id string, event_id string")
    old = spark.createDataFrame([(None, "e1"), ("t2", None)], "trade_id string, event_id string")
    left = not_yet_in(new, old, ["trade_id", "event_id"])
    assert [tuple(r) for r in left.collect()] == [("t1", "e1")]


def test_one_per_key_latest_and_smallest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z"), (None, 1, "n")], "k string, ts int, v string")
    assert sorted(tuple(r) for r in one_per_key(df.where("k IS NOT NULL"), ["k"], "ts").collect()) == [("a", 2, "y"), ("b", 5, "z")]
    assert sorted(tuple(r) for r in one_per_key(df.where("k IS NOT NULL"), ["k"]).collect()) == [("a", 1, "x"), ("b", 5, "z")]


def test_repeats_settled_equals_one_per_key_and_leaves_single_rows_unsorted(spark, same_rows):
    rows = [("a", 2, "y"), ("a", 1, "x"), ("b", 5, None), (None, 3, "n"), (None, 2, None), ("c", None, "z"), ("c", None, "z")]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    same_rows(repeats_settled(df, ["k"]), one_per_key(df, ["k"]))
    single = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    same_rows(repeats_settled(single, ["k"]), single)
    assert "Exchange" not in repeats_settled(single, ["k"])._jdf.queryExecution().executedPlan().toString()
