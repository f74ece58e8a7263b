"""The plans: no products of whole tables, no Python in the tasks, pruned and pushed-down scans."""

import pytest
from pyspark.sql import functions as F

from tradevigil.operators import features, graph, investigation, report
from tradevigil.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


MODEL_AND_INGEST = {
    "rf_scores", "rf_scores_csv", "rf_run_record", "ingest_feeds", "ingest_incremental", "ingest_stream", "ingest_stream_features", "clear_tables",
}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - MODEL_AND_INGEST))
def test_no_product_and_no_python(views, name):
    text = plan(registry.QUERIES[name](views))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text


def test_client_measures_never_sort_all_trades_of_a_client(views):
    """The only window is the capped ranking, and it is cut before the shuffle."""
    text = plan(investigation.iq_trades(views.store))
    assert text.count("Window [") == 1
    assert text.count("WindowGroupLimit") == 2


def test_proximity_has_no_range_join(views):
    text = plan(features.event_proximity(views.trades, views.events))
    assert "datediff" not in text and "date_diff" not in text


def test_scans_are_pruned_and_filters_pushed(views):
    text = plan(graph.hot_instruments(views.iq_trades))
    assert "PushedFilters: [IsNotNull(days_to_next_event), LessThanOrEqual(days_to_next_event,2)]" in text
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "underlying" in schema and "notional" in schema and "kyc_risk_score" not in schema
    assert "StringStartsWith(trade_id,SWP)" in plan(views.iq_trades.where(F.col("trade_id").startswith("SWP")))
    text = plan(report.measure_by(views.iq_trades, [], [report.avg_risk()]))
    assert text.split("ReadSchema: ")[1].split("\n")[0].startswith("struct<anomaly_score:int>")


def test_hub_is_cut_into_cells(spark):
    """A client with a third of all links: no task is left with most of the pairs."""
    links = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit("hub")).otherwise(F.concat(F.lit("c"), F.col("id"))).alias("src"),
        F.when(F.col("id") % 3 == 1, F.lit("hub")).otherwise(F.concat(F.lit("d"), F.col("id"))).alias("dst"),
        F.lit("F").alias("relationship"),
    )
    text = plan(graph.reachable(links, max_hops=2, pairs_per_task=5_000))
    assert "grid_row" in text and "grid_col" in text
    assert "grid_row" not in plan(graph.reachable(links, max_hops=2))
    assert graph.reachable(links, max_hops=2, pairs_per_task=5_000).count() == graph.reachable(links, max_hops=2).count()


def test_tasks_hold_few_rows_and_joins_sort_none(spark):
    """A narrow aggregate's task gets a bounded number of bytes; a join with small partitions sorts no side."""
    sides = [spark.range(1_000_000, numPartitions=4).select(F.col("id").alias("k"), F.xxhash64("id", F.lit(i)).alias(f"v{i}")) for i in (0, 1)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = sides[0].join(sides[1], "k")
        assert joined.agg(F.count("v0")).first()[0] == 1_000_000
        done = joined.agg(F.count("v0"))
        done.collect()
        text = plan(done).split("== Initial Plan ==")[0]
        assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
