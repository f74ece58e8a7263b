import datetime as dt
import re

import pytest
from pyspark.sql import Window, functions as F

from tradevigil.operators import features, investigation, report
from tradevigil.operators.features import PROXIMITY_COLUMNS
from tradevigil.operators.investigation import iq_trades
from tradevigil.operators.joins import counted_grid, named, not_yet_in, numbered, ordered_numbers, pair_join, pair_left_join, row_numbers
from tradevigil.plans import registry


def with_hot_client(store):
    """A third of the trades on one client, some without a client, ties on the day."""
    pick = F.pmod(F.xxhash64("trade_id"), F.lit(9))
    return store.withColumn(
        "client_id", F.when(pick < 3, F.lit("HOT")).when(pick == 4, F.lit(None)).otherwise(F.col("client_id"))
    ).withColumn("trade_date", F.date_trunc("quarter", "trade_date").cast("date"))


def windows(store):
    client = Window.partitionBy("client_id")
    amount = F.col("notional").cast("float")
    return store.select(
        "trade_id",
        (amount / F.avg(amount).over(client)).alias("notional_vs_avg"),
        F.when(F.count("*").over(Window.partitionBy("client_id", "underlying")) == 1, 1).otherwise(0).alias("new_exposure_flag"),
        F.count("*").over(client.orderBy("trade_date", "trade_id").rowsBetween(-7, 0)).alias("rolling_frequency"),
    )


COLUMNS = ("trade_id", "notional_vs_avg", "new_exposure_flag", "rolling_frequency")


def test_client_measures_equal_windows_under_skew(views, same_rows):
    store = with_hot_client(views.store)
    same_rows(iq_trades(store).select(*COLUMNS), windows(store))


def test_scopes_of_an_increment(views, same_rows):
    store = with_hot_client(views.store)
    done = store.where("direction = 'BUY'")
    history = iq_trades(store, existing=done, scope="history").select(*COLUMNS)
    same_rows(history, windows(store).join(store.where("direction = 'SELL'").select("trade_id"), "trade_id", "left_semi"))
    batch = iq_trades(store, existing=done, scope="batch").select(*COLUMNS)
    same_rows(batch, windows(store.where("direction = 'SELL'")))


def test_ten_trades_on_one_day(spark, views):
    ten = views.store.limit(10).withColumn("client_id", F.lit("one")).withColumn("trade_date", F.lit(dt.date(2024, 1, 1)))
    got = iq_trades(ten).orderBy("trade_id").select("rolling_frequency")
    assert [r[0] for r in got.collect()] == [1, 2, 3, 4, 5, 6, 7, 8, 8, 8]


def test_zero_average_gives_null(views):
    free = views.store.limit(3).withColumn("notional", F.lit(0).cast("decimal(20,2)"))
    assert iq_trades(free).where("notional_vs_avg IS NOT NULL").count() == 0


def test_trade_event_pairs_cut_and_uncut(views, same_rows):
    hot = F.when(F.pmod(F.xxhash64("trade_id"), F.lit(3)) == 0, F.lit("Brand#1")).otherwise(F.col("underlying"))
    base = views.base.withColumn("underlying", hot)
    plain = views.events.join(base.select("underlying", "trade_id"), "underlying", "left").join(
        views.proximity, "trade_id", "left"
    )
    cut = investigation.iq_events(views.events, base, views.proximity, pairs_per_task=50)
    same_rows(cut, plain.select(*cut.columns))
    same_rows(investigation.iq_events(views.events, base, views.proximity), plain.select(*cut.columns))


def test_event_without_trade_is_kept_once_and_not_added_again(spark, views):
    lonely = views.events.limit(1).withColumn("underlying", F.lit("NOBODY"))
    events = views.events.where("event_type = 'view'").unionByName(lonely.withColumn("event_id", F.lit("X")))
    rows = investigation.iq_events(events, views.base, views.proximity, pairs_per_task=100)
    assert rows.where("event_id = 'X'").count() == 1
    assert rows.where("event_id = 'X' AND trade_id IS NULL").count() == 1
    assert investigation.iq_events(events, views.base, views.proximity, existing=rows).count() == 0


def test_client_network_rows_brute_force(spark, views, same_rows):
    rel = views.relationships.unionByName(views.relationships.limit(20))
    got = investigation.client_network(rel, views.iq_trades, views.iq_events, pairs_per_task=20)
    t = views.iq_trades.select(
        "client_id", "trade_id", "underlying", "trade_date", "notional", "kyc_risk_score", "days_to_next_event"
    )
    e = views.iq_events.select("underlying", "event_date", "event_type")
    direct = (
        rel.join(t, F.col("to_client") == F.col("client_id"))
        .join(e.distinct(), "underlying", "left")
        .select(F.col("from_client").alias("root_client"), F.col("to_client").alias("connected_client"), *got.columns[2:])
        .distinct()
    )
    assert got.count() == direct.count()
    assert got.exceptAll(direct).count() == 0


def test_clients_as_a_set_cut_and_run_twice(spark, same_rows):
    clients = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), ("D",)], "client_id string")
    rel = spark.createDataFrame(
        [("A", "B", "F"), ("A", "B", "F"), ("A", "C", "F"), ("B", "D", "S"), ("C", "A", None)],
        "from_client string, to_client string, relationship string",
    )
    trades = spark.createDataFrame([("A", "t1"), ("A", "t2"), ("B", "t3"), (None, "t4")], "client_id string, trade_id string")
    rows = investigation.iq_clients(clients, rel, trades)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(
        [
            ("A", "B", "F", "t1"),
            ("A", "B", "F", "t2"),
            ("B", None, None, "t3"),
            ("C", "A", None, None),
            ("D", None, None, None),
        ],
        key=repr,
    )
    same_rows(investigation.iq_clients(clients, rel, trades, pairs_per_task=1), rows)
    assert investigation.iq_clients(clients, rel, trades, existing=rows).count() == 0
    weights = report.network_edges(clients, rel, trades)
    direct = rows.where("connected_client IS NOT NULL").groupBy("client_id", "connected_client").agg(F.count("*").alias("weight"))
    same_rows(weights, direct)


def test_alerts_are_strict_and_not_repeated(spark):
    scores = spark.createDataFrame(
        [("t1", 0.8), ("t2", 0.81), ("t3", None), ("t4", 0.95)], "trade_id string, predicted_probability double"
    ).selectExpr("trade_id", "'c' AS client_id", "'u' AS underlying", "'f' AS risk_flag", "predicted_probability")
    alerts = investigation.agent_alerts(scores)
    assert sorted(r["trade_id"] for r in alerts.collect()) == ["t2", "t4"]
    assert [r["trade_id"] for r in investigation.agent_alerts(scores, alerts.where("trade_id = 't2'")).collect()] == ["t4"]


def test_risk_table_highlight(spark):
    df = spark.createDataFrame([("t1", "c", 1), ("t2", "c", 3), ("t3", "c", 5)], "trade_id string, client_id string, anomaly_score int")
    got = {r["trade_id"]: r["highlight"] for r in report.trade_risk_table(df, low=0.5).collect()}
    assert got == {"t1": 0, "t2": 1, "t3": 1}


def test_running_count_of_repeated_and_missing_ids(spark, views):
    """Rows that share an id, or have none, are counted one by one, as rows of a window are."""
    one = views.store.limit(1).withColumn("client_id", F.lit("c")).withColumn("trade_date", F.lit("2024-01-01").cast("date"))

    def counts(given):
        keys = spark.createDataFrame([(i,) for i in given], "new_id string")
        rows = one.crossJoin(keys).withColumn("trade_id", F.col("new_id")).drop("new_id")
        found = investigation.iq_trades(rows).select("trade_id", "rolling_frequency").collect()
        return sorted((r[0] or "", r[1]) for r in found)

    assert counts(["a", "a", "a", "b", "c", "d"]) == [("a", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5), ("d", 6)]
    assert counts([None, "b"]) == [("", 1), ("b", 2)]
    assert [n for _, n in counts(["a"] * 5 + ["b"] * 5 + ["c"])] == [1, 2, 3, 4, 5, 6, 7, 8, 8, 8, 8]


def test_numbers_keep_the_order_of_values(spark):
    rows = spark.createDataFrame([("t10", 1), ("t2", 2), (None, 3), ("t1", 4), ("t2", 5)], "trade_id string, x int")
    numbers = spark.createDataFrame(ordered_numbers(rows, "trade_id").collect(), "trade_id string, number long")
    assert [r["trade_id"] for r in numbers.orderBy("number").collect()] == ["t1", "t10", "t2"]
    back = named(numbered(rows, numbers, "trade_id"), numbers, "trade_id", ["trade_id"])
    assert sorted(map(tuple, back.select("trade_id", "x").collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)


@pytest.mark.parametrize("name", ["iq_events_by_event", "iq_events_grown", "iq_events_incremental", "entity_event_by_event", "client_network_by_link"])
def test_pair_rows_are_folded_without_sorting_them(views, name):
    """First and last of a text would need every pair sorted, on disk: folds are hash aggregates."""
    assert "SortAggregate" not in registry.QUERIES[name](views)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, keys",
    [
        ("iq_events_by_event", r"event_id#\d+L"),
        ("iq_events_grown", r"event_id#\d+L"),
        ("iq_events_incremental", r"event_id#\d+L"),
        ("entity_event_by_event", r"event_id#\d+L"),
        ("client_network_by_link", r"root_client#\d+L, trade_id#\d+L"),
    ],
)
def test_pair_rows_are_folded_by_numbers(views, name, keys):
    """Every pair row is looked up by its key: by numbers, not by texts."""
    text = registry.QUERIES[name](views)._jdf.queryExecution().executedPlan().toString()
    pairs = [line for line in text.splitlines() if "HashAggregate" in line and re.search("partial_sum|partial_count", line)]
    assert any(re.search(rf"keys=\[{keys}\]", line) for line in pairs)
    assert not any(re.search("event_type|relationship", line.split("functions=")[0]) for line in pairs)


def test_row_numbers_tell_equal_rows_apart_from_others(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), (None, None), ("b", 1)], "k string, n int")
    got = {(r["k"], r["n"]): r for r in row_numbers(rows).collect()}
    assert {k: r["copies"] for k, r in got.items()} == {("a", None): 2, (None, None): 1, ("b", 1): 1}
    assert len({r["number"] for r in got.values()}) == 3


def test_padded_pairs_come_out_of_one_merged_join(spark, same_rows):
    """Padded rows are not added by a union, above which every pair row would be copied; lonely keys are padded once."""
    left = spark.range(4000).selectExpr("IF(id % 5 = 4, NULL, id % 5) AS k", "id AS a")
    right = spark.range(3000).selectExpr("id % 3 AS k", "id AS b")
    grid = counted_grid(left, right, ["k"], 100_000)
    joined = pair_left_join(left, right, ["k"], ["a"], ["b"], grid)
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in text and "SortMergeJoin" in text
    plain = left.join(right, "k", "left")
    for rows in (joined.where("b IS NULL"), joined.where("a < 50")):
        assert rows.count() > 0
    same_rows(joined.where("b IS NULL OR a < 50"), plain.where("b IS NULL OR a < 50"))
    assert joined.count() == plain.count()


def test_increment_can_be_folded_where_it_is_made(views, same_rows):
    new, sold = F.col("event_type") == "Earnings Release", F.col("direction") == "SELL"
    given = (views.events.where(new), views.events.where(~new), views.base.where(sold), views.base.where(~sold), views.proximity)

    def fold(rows):
        return rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))

    halves = investigation.iq_events_delta(*given, fold=fold).groupBy("event_id").agg(F.sum("n").alias("n"))
    same_rows(halves, fold(investigation.iq_events_delta(*given)))


def test_stored_pairs_are_compared_only_where_some_are_missing(spark):
    base = spark.createDataFrame([("t1", "A"), ("t2", "A"), ("t2", "A"), (None, "A"), ("t3", "B")], "trade_id string, underlying string")
    proximity = base.select("trade_id").distinct().where("trade_id IS NOT NULL").selectExpr("trade_id", *[f"1 AS {c}" for c in PROXIMITY_COLUMNS])
    rows = [("e1", "A"), ("e2", "A"), ("e2", "B"), ("e3", "C"), ("e4", "B"), (None, "A"), ("e5", None), ("e5", None)]
    events = spark.createDataFrame(rows, "event_id string, underlying string").selectExpr("*", "'x' AS event_type", "DATE '2024-01-01' AS event_date")
    every = investigation.iq_events(events, base, proximity)
    for kept in ("true", "event_id = 'e2'", "event_id IN ('e1', 'e3') OR trade_id = 't3'", "event_id IS NULL OR trade_id IS NULL", "trade_id = 't2'", "false"):
        stored = every.where(kept)
        got = investigation.iq_events(events, base, proximity, existing=stored)
        plain = not_yet_in(every, stored, ["trade_id", "event_id"])
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_cells_are_not_gathered_into_one_task(spark):
    left, right = (spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias(c)) for c in ("a", "b"))
    grid = counted_grid(left, right, ["k"], 100_000)
    text = pair_join(left, right, ["k"], ["a"], ["b"], grid)._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_NUM") == 2


def test_first_trades_are_listed_once_per_client(views):
    """Not again for each of a client's underlyings: seven trades at most come back over all its rows."""
    stats = investigation.client_trade_stats(investigation.with_place(views.store))
    listed = stats.groupBy("client_id").agg(F.sum(F.size(F.coalesce("first_trades", F.array()))).alias("n"), F.count("*").alias("pairs"))
    assert listed.where("pairs > 1").count() > 0
    assert listed.where("n > 7").count() == 0


def test_wide_trades_are_shuffled_once(spark, views):
    """Only one shuffle of the store's join carries a column that the measures do not need."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.store_plan()._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide, nodes = 0, [plan]
    while nodes:
        node = nodes.pop()
        node = node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else node
        if node.nodeName() == "Exchange" and "desk#" in node.output().toString():
            wide += 1
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert wide == 1


def test_store_of_repeated_and_missing_keys(spark, views, same_rows):
    base = views.base.limit(6).withColumn("n", F.row_number().over(Window.orderBy("trade_id")))
    base = base.withColumn("trade_id", F.when(F.col("n") > 4, F.lit(None)).otherwise(F.lit("t"))).withColumn(
        "client_id", F.when(F.col("n") % 2 == 0, F.lit("c")).when(F.col("n") == 3, F.lit("d"))
    ).localCheckpoint()
    hop1 = spark.createDataFrame([("c", 1), ("c", 2), (None, 3)], "client_id string, x int").selectExpr("client_id", *[f"x AS {c}" for c in features.HOP1_COLUMNS])
    hop3 = spark.createDataFrame([("c", 1), ("e", 2)], "client_id string, x int").selectExpr("client_id", *[f"x AS {c}" for c in features.HOP3_COLUMNS])
    near = spark.createDataFrame([("t", 1), (None, 2)], "trade_id string, x int").selectExpr("trade_id", *[f"x AS {c}" for c in PROXIMITY_COLUMNS])
    got = features.feature_store(base, hop1, hop3, near)
    plain = base.join(hop1.join(hop3, "client_id", "full"), "client_id", "left").join(near, "trade_id", "left")
    shown = ["n", "trade_id", "client_id", "desk", *features.HOP1_COLUMNS, *features.HOP3_COLUMNS, *PROXIMITY_COLUMNS]
    same_rows(got.select(*shown), plain.select(*shown))
