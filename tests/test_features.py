import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradevigil.functions import columns as fx
from tradevigil.operators import features

TRADES = "trade_id string, trade_date date, underlying string, notional double, client_id string"
EVENTS = "event_id string, underlying string, event_type string, event_date date, importance string"
DAY = dt.date(2024, 3, 1)


def after(days):
    return DAY + dt.timedelta(days=days)


# ---- network -----------------------------------------------------------------


def brute_force(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
    paths, loops = Counter(), Counter()
    for a, targets in out.items():
        for b in targets:
            for c in out.get(b, []):
                for d in out.get(c, []):
                    paths[a] += 1
                    loops[a] += d == a
    return paths, loops


def hop3_rows(spark, edges, clients):
    rel = spark.createDataFrame([(a, b, "R") for a, b in edges], "from_client string, to_client string, relationship string")
    known = spark.createDataFrame([(c,) for c in clients], "client_id string")
    return {r["client_id"]: tuple(r)[1:] for r in features.client_hop3(known, rel).collect()}


def test_loop_fixture(spark):
    edges = [("A", "B"), ("B", "C"), ("C", "A"), ("C", "A"), ("C", "D"), ("D", "D")]
    got = hop3_rows(spark, edges, "ABCDE")
    paths, loops = brute_force(edges)
    assert got == {c: (paths[c], loops[c], int(loops[c] > 0)) for c in "ABCDE"}
    assert got["A"][1] == 2 and got["D"][1] == 1 and got["E"] == (0, 0, 0)


@pytest.mark.parametrize("seed", range(4))
def test_hop3_equals_walk_listing_on_random_graphs(spark, seed):
    """Hubs, parallel links, self links and mutual pairs."""
    rnd = random.Random(seed)
    names = [f"c{i}" for i in range(14)]
    edges = [(rnd.choice(names), rnd.choice(names)) for _ in range(60)]
    edges += [("hub", n) for n in names] + [(n, "hub") for n in names[:9]] + [("hub", "hub")]
    paths, loops = brute_force(edges)
    clients = [*names, "hub", "alone"]
    assert hop3_rows(spark, edges, clients) == {c: (paths[c], loops[c], int(loops[c] > 0)) for c in clients}


def test_walk_listing_cut_and_uncut(spark, same_rows):
    rel = spark.createDataFrame(
        [(f"c{i % 5}", f"c{(i * i + 1) % 7}", "R") for i in range(40)], "from_client string, to_client string, relationship string"
    )
    same_rows(features.three_hop_walks(rel, pairs_per_task=3), features.three_hop_walks(rel))


def test_hop1_counts(spark):
    rel = spark.createDataFrame(
        [("A", "B", "F"), ("A", "B", "S"), ("A", "C", "F"), ("A", None, "F"), (None, "A", "F")],
        "from_client string, to_client string, relationship string",
    )
    clients = spark.createDataFrame([("A",), ("B",), ("Z",)], "client_id string")
    got = {r["client_id"]: tuple(r)[1:] for r in features.client_hop1(clients, rel).collect()}
    assert got == {"A": (4, 1, 2, 1), "B": (0, 2, 0, 0), "Z": (0, 0, 0, 0)}


# ---- proximity ---------------------------------------------------------------


def near(spark, gaps, kind=("Low", "click"), **options):
    trades = spark.createDataFrame([("t", DAY, "U", 1.0, "c")], TRADES)
    events = spark.createDataFrame(
        [(f"e{i}", "U", kind[1], None if g is None else after(g), kind[0]) for i, g in enumerate(gaps)], EVENTS
    )
    return tuple(features.event_proximity(trades, events, **options).first())[1:]


@pytest.mark.parametrize(
    "gaps, expected",
    [
        ([-1], (9999, 0, 0)),
        ([0], (0, 1, 1)),
        ([3], (3, 1, 1)),
        ([4], (4, 1, 0)),
        ([7], (7, 1, 0)),
        ([8], (8, 0, 0)),
        ([30], (30, 0, 0)),
        ([31], (9999, 0, 0)),
        ([-1, 31, None], (9999, 0, 0)),
        ([30, 7, -3], (7, 1, 0)),
    ],
)
def test_proximity_boundaries(spark, gaps, expected):
    assert near(spark, gaps)[:3] == expected


def test_proximity_kinds_and_undated_events(spark):
    assert near(spark, [20], ("hIgH", "Q3 earnings call"))[3:] == (1, 1)
    assert near(spark, [31], ("High", "Earnings"))[3:] == (0, 0)
    assert near(spark, [None], ("High", "Earnings"))[3:] == (0, 0)
    assert near(spark, [None], ("High", "Earnings"), undated_events=True) == (9999, 0, 0, 1, 1)


def test_proximity_equals_range_join(spark, same_rows):
    """Half of all trades and events on one underlying; a repeated trade id; NULLs."""
    rnd = random.Random(3)

    def underlying():
        return "HOT" if rnd.random() < 0.5 else rnd.choice(["A", "B", "C", None])

    trades = [(f"t{i % 290}", after(rnd.randint(0, 200)) if i % 40 else None, underlying(), 1.0, "c") for i in range(300)]
    events = [
        (f"e{i}", underlying(), rnd.choice(["Earnings x", "click"]), after(rnd.randint(0, 220)), rnd.choice(["HIGH", "low", None]))
        for i in range(80)
    ]
    t, e = spark.createDataFrame(trades, TRADES), spark.createDataFrame(events, EVENTS)
    gap = F.datediff("event_date", "trade_date")
    joined = t.join(e.withColumnRenamed("underlying", "u"), (F.col("underlying") == F.col("u")) & gap.between(0, 30), "left")
    direct = joined.groupBy("trade_id").agg(
        F.coalesce(F.min(gap), F.lit(9999)).alias("days_to_next_event"),
        F.max(fx.flag(gap <= 7)).alias("event_within_7d"),
        F.max(fx.flag(gap <= 3)).alias("event_within_3d"),
        F.max(fx.flag(F.upper("importance") == "HIGH")).alias("has_high_importance_event"),
        F.max(fx.flag(F.col("event_type").like("Earnings%"))).alias("has_earnings_event"),
    )
    same_rows(features.event_proximity(t, e), direct)


# ---- scores and stores -------------------------------------------------------


def test_rating_words(spark):
    words = ["HIGH", "High", "medium", "low", "", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(fx.rating_score("w")).collect()] == [3, 3, 2, 1, 1, 1]


def test_thresholds(spark):
    df = spark.createDataFrame([(2e8,), (200000000.01,), (5e8,), (1e9,), (None,)], "n double")
    got = df.select(fx.above("n", fx.LARGE_TRADE), fx.at_least("n", fx.HALF_BILLION), fx.at_least("n", fx.ONE_BILLION))
    assert [tuple(r) for r in got.collect()] == [(0, 0, 0), (1, 0, 0), (1, 1, 0), (1, 1, 1), (0, 0, 0)]


def test_bad_cells_become_null(spark):
    df = spark.createDataFrame([("n/a", "31-31-2024")], "a string, d string")
    assert tuple(df.select(fx.fixed_point("a", "decimal(20,2)"), fx.as_day("d"), fx.as_double("a")).first()) == (None,) * 3


def test_unknown_client_is_null_in_store_and_zero_in_csv_store(spark, views):
    stranger = views.trades.limit(1).withColumn("client_id", F.lit("nobody")).withColumn("trade_id", F.lit("X1"))
    base = features.feature_trade_base(stranger, views.clients, views.instruments)
    near_event = features.event_proximity(stranger, views.events)
    row = features.feature_store(base, views.hop1, views.hop3, near_event).first()
    assert row["out_degree"] is None and row["hop3_path_count"] is None and row["country"] is None
    row = features.feature_store_csv(stranger, views.clients, views.events, views.instruments, views.relationships).first()
    assert row["out_degree"] == 0 and row["hop3_path_count"] == 0 and row["in_three_hop_loop"] == 0


def test_existing_trades_are_not_built_again(views):
    part = views.base.where("direction = 'BUY'")
    fresh = features.feature_trade_base(views.trades, views.clients, views.instruments, existing=part)
    assert fresh.count() == views.trades.where("direction = 'SELL'").count()
    assert fresh.join(part, "trade_id").count() == 0
