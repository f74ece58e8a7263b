"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The feeds and the tables between the stages are written first (timed as `stage_*`), as
the solution itself does; each query then reads stored tables, runs once to warm up and
then BENCH_RUNS times, of which the median counts. With BENCH_DIRECT=1 rewritten operators
are timed next to their direct form, and both must give the same rows.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradevigil.operators import features, graph, investigation, report
from tradevigil.plans.views import SurveillanceViews

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
DIRECT = os.environ.get("BENCH_DIRECT", "0") == "1"


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tradevigil-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def fingerprint(df: DataFrame) -> tuple:
    row = df.select(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)").alias("h"))
    return tuple(row.agg(F.count(F.lit(1)), F.sum("h")).first())


# ---- direct forms, for comparison --------------------------------------------


def hop3_by_walks(v: SurveillanceViews) -> DataFrame:
    r = v.relationships
    a = r.select(F.col("from_client").alias("client_id"), F.col("to_client").alias("p"))
    b = r.select(F.col("from_client").alias("p"), F.col("to_client").alias("q"))
    c = r.select(F.col("from_client").alias("q"), F.col("to_client").alias("z"))
    loop = F.when(F.col("z") == F.col("client_id"), 1).otherwise(0)
    counts = (
        a.join(b, "p")
        .join(c, "q")
        .groupBy("client_id")
        .agg(
            F.count(F.lit(1)).alias("hop3_path_count"),
            F.sum(loop).alias("three_hop_loop_count"),
            F.max(loop).alias("in_three_hop_loop"),
        )
    )
    return v.clients.select("client_id").join(counts, "client_id", "left").fillna(0)


def proximity_by_range(v: SurveillanceViews) -> DataFrame:
    gap = F.datediff("event_date", "trade_date")
    t = v.trades.select("trade_id", "underlying", "trade_date")
    e = v.events.select(F.col("underlying").alias("u"), "event_date", "importance", "event_type")
    flag = lambda c: F.max(F.when(c, 1).otherwise(0))
    return (
        t.join(e, (F.col("underlying") == F.col("u")) & gap.between(0, 30), "left")
        .groupBy("trade_id")
        .agg(
            F.coalesce(F.min(gap), F.lit(9999)).alias("days_to_next_event"),
            flag(gap.between(0, 7)).alias("event_within_7d"),
            flag(gap.between(0, 3)).alias("event_within_3d"),
            flag(F.upper("importance") == "HIGH").alias("has_high_importance_event"),
            flag(F.upper("event_type").contains("EARNING")).alias("has_earnings_event"),
        )
    )


def windows_direct(v: SurveillanceViews) -> DataFrame:
    client = Window.partitionBy("client_id")
    amount = F.col("notional").cast("float")
    return v.store.select(
        "trade_id",
        (amount / F.avg(amount).over(client)).alias("notional_vs_avg"),
        F.when(F.count("*").over(Window.partitionBy("client_id", "underlying")) == 1, 1).otherwise(0).alias("new_exposure_flag"),
        F.count("*").over(client.orderBy("trade_date", "trade_id").rowsBetween(-7, 0)).alias("rolling_frequency"),
    )


def clusters_direct(v: SurveillanceViews) -> DataFrame:
    e = v.connections.select("src", "dst")
    one = e.select(F.col("src").alias("root"), F.col("dst").alias("peer"))
    two = one.join(e, F.col("peer") == F.col("src")).select("root", F.col("dst").alias("peer"))
    three = two.join(e, F.col("peer") == F.col("src")).select("root", F.col("dst").alias("peer"))
    pairs = one.union(two).union(three).distinct()
    near = v.iq_trades.where("days_to_next_event <= 2").join(v.iq_instruments.select("underlying").distinct(), "underlying")
    return (
        pairs.join(near, F.col("peer") == F.col("client_id"))
        .groupBy(F.col("root").alias("root_client"), "underlying")
        .agg(
            F.countDistinct("peer").alias("connected_clients"),
            F.sum("notional").cast("double").alias("total_exposure"),
            F.min("days_to_next_event").alias("min_days_to_event"),
        )
    )


WINDOW_COLUMNS = ("trade_id", "notional_vs_avg", "new_exposure_flag", "rolling_frequency")

# rewritten form, direct form
PAIRS = {
    "client_hop3": (lambda v: v.hop3_plan(), hop3_by_walks),
    "event_proximity": (lambda v: v.proximity_plan(), proximity_by_range),
    "client_windows": (lambda v: v.iq_trades_plan().select(*WINDOW_COLUMNS), windows_direct),
    "event_clusters": (lambda v: graph.event_clusters(v.connections, v.iq_trades, v.iq_instruments), clusters_direct),
}
SINGLE = {
    "feature_trade_base": lambda v: v.base_plan(),
    "client_hop1": lambda v: v.hop1_plan(),
    "feature_store": lambda v: v.store_plan(),
    "iq_trades": lambda v: v.iq_trades_plan(),
    "iq_clients": lambda v: investigation.iq_clients(v.clients, v.relationships, v.iq_trades),
    "reachable_1_3": lambda v: graph.reachable(v.connections),
    "pre_event_cluster": lambda v: graph.pre_event_cluster(v.connections, v.iq_trades, v.iq_instruments),
    "coordinated_trading": lambda v: graph.coordinated_instrument_trading(v.connections, v.iq_trades, v.iq_instruments),
    "explain_flags": lambda v: graph.explain_flags(v.store),
    "trade_risk_table": lambda v: report.trade_risk_table(v.iq_trades),
    "network_edges": lambda v: report.network_edges(v.clients, v.relationships, v.iq_trades),
    "iq_trades_increment": lambda v: investigation.iq_trades(v.store, v.iq_trades.where("direction = 'BUY'")),
    "feature_store_csv": lambda v: features.feature_store_csv(
        v.trades, v.clients, v.events, v.instruments, v.relationships
    ),
}


def once(make, v: SurveillanceViews) -> float:
    start = time.perf_counter()
    drain(make(v))
    return time.perf_counter() - start


def median_time(make, v: SurveillanceViews) -> float:
    once(make, v)
    return round(statistics.median(once(make, v) for _ in range(RUNS)), 3)


def main() -> None:
    spark = session()
    v = SurveillanceViews(spark, SF_DIR)
    staged = {}
    for name in ("trades", "clients", "events", "instruments", "relationships", "base", "hop1", "hop3",
                 "proximity", "store", "iq_trades", "connections"):
        start = time.perf_counter()
        getattr(v, name)
        staged[f"stage_{name}"] = round(time.perf_counter() - start, 3)

    queries, direct = {}, {}
    for name, (rewritten, plain) in PAIRS.items():
        queries[name] = median_time(rewritten, v)
        if DIRECT:
            # the comparison of rows is the warm-up; slow direct forms are timed once
            start = time.perf_counter()
            expected = fingerprint(plain(v))
            first = time.perf_counter() - start
            if fingerprint(rewritten(v)) != expected:
                raise SystemExit(f"{name}: rewritten and direct form differ")
            direct[name] = round(first, 3) if first > 10 else median_time(plain, v)
    for name, make in SINGLE.items():
        queries[name] = median_time(make, v)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "direct_form": direct,
                "staging": staged,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
