import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradevigil.operators import graph

EDGE = "src string, dst string, relationship string"


def random_edges(seed):
    rnd = random.Random(seed)
    names = [f"c{i}" for i in range(12)]
    edges = {(rnd.choice(names), rnd.choice(names), rnd.choice("FS")) for _ in range(25)}
    edges |= {("hub", n, "F") for n in names[:8]} | {(n, "hub", "S") for n in names[3:]}
    return sorted(edges)


def brute_walks(edges):
    """All walks of 1..3 links as (root, peer, hops, chain)."""
    out = {}
    for a, b, r in edges:
        out.setdefault(a, []).append((b, r))
    found = []

    def go(root, at, hops, chain):
        if hops:
            found.append((root, at, hops, chain))
        if hops < 3:
            for b, r in out.get(at, []):
                go(root, b, hops + 1, f"{chain} -[{r}]-> {b}")

    for a in out:
        go(a, a, 0, a)
    return found


@pytest.mark.parametrize("pairs_per_task", [20, 10**9])
def test_reachability_equals_walk_listing(spark, pairs_per_task):
    edges = random_edges(5)
    df = spark.createDataFrame(edges, EDGE)
    walks = brute_walks(edges)
    fewest = {}
    for root, peer, hops, chain in walks:
        best = fewest.get((root, peer))
        fewest[(root, peer)] = min(best, (hops, chain)) if best else (hops, chain)
    got = graph.reachable(df, pairs_per_task=pairs_per_task).collect()
    assert {(r["root"], r["peer"]): r["hops"] for r in got} == {k: h for k, (h, _) in fewest.items()}
    ways = graph.reachable_walks(df, pairs_per_task=pairs_per_task).collect()
    assert {(r["root"], r["peer"]): r["walks"] for r in ways} == Counter((a, b) for a, b, _, _ in walks)
    if pairs_per_task == 20:
        # parallel links: the first relationship name of a pair is the one shown
        chains = graph.relationship_chain(df, pairs_per_task=pairs_per_task).collect()
        assert {(r["root"], r["peer"]): (r["hops"], r["chain"]) for r in chains} == fewest


def test_targets_only_cut_the_result(spark, same_rows):
    df = spark.createDataFrame(random_edges(6), EDGE)
    targets = spark.createDataFrame([("c1",), ("hub",)], "client_id string")
    same_rows(graph.reachable(df, targets=targets), graph.reachable(df).where(F.col("peer").isin("c1", "hub")))


def test_hop_range(spark):
    df = spark.createDataFrame([("a", "b", "F"), ("b", "c", "F"), ("c", "d", "F"), ("d", "e", "F")], EDGE)
    assert {(r[0], r[1]) for r in graph.reachable(df, 2, 2).collect()} == {("a", "c"), ("b", "d"), ("c", "e")}
    assert ("a", "e") not in {(r[0], r[1]) for r in graph.reachable(df).collect()}


@pytest.fixture(scope="module")
def market(spark):
    edges = spark.createDataFrame(random_edges(7), EDGE)
    rnd = random.Random(7)
    rows = [
        (f"t{i}", rnd.choice(["hub", "hub", *[f"c{k}" for k in range(12)]]), rnd.choice("XYZ"), rnd.randint(0, 4), rnd.randint(1, 9) * 10**8)
        for i in range(60)
    ]
    trades = spark.createDataFrame(rows, "trade_id string, client_id string, underlying string, days_to_next_event int, n long").selectExpr(
        "trade_id", "client_id", "underlying", "days_to_next_event", "CAST(n AS DECIMAL(20,2)) AS notional",
        "CAST(n AS DOUBLE) AS notional1", "DATE '2024-01-01' AS trade_date",
    )
    instruments = spark.createDataFrame([("X",), ("X",), ("Y",)], "underlying string")
    return random_edges(7), rows, edges, trades, instruments


def brute_clusters(walks, rows, per_walk):
    held = {}
    if not per_walk:
        walks = {(a, b) for a, b, _, _ in walks}
    else:
        walks = [(a, b) for a, b, _, _ in walks]
    for root, peer in walks:
        for _, client, underlying, days, n in rows:
            if client == peer and days <= 2 and underlying in "XY":
                cell = held.setdefault((root, underlying), [set(), 0, 99])
                cell[0].add(peer)
                cell[1] += n
                cell[2] = min(cell[2], days)
    return {k: (len(p), float(t), d) for k, (p, t, d) in held.items()}


@pytest.mark.parametrize("multiplicity, pairs_per_task", [("pair", 2), ("path", 2), ("path", 10**9)])
def test_clusters_brute_force(market, multiplicity, pairs_per_task):
    edge_rows, rows, edges, trades, instruments = market
    got = graph.event_clusters(edges, trades, instruments, multiplicity=multiplicity, pairs_per_task=pairs_per_task)
    expected = brute_clusters(brute_walks(edge_rows), rows, multiplicity == "path")
    assert {(r[0], r[1]): tuple(r)[2:] for r in got.collect()} == expected


def test_listing_has_one_row_per_walk_and_trade(market):
    edge_rows, rows, edges, trades, instruments = market
    walks = brute_walks(edge_rows)
    per_pair = Counter(c for _, c, u, _, _ in rows if u in "XY")
    listing = graph.peer_exposure_listing(edges, trades, instruments, multiplicity="path", pairs_per_task=3)
    assert listing.count() == sum(per_pair[peer] for _, peer, _, _ in walks)
    pairs = {(a, b) for a, b, _, _ in walks}
    assert graph.peer_exposure_listing(edges, trades, instruments).count() == sum(per_pair[b] for _, b in pairs)


def test_findings_need_both_conditions(market):
    _, _, edges, trades, instruments = market
    every = graph.event_clusters(edges, trades, instruments)
    found = graph.potential_insider_cluster(edges, trades, instruments)
    assert found.count() == every.where("connected_clients >= 2 AND total_exposure > 500000000").count() > 0
    assert graph.pre_event_cluster(edges, trades, instruments, k=3).count() == 3


def test_edges_need_both_ends(spark):
    rel = spark.createDataFrame(
        [("A", "B", "F"), ("A", "B", "F"), ("A", "X", "F"), (None, "B", "F")], "from_client string, to_client string, relationship string"
    )
    clients = spark.createDataFrame([("A",), ("B",)], "client_id string")
    assert [tuple(r) for r in graph.connected_to(rel, clients).collect()] == [("A", "B", "F")]


def test_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [tuple(r) for r in graph.repeated_keys(df, ["k"]).collect()] == [("a", 2)]


def test_first_chain_by_its_text(spark):
    """A name that another one begins with is not first once the arrow follows; a missing name is '?'."""
    rows = [("A", "B", "FAMILY"), ("A", "B", "FAMILY MEMBER"), ("C", "D", None), ("C", "D", "X")]
    chains = {r["root"]: r["chain"] for r in graph.relationship_chain(spark.createDataFrame(rows, EDGE)).collect()}
    assert chains == {"A": "A -[FAMILY MEMBER]-> B", "C": "C -[?]-> D"}


def test_exposure_beyond_the_rounded_amount(spark):
    """Amounts too large for the rounded column still count."""
    schema = "client_id string, underlying string, notional decimal(20,2), notional1 double, days_to_next_event int, trade_date date"
    rows = spark.createDataFrame([("c", "U", None, 1e20, 1, None), ("c", "U", None, 5.0, 2, None)], schema)
    assert float(graph.client_exposure(rows).first()["exposure"]) == 1e20 + 5
    assert graph.hot_instruments(rows).first()["total_exposure"] == 1e20


def ring(spark):
    """Each of 200 clients is linked to the next two, so no key is hot."""
    links = [(f"c{i}", f"c{(i + k) % 200}", "F") for i in range(200) for k in (1, 2)]
    return spark.createDataFrame(links, EDGE)


def tasks_of(df, key):
    """Of each key, the tasks that made its rows."""
    placed = df.select(F.col(key), F.spark_partition_id().alias("task")).distinct().collect()
    return [sorted(r["task"] for r in placed if r[key] == k) for k in {r[key] for r in placed}]


def test_walks_without_hot_keys_are_dealt_by_their_number(spark, same_rows):
    edges = ring(spark)
    by_peer = graph.reachable(edges, pairs_per_task=1000, by_peer=True)
    same_rows(by_peer, graph.reachable(edges))
    found = tasks_of(by_peer, "peer")
    assert all(len(tasks) == 1 for tasks in found) and len({t[0] for t in found}) == 4
    trades = spark.range(400).selectExpr(
        "concat('t', id) AS trade_id", "concat('c', id % 200) AS client_id", "concat('U', id % 3) AS underlying", "1 AS days_to_next_event",
        "CAST(id AS DECIMAL(20,2)) AS notional", "CAST(id AS DOUBLE) AS notional1", "DATE '2024-01-01' AS trade_date",
    )
    named = trades.select("underlying").distinct()
    clusters = graph.event_clusters(edges, trades, named, pairs_per_task=5000)
    found = tasks_of(clusters, "root_client")
    assert all(len(tasks) == 1 for tasks in found) and len({t[0] for t in found}) > 1
    same_rows(clusters, graph.event_clusters(edges, trades, named))
    same_rows(clusters, graph.event_clusters(edges, trades, named, pairs_per_task=1))


def test_only_pairs_with_several_walks_meet_each_holding(spark, same_rows, monkeypatch):
    """Measures are summed link by link; a peer reached in several ways, or in a loop, still counts once."""
    edges = random_edges(11) + [("x", "c1", "F"), ("x", "c1", "S"), ("y", "x", "F"), ("c1", "z", "F"), ("z", "z", "S")]
    links = spark.createDataFrame(edges, EDGE)
    rows = [
        (c, u, amount, days, day)
        for i, c in enumerate(sorted({a for a, _, _ in edges} | {b for _, b, _ in edges}))
        for u, amount, days, day in (("U1", 1e8 * i, i % 3, f"2024-01-{i + 1:02d}"), ("U2", None if i % 2 else -5.25, 1, None))
        if (i + len(u)) % 5
    ]
    trades = spark.createDataFrame(rows, "client_id string, underlying string, notional1 double, days_to_next_event int, day string")
    trades = trades.withColumn("trade_date", F.to_date("day"))
    named = spark.createDataFrame([("U1",), ("U2",)], "underlying string")
    for found in (graph.event_clusters, graph.coordinated_instrument_trading):
        same_rows(found(links, trades, named), found(links, trades, named, pairs_per_task=1))

    met = []
    monkeypatch.setattr(graph, "_join_peers", lambda pairs, *rest, own=graph._join_peers: met.append(pairs) or own(pairs, *rest))
    lone = spark.createDataFrame([("a", "b", "F"), ("b", "c", "F"), ("c", "d", "F"), ("a", "c", "F")], EDGE)
    deals = trades.limit(1).select(F.explode(F.array(*map(F.lit, "abcd"))).alias("client_id"), *[c for c in trades.columns if c != "client_id"])
    graph.event_clusters(lone, deals, named)
    assert {(r["root"], r["peer"]) for r in met[0].collect()} == {("a", "c"), ("a", "d")}
