"""Property-graph tables and the bounded-network detections on them."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from tradevigil.functions import columns as fx
from tradevigil.operators.joins import PAIRS_PER_TASK, hot_grid, most_rows, one_per_key, pair_join, rows_per_key

MAX_HOPS = 3
CLUSTER_PEERS = 2
TOP_CLUSTERS = 100
#: Tasks among which the pairs of one full task are dealt where keys are cut into no cells.
TASKS_PER_FULL_TASK = 8

# Node properties and the columns behind them (fixed values).
TRADE_PROPERTIES = {
    "id": "trade_id",
    "anomalyScore": "anomaly_score",
    "clientId": "client_id",
    "daysToNextEvent": "days_to_next_event",
    "direction": "direction",
    "eventWithin3d": "event_within_3d",
    "eventWithin7d": "event_within_7d",
    "isInsider": "is_insider",
    "jurisdictionRisk": "jurisdiction_risk",
    "jurisdictionRiskScore": "jurisdiction_risk_score",
    "kycRiskScore": "kyc_risk_score",
    "largeTradeFlag": "large_trade_flag",
    "newExposureFlag": "new_exposure_flag",
    "notional": "notional",
    "notionalGe1bn": "notional_ge_1bn",
    "notionalGe500m": "notional_ge_500m",
    "notionalVsAvg": "notional_vs_avg",
    "notional1": "notional1",
    "riskRating": "risk_rating",
    "rollingFrequency": "rolling_frequency",
    "tradeDate": "trade_date",
    "underlying": "underlying",
}
CLIENT_PROPERTIES = {
    "id": "client_id",
    "connectedClient": "connected_client",
    "relationship": "relationship",
    "tradeId": "trade_id",
}
INSTRUMENT_PROPERTIES = {
    "id": "underlying",
    "instrumentId": "instrument_id",
    "isin": "isin",
    "sector": "sector",
}
EVENT_PROPERTIES = {
    "eventId": "event_id",
    "eventDate": "event_date",
    "eventType": "event_type",
    "importance": "importance",
    "underlying": "underlying",
}


# ---- nodes and edges ---------------------------------------------------------


def _nodes(df: DataFrame, properties: dict[str, str]) -> DataFrame:
    named = df.select(*[F.col(c).alias(p) for p, c in properties.items()])
    key = next(iter(properties))
    return one_per_key(named.where(F.col(key).isNotNull()), [key])


def trade_nodes(iq_trades: DataFrame) -> DataFrame:
    return _nodes(iq_trades, TRADE_PROPERTIES)


def client_nodes(iq_clients: DataFrame) -> DataFrame:
    """One node per client; of several links and trades the smallest one is shown."""
    return _nodes(iq_clients, CLIENT_PROPERTIES)


def instrument_nodes(iq_instruments: DataFrame) -> DataFrame:
    return _nodes(iq_instruments, INSTRUMENT_PROPERTIES)


def event_nodes(events: DataFrame) -> DataFrame:
    return _nodes(events, EVENT_PROPERTIES)


def connected_to(relationships: DataFrame, clients: DataFrame | None = None) -> DataFrame:
    """CLIENT -> CLIENT edges (src, dst, relationship); given clients, between known ones only."""
    edges = relationships.select(
        F.col("from_client").alias("src"), F.col("to_client").alias("dst"), "relationship"
    ).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if clients is not None:
        for end in ("src", "dst"):
            edges = edges.join(clients.select(F.col("client_id").alias(end)), end, "left_semi")
    return edges.distinct().select("src", "dst", "relationship")


def executes(clients: DataFrame, iq_trades: DataFrame) -> DataFrame:
    """CLIENT -> TRADE edges: the trades of known clients."""
    known = clients.select("client_id")
    owned = iq_trades.select("client_id", "trade_id").where(F.col("trade_id").isNotNull())
    return owned.join(known, "client_id", "left_semi").distinct().select(
        F.col("client_id").alias("src"), F.col("trade_id").alias("dst")
    )


def references(iq_trades: DataFrame, instruments: DataFrame) -> DataFrame:
    """TRADE -> INSTRUMENT edges, where the instrument exists."""
    return (
        iq_trades.select("trade_id", "underlying")
        .join(instruments.select("underlying").distinct(), "underlying", "left_semi")
        .distinct()
        .select(F.col("trade_id").alias("src"), F.col("underlying").alias("dst"))
    )


def has_event(instruments: DataFrame, events: DataFrame) -> DataFrame:
    """INSTRUMENT -> EVENT edges, where the instrument exists."""
    return (
        events.select("underlying", "event_id")
        .join(instruments.select("underlying").distinct(), "underlying", "left_semi")
        .distinct()
        .select(F.col("underlying").alias("src"), F.col("event_id").alias("dst"))
    )


# Ontology entities: identity key and bound columns (fixed values).
ENTITIES = {
    "Trade": ("trade_id", tuple(TRADE_PROPERTIES.values())),
    "Client": ("client_id", ("client_id", "connected_client", "relationship", "trade_id")),
    "Instrument": ("instrument_id", ("instrument_id", "isin", "sector", "underlying")),
    "Event": (
        "event_id",
        (
            "event_id",
            "trade_id",
            "underlying",
            "event_type",
            "event_date",
            "days_to_next_event",
            "event_within_7d",
            "event_within_3d",
            "has_high_importance_event",
            "has_earnings_event",
        ),
    ),
}


def entity(name: str, table: DataFrame) -> DataFrame:
    """The bound columns of an ontology entity."""
    return table.select(*ENTITIES[name][1])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; empty when the key holds."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def trade_nodes_by_prefix(nodes: DataFrame, prefix: str = "SWP") -> DataFrame:
    return nodes.where(F.col("id").startswith(prefix))


# ---- reachability ------------------------------------------------------------


def _folded(edges: DataFrame) -> DataFrame:
    """Per pair, the number of links and the link that comes first in the text of a chain."""
    first_arrow = F.min(F.concat(F.lit(" -["), F.coalesce("relationship", F.lit("?")), F.lit("]-> ")))
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"), first_arrow.alias("arrow"))


def _walks_by_hop(links: DataFrame, at: str, hops: int) -> list[DataFrame]:
    """Per client, how many walks of 1..hops links start (`at='src'`) or end (`at='dst'`) there.

    One row per client and hop, summed link by link. No client can have more pairs
    than walks, so these bound the pair counts before any pair exists.
    """
    far = "dst" if at == "src" else "src"
    walks = links.groupBy(F.col(at).alias("client")).agg(F.count(F.lit(1)).cast("double").alias("walks"))
    every = [walks]
    for _ in range(hops - 1):
        onward = walks.select(F.col("client").alias(far), "walks")
        walks = links.join(onward, far).groupBy(F.col(at).alias("client")).agg(F.sum("walks").alias("walks"))
        every.append(walks)
    return every


def _most_in(links: DataFrame) -> int:
    return most_rows(links, ["dst"])


def _most_out(links: DataFrame) -> int:
    return most_rows(links, ["src"])


def _hubs(links: DataFrame, max_hops: int, pairs_per_task: int) -> DataFrame | None:
    """Grid for the middle clients of a step: links in, times walks on (the longest counted).

    The largest degrees bound the products; only where that bound is too weak to
    rule hubs out are the products worked out client by client.
    """
    if max_hops < 2 or _most_in(links) * _most_out(links) ** (max_hops - 1) <= pairs_per_task:
        return None
    (inward,) = _walks_by_hop(links, "dst", 1)
    onward = _union(_walks_by_hop(links, "src", max_hops - 1))
    return hot_grid(
        inward.select(F.col("client").alias("root"), F.col("walks").alias("left_rows")),
        onward.groupBy(F.col("client").alias("root")).agg(F.max("walks").alias("right_rows")),
        ["root"],
        pairs_per_task,
    )


def _tasks(links: DataFrame, max_hops: int, pairs_per_task: int) -> int:
    """Among how many tasks walks are dealt, by a bound on their number; `spark.sql.shuffle.partitions` at most.

    Adaptive planning counts bytes of links, not the walks they make, and would leave all walks
    to a few tasks.
    """
    most, total = rows_per_key(links, ["src"], "n").agg(F.max("n"), F.sum("n")).first()
    at_most = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    walks = (total or 0) * (most or 0) ** (max_hops - 1)
    return max(1, min(at_most, ceil(walks * TASKS_PER_FULL_TASK / pairs_per_task)))


def _step(links: DataFrame, reached: DataFrame, hubs: DataFrame | None, tasks: int) -> DataFrame:
    """All (link start -> root, then reached root -> peer), cut where a middle client is a hub."""
    onto = links.select(F.col("src").alias("start"), F.col("dst").alias("root"), "m", "arrow")
    if hubs is None:
        onto, reached = (side.repartition(tasks, "root") for side in (onto, reached))
    return pair_join(onto, reached, ["root"], ["start"], ["peer"], hubs)


def _last_hop(links: DataFrame, targets: DataFrame | None) -> DataFrame:
    last = links.select(F.col("src").alias("root"), F.col("dst").alias("peer"), "m", "arrow")
    return last if targets is None else last.join(targets.select(F.col("client_id").alias("peer")), "peer", "left_semi")


def _grow(links: DataFrame, first: DataFrame, max_hops: int, shape, fold, pairs_per_task: int) -> list[DataFrame]:
    """`first` extended backwards hop by hop.

    `fold` makes a step one row per pair before the next one starts from it; the last
    step is left as it is, since the caller folds all hops together anyway.
    """
    hubs = _hubs(links, max_hops, pairs_per_task)
    tasks = _tasks(links, max_hops, pairs_per_task)
    reached = [first]
    for n in range(2, max_hops + 1):
        rows = shape(_step(links, reached[-1], hubs, tasks))
        reached.append(fold(rows) if n < max_hops else rows)
    return reached


def reachable(
    edges: DataFrame,
    min_hops: int = 1,
    max_hops: int = MAX_HOPS,
    targets: DataFrame | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
    by_peer: bool = False,
) -> DataFrame:
    """Distinct (root, peer, hops): peers within the hops, with the fewest hops.

    Built backwards from the peer and made distinct after every hop, so rows are
    bounded by pairs rather than walks. With `targets` (client_id) only walks that end
    there are ever made. `by_peer` puts the pairs of a peer into one task, so that a join on
    the peer need not shuffle them again.
    """
    links = _folded(edges)
    first = _last_hop(links, targets).select("root", "peer")
    hops = _grow(
        links,
        first,
        max_hops,
        lambda df: df.select(F.col("start").alias("root"), "peer"),
        lambda df: df.distinct(),
        pairs_per_task,
    )
    pairs = _union([df.withColumn("hops", F.lit(n)) for n, df in enumerate(hops, start=1) if n >= min_hops])
    if by_peer:
        pairs = pairs.repartition(_tasks(links, max_hops, pairs_per_task), "peer")
    return pairs.groupBy("root", "peer").agg(F.min("hops").alias("hops"))


def reachable_walks(
    edges: DataFrame, max_hops: int = MAX_HOPS, targets: DataFrame | None = None, pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame:
    """(root, peer, walks): in how many ways a peer is reached, parallel edges included."""
    links = _folded(edges)
    first = _last_hop(links, targets).select("root", "peer", F.col("m").alias("walks"))

    def shape(df: DataFrame) -> DataFrame:
        return df.select(F.col("start").alias("root"), "peer", (F.col("m") * F.col("walks")).alias("walks"))

    def fold(df: DataFrame) -> DataFrame:
        return df.groupBy("root", "peer").agg(F.sum("walks").alias("walks"))

    return fold(_union(_grow(links, first, max_hops, shape, fold, pairs_per_task)))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def relationship_chain(
    edges: DataFrame, max_hops: int = MAX_HOPS, targets: DataFrame | None = None, pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame:
    """(root, peer, hops, chain): the shortest chain of named links, first in text order.

    Per hop only the first chain of a pair is kept: what is put before it is the
    same for all of them, so no other can lead to a first chain later.
    """
    links = _folded(edges)

    first = _last_hop(links, targets).select("root", "peer", F.concat("root", "arrow", "peer").alias("chain"))

    def shape(df: DataFrame) -> DataFrame:
        return df.select(F.col("start").alias("root"), "peer", F.concat("start", "arrow", "chain").alias("chain"))

    def fold(df: DataFrame) -> DataFrame:
        return df.groupBy("root", "peer").agg(F.min("chain").alias("chain"))

    tails = _grow(links, first, max_hops, shape, fold, pairs_per_task)
    every = _union([tail.withColumn("hops", F.lit(n)) for n, tail in enumerate(tails, start=1)])
    best = every.groupBy("root", "peer").agg(F.min(F.struct("hops", "chain")).alias("best"))
    return best.select("root", "peer", "best.hops", "best.chain")


# ---- detections --------------------------------------------------------------


def _traded(iq_trades: DataFrame, instruments: DataFrame) -> DataFrame:
    """Trades that reference an existing instrument."""
    return iq_trades.join(instruments.select("underlying").distinct(), "underlying", "left_semi")


def client_exposure(trades: DataFrame) -> DataFrame:
    """Per (client, underlying): exposure, trades, nearest event, first and last trade day."""
    return trades.where(F.col("client_id").isNotNull()).groupBy("client_id", "underlying").agg(
        F.sum(fx.exposure()).alias("exposure"),
        F.count(F.lit(1)).alias("trades"),
        F.min("days_to_next_event").alias("nearest"),
        F.min("trade_date").alias("earliest"),
        F.max("trade_date").alias("latest"),
    )


def _over_peers(
    edges: DataFrame,
    exposure: DataFrame,
    max_hops: int,
    pairs_per_task: int,
    sums: tuple[str, ...],
    least: tuple[str, ...] = (),
    most: tuple[str, ...] = (),
) -> DataFrame:
    """Per (root, underlying): how many peers within reach hold it (`connected_clients`), and their measures.

    Trades are folded per peer and underlying first, and only peers that hold something are
    searched for. Where no client has more walks than one task should make, measures are
    summed link by link; else each root meets each holding of each of its peers.
    """
    sums = ("connected_clients", *sums)
    held = exposure.withColumn("connected_clients", F.lit(1).cast("long")).select("client_id", "underlying", *sums, *least, *most)
    targets = held.select("client_id").distinct()
    links = _folded(edges)
    grid = _peer_grid(edges, held, max_hops, pairs_per_task)
    folds = [F.sum(c).alias(c) for c in sums] + [F.min(c).alias(c) for c in least] + [F.max(c).alias(c) for c in most]
    if grid is not None or _at_most(_most_out(links), max_hops) * most_rows(held, ["client_id"]) > pairs_per_task:
        pairs = reachable(edges, 1, max_hops, targets, pairs_per_task, by_peer=grid is None)
        return _join_peers(pairs, held, "underlying", grid).groupBy("root", "underlying").agg(*folds)
    tasks = _tasks(links, max_hops, pairs_per_task)
    return _over_walks(edges, held, targets, max_hops, pairs_per_task, sums, tasks, folds)


def _over_walks(
    edges: DataFrame,
    held: DataFrame,
    targets: DataFrame,
    max_hops: int,
    pairs_per_task: int,
    sums: tuple[str, ...],
    tasks: int,
    folds: list[Column],
) -> DataFrame:
    """`_over_peers` by sums over links, one row per (client, underlying) after each.

    They count a peer once per walk that leads to it (a least or greatest value stays the
    same). What is too much is listed for the pairs with several walks, and taken off.
    """
    ends = edges.select("src", "dst", F.lit(None).cast("string").alias("relationship")).distinct()
    own = held.withColumnRenamed("client_id", "root")
    onto = ends.select(F.col("src").alias("start"), F.col("dst").alias("root")).repartition(tasks, "root")
    again = reachable_walks(ends, max_hops, targets, pairs_per_task).where(F.col("walks") > 1)
    extra = _join_peers(again, held, "underlying", None)
    off = {c: (F.col(c) * (1 - F.col("walks"))).cast(held.schema[c].dataType) for c in sums}
    surplus = extra.select("root", "underlying", *[v.alias(c) for c, v in off.items()])

    at = own.repartition(tasks, "root")
    for hop in range(1, max_hops + 1):
        step = onto.join(at, "root").drop("root").withColumnRenamed("start", "root")
        rows = step.unionByName(own) if hop < max_hops else step.unionByName(surplus, allowMissingColumns=True)
        # all rows of a client go to one task as they are: few of them lie in one task before
        at = rows.repartition(tasks, "root").groupBy("root", "underlying").agg(*folds)
    return at


def _at_most(degree: int, max_hops: int) -> int:
    """Walks of one client of up to so many hops, by the largest degree."""
    return sum(degree**n for n in range(1, max_hops + 1))


def _peer_grid(edges: DataFrame, holdings: DataFrame, max_hops: int, pairs_per_task: int) -> DataFrame | None:
    """Grid for peers with many roots and holdings; walks into a peer bound its number of roots."""
    links = _folded(edges)
    if _at_most(_most_in(links), max_hops) * most_rows(holdings, ["client_id"]) <= pairs_per_task:
        return None
    into = _union(_walks_by_hop(links, "dst", max_hops))
    roots = into.groupBy(F.col("client").alias("client_id")).agg(F.sum("walks").alias("left_rows"))
    return hot_grid(roots, rows_per_key(holdings, ["client_id"], "right_rows"), ["client_id"], pairs_per_task)


def _join_peers(pairs: DataFrame, holdings: DataFrame, tell_apart: str, grid: DataFrame | None) -> DataFrame:
    """(root, peer) with what the peer holds."""
    return pair_join(pairs.withColumnRenamed("peer", "client_id"), holdings, ["client_id"], ["root"], [tell_apart], grid)


def _walk_exposure(edges: DataFrame, exposure: DataFrame, max_hops: int, pairs_per_task: int) -> DataFrame:
    """Exposure summed over walks: each step is a weighted sum per (client, underlying)."""
    links = _folded(edges)
    onto = links.select(F.col("src").alias("start"), F.col("dst").alias("root"), "m")
    total = F.col("exposure").cast("decimal(38,2)").alias("total")
    at = exposure.select(F.col("client_id").alias("root"), "underlying", total)
    # a client sums over at most as many underlyings as there are
    widest = exposure.agg(F.count_distinct("underlying")).first()[0]
    grid = None
    if _most_in(links) * widest > pairs_per_task:
        (inward,) = _walks_by_hop(links, "dst", 1)
        inward = inward.select(F.col("client").alias("root"), F.col("walks").alias("left_rows"))
        grid = hot_grid(inward, inward.select("root", F.lit(widest).alias("right_rows")), ["root"], pairs_per_task)
    every = []
    for _ in range(max_hops):
        part = (F.col("m").cast("decimal(18,0)") * F.col("total")).cast("decimal(38,2)")
        at = (
            pair_join(onto, at, ["root"], ["start"], ["underlying"], grid)
            .groupBy(F.col("start").alias("root"), "underlying")
            .agg(F.sum(part).cast("decimal(38,2)").alias("total"))
        )
        every.append(at)
    return _union(every).groupBy("root", "underlying").agg(F.sum("total").alias("total"))


def event_clusters(
    edges: DataFrame,
    iq_trades: DataFrame,
    instruments: DataFrame,
    max_days: int = fx.NEAR_EVENT_DAYS,
    max_hops: int = MAX_HOPS,
    multiplicity: str = "pair",
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Per (root, underlying): linked clients trading shortly before an event, and for how much.

    `multiplicity='pair'` counts a peer's exposure once per root, `'path'` once per
    walk that leads to the peer.
    """
    if multiplicity not in ("pair", "path"):
        raise ValueError(f"multiplicity must be 'pair' or 'path', not {multiplicity!r}")
    near = _traded(iq_trades.where(F.col("days_to_next_event") <= max_days), instruments)
    exposure = client_exposure(near)
    clusters = _over_peers(edges, exposure, max_hops, pairs_per_task, ("exposure",), least=("nearest",)).select(
        "root", "underlying", "connected_clients", F.col("exposure").alias("total"), F.col("nearest").alias("min_days_to_event")
    )
    if multiplicity == "path":
        clusters = clusters.drop("total").join(_walk_exposure(edges, exposure, max_hops, pairs_per_task), ["root", "underlying"])
    return clusters.select(
        F.col("root").alias("root_client"),
        "underlying",
        "connected_clients",
        F.col("total").cast("double").alias("total_exposure"),
        "min_days_to_event",
    )


def pre_event_cluster(
    edges: DataFrame, iq_trades: DataFrame, instruments: DataFrame, k: int = TOP_CLUSTERS, **options
) -> DataFrame:
    """The k clusters with the largest exposure."""
    clusters = event_clusters(edges, iq_trades, instruments, **options)
    return clusters.orderBy(F.desc("total_exposure"), "root_client", "underlying").limit(k)


def potential_insider_cluster(
    edges: DataFrame,
    iq_trades: DataFrame,
    instruments: DataFrame,
    min_peers: int = CLUSTER_PEERS,
    min_exposure: float = fx.HALF_BILLION,
    **options,
) -> DataFrame:
    """Clusters with enough linked clients and more than the given exposure, labelled."""
    clusters = event_clusters(edges, iq_trades, instruments, **options)
    return clusters.where(
        (F.col("connected_clients") >= min_peers) & (F.col("total_exposure") > min_exposure)
    ).withColumn("finding", F.lit("potential insider cluster"))


def peer_exposure_listing(
    edges: DataFrame,
    iq_trades: DataFrame,
    instruments: DataFrame,
    max_hops: int = MAX_HOPS,
    multiplicity: str = "pair",
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Root, peer, exposure, underlying: one row per peer trade (or per walk and trade)."""
    deals = _traded(iq_trades, instruments).select("client_id", "trade_id", F.col("notional1").alias("exposure"), "underlying")
    targets = deals.select("client_id").distinct()
    grid = _peer_grid(edges, deals, max_hops, pairs_per_task)
    if multiplicity == "path":
        pairs = reachable_walks(edges, max_hops, targets, pairs_per_task)
    else:
        pairs = reachable(edges, 1, max_hops, targets, pairs_per_task, by_peer=grid is None).drop("hops")
    rows = _join_peers(pairs, deals, "trade_id", grid)
    if multiplicity == "path":
        rows = rows.withColumn("walk", F.explode(F.sequence(F.lit(1), F.col("walks"))))
    return rows.select(
        F.col("root").alias("root_client"), F.col("client_id").alias("connected_client"), "exposure", "underlying"
    )


def hot_instruments(
    iq_trades: DataFrame, max_days: int = fx.NEAR_EVENT_DAYS, min_exposure: float = fx.HALF_BILLION
) -> DataFrame:
    """Instruments with more than the given exposure shortly before an event."""
    return (
        iq_trades.where(F.col("days_to_next_event") <= max_days)
        .groupBy("underlying")
        .agg(
            F.sum(fx.exposure()).cast("double").alias("total_exposure"),
            F.count(F.lit(1)).alias("trades"),
            F.min("days_to_next_event").alias("min_days_to_event"),
        )
        .where(F.col("total_exposure") > min_exposure)
    )


def coordinated_instrument_trading(
    edges: DataFrame,
    iq_trades: DataFrame,
    instruments: DataFrame,
    min_peers: int = CLUSTER_PEERS,
    max_hops: int = MAX_HOPS,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """(root, underlying) that several linked clients trade, with first and last trade day."""
    exposure = client_exposure(_traded(iq_trades, instruments))
    measures = {"sums": ("trades", "exposure"), "least": ("earliest",), "most": ("latest",)}
    return (
        _over_peers(edges, exposure, max_hops, pairs_per_task, **measures)
        .select(
            F.col("root").alias("root_client"),
            "underlying",
            "connected_clients",
            "trades",
            F.col("exposure").cast("double").alias("total_exposure"),
            F.col("earliest").alias("earliest_trade"),
            F.col("latest").alias("latest_trade"),
        )
        .where(F.col("connected_clients") >= min_peers)
    )


def explain_flags(store: DataFrame) -> DataFrame:
    """Why a trade stands out, in words, with the linked event distance and network facts."""
    reasons = (
        F.when(
            F.col("days_to_next_event") <= fx.NEAR_EVENT_DAYS,
            F.concat(F.lit("traded "), F.col("days_to_next_event").cast("string"), F.lit(" days before an event")),
        ),
        F.when(F.col("has_high_importance_event") == 1, F.lit("high importance event ahead")),
        F.when(F.col("has_earnings_event") == 1, F.lit("earnings event ahead")),
        F.when(
            F.col("notional1") > fx.HALF_BILLION, F.lit("exposure above 500,000,000")
        ).when(F.col("notional1") > fx.LARGE_TRADE, F.lit("exposure above 200,000,000")),
        F.when(F.col("jurisdiction_risk_score") == 3, F.lit("high jurisdiction risk")),
        F.when(F.col("kyc_risk_score") == 3, F.lit("high client risk rating")),
        F.when(
            F.col("distinct_neighbors_1hop") >= 1,
            F.concat(F.lit("linked to "), F.col("distinct_neighbors_1hop").cast("string"), F.lit(" clients")),
        ),
        F.when(F.col("in_three_hop_loop") == 1, F.lit("part of a three-link client loop")),
    )
    return store.select("trade_id", "client_id", "underlying", F.concat_ws("; ", *reasons).alias("reasons")).where(
        F.col("reasons") != ""
    )
