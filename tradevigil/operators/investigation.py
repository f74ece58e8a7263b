"""Investigation tables: client-relative trades, events, client networks, alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradevigil.functions import columns as fx
from tradevigil.operators.features import PROXIMITY_COLUMNS
from tradevigil.operators.joins import (
    PAIRS_PER_TASK,
    all_of,
    counted_grid,
    hot_grid,
    not_yet_in,
    pair_join,
    pair_left_join,
    rows_per_key,
)
from tradevigil.session import scratch_path

# The running count looks at this many earlier rows plus the trade itself.
EARLIER_ROWS = 7
ALERT_PROBABILITY = 0.80


# ---- client-relative trade measures -----------------------------------------


def _straight_from_files(rows: DataFrame) -> bool:
    """Whether the rows are those of a file table, renamed, filtered or with more columns, each once."""
    node = rows._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation" and bool(rows.inputFiles())


def with_place(rows: DataFrame) -> DataFrame:
    """The rows with `row_place`, which tells equal rows apart: their file, and the place in it.

    Rows that do not come straight from files (joined, grouped, limited, made up) stay as they are.
    """
    if not _straight_from_files(rows):
        return rows
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.select("*", place.alias("row_place"))


def _places(rows: DataFrame) -> list[str]:
    return [c for c in ("row_place",) if c in rows.columns]


def first_trades_of(rows: DataFrame) -> DataFrame:
    """A client's first rows by day, id and place (`EARLIER_ROWS` at most), with their `position`.

    The limit is applied in the map tasks as well, so few rows of a client are shuffled.
    """
    in_order = Window.partitionBy("client_id").orderBy("trade_date", "trade_id", *_places(rows))
    return rows.withColumn("position", F.row_number().over(in_order)).where(F.col("position") <= EARLIER_ROWS)


def listed_firsts(firsts: DataFrame) -> DataFrame:
    """`first_trades`: the rows of `first_trades_of` in order, per client.

    With places they are listed per client and underlying: a trade then looks for itself
    alone, and no row carries the first trades on other underlyings.
    """
    per = ["client_id", "underlying"] if _places(firsts) else ["client_id"]
    entry = F.struct("position", "trade_date", "trade_id", *_places(firsts))
    return firsts.groupBy(*per).agg(F.sort_array(F.collect_list(entry)).alias("first_trades"))


def pair_stats(pairs: DataFrame, averages: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows per (client, underlying) with the client's average and the first trades listed for them."""
    if "underlying" in listed.columns:
        return _beside(_beside(pairs, averages, ["client_id"]), listed, ["client_id", "underlying"])
    return _beside(pairs, _beside(averages, listed, ["client_id"]), ["client_id"])


def client_trade_stats(store: DataFrame) -> DataFrame:
    """One row per (client, underlying): trades there, client average, client's first trades.

    All of it is aggregated before a shuffle, so a client with a third of all trades
    costs each map task a few rows. The running count over the last 8 rows is the
    row's position up to 8, so only a client's first 7 trades matter; the ranking
    filter is applied in the map tasks as well as after the shuffle.
    """
    amount = F.col("notional").cast("float")
    pairs = store.groupBy("client_id", "underlying").agg(
        F.count(F.lit(1)).alias("pair_trades"),
        F.sum(amount.cast("double")).alias("pair_sum"),
        F.count(amount).alias("pair_amounts"),
    )
    averages = pairs.groupBy("client_id").agg(
        fx.ratio(F.sum("pair_sum"), F.sum("pair_amounts")).alias("client_average")
    )
    firsts = first_trades_of(store.select("client_id", "underlying", "trade_date", "trade_id", *_places(store)))
    return pair_stats(pairs.select("client_id", "underlying", "pair_trades"), averages, listed_firsts(firsts))


def _running_count(trades: DataFrame) -> DataFrame:
    """`rolling_frequency` from the listed `first_trades`: the row's place by day and id, up to 8.

    Rows of one client, day and id (repeated or without an id) come one after the other: by
    their place in the files, or else in order of a hash of the row, which only rows at a
    place among the first need.
    """
    if _places(trades):
        own = F.get(F.filter("first_trades", lambda first: first["row_place"] == F.col("row_place")), F.lit(0))
        place = F.coalesce(own["position"], F.lit(EARLIER_ROWS + 1))
        return trades.withColumn("rolling_frequency", place.cast("long"))

    def same(first):
        return first["trade_date"].eqNullSafe(F.col("trade_date")) & first["trade_id"].eqNullSafe(F.col("trade_id"))

    most = F.lit(EARLIER_ROWS + 1)
    start = F.get(F.filter("first_trades", same), F.lit(0))["position"]
    known = trades.withColumn("first_place", start)
    own = [c for c in trades.columns if c != "first_trades"]
    repeats = Window.partitionBy("client_id", "trade_date", "trade_id").orderBy(F.xxhash64(*own))
    place = F.least(F.col("first_place") + F.row_number().over(repeats) - 1, most)
    early = known.where(F.col("first_place").isNotNull()).withColumn("rolling_frequency", place.cast("long"))
    late = known.where(F.col("first_place").isNull()).withColumn("rolling_frequency", most.cast("long"))
    return early.unionByName(late)


def _beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe left join: trades without a client form a group of their own."""
    other = right.withColumnsRenamed({k: f"same_{k}" for k in keys})
    same = all_of([F.col(k).eqNullSafe(F.col(f"same_{k}")) for k in keys])
    return left.join(other, same, "left").drop(*[f"same_{k}" for k in keys])


def iq_trades(store: DataFrame, existing: DataFrame | None = None, scope: str = "history") -> DataFrame:
    """Client-relative economics, flags, running frequency and anomaly score per trade.

    With `existing`, only unseen trades are returned. `scope='history'` measures them
    against all of the client's trades; `scope='batch'` against the new ones only.
    """
    if scope not in ("history", "batch"):
        raise ValueError(f"scope must be 'history' or 'batch', not {scope!r}")
    store = with_place(store)
    fresh = store if existing is None else not_yet_in(store, existing, ["trade_id"])
    measured = fresh if scope == "batch" else store
    if scope == "history" and existing is not None:
        # only clients with new trades need their history measured
        touched = fresh.select(F.col("client_id").alias("touched_client")).distinct()
        measured = store.join(touched, F.col("client_id").eqNullSafe(F.col("touched_client")), "left_semi")
    return measured_trades(fresh, client_trade_stats(measured))


def measured_trades(fresh: DataFrame, stats: DataFrame) -> DataFrame:
    """The investigated-trades columns of `fresh` by the statistics of their clients."""
    stats = stats.withColumnRenamed("client_id", "stat_client").withColumnRenamed("underlying", "stat_underlying")
    same_pair = F.col("client_id").eqNullSafe(F.col("stat_client")) & F.col("underlying").eqNullSafe(
        F.col("stat_underlying")
    )
    placed = _running_count(fresh.join(stats, same_pair, "left"))
    return placed.select(
        "trade_id",
        "client_id",
        "underlying",
        "trade_date",
        "direction",
        "notional",
        "notional1",
        fx.ratio(F.col("notional").cast("float"), "client_average").alias("notional_vs_avg"),
        fx.flag(F.col("pair_trades") == 1).alias("new_exposure_flag"),
        fx.above("notional", fx.LARGE_TRADE).alias("large_trade_flag"),
        "rolling_frequency",
        F.col("label_insider").alias("is_insider"),
        "days_to_next_event",
        "event_within_7d",
        "event_within_3d",
        "jurisdiction_risk",
        "jurisdiction_risk_score",
        "risk_rating",
        "kyc_risk_score",
        "notional_ge_1bn",
        "notional_ge_500m",
        fx.anomaly_score().alias("anomaly_score"),
    )


# ---- trades and events -------------------------------------------------------


def iq_events(
    events: DataFrame,
    base: DataFrame,
    proximity: DataFrame,
    existing: DataFrame | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Every (trade, event) pair on one underlying with the trade's proximity features.

    The product is the table's meaning; it is made in grid cells, so that an
    underlying with most trades and events is shared by many tasks. Events on an
    underlying nobody trades keep one row without a trade.

    With `existing`, only unseen pairs are returned. Events that have none stored need no
    look at the stored pairs, and those that have all of theirs stored none at all.
    """
    traded = (
        base.where(F.col("underlying").isNotNull())
        .select("underlying", F.col("trade_id").alias("base_trade"))
        .join(proximity.withColumn("base_trade", F.col("trade_id")), "base_trade", "left")
    )
    shaped = events.select("event_id", "underlying", "event_type", "event_date")

    def pairs(of: DataFrame) -> DataFrame:
        grid = counted_grid(of, base, ["underlying"], pairs_per_task)
        rows = pair_left_join(of, traded, ["underlying"], ["event_id"], ["base_trade"], grid)
        return rows.select("trade_id", "event_id", "underlying", "event_type", "event_date", *PROXIMITY_COLUMNS)

    if existing is None:
        return pairs(shaped)
    seen = _seen_events(shaped, traded, existing)
    added = pairs(not_yet_in(shaped, seen, ["event_id"]))
    partly = seen.where(~F.col("whole")).select(F.col("event_id").alias("partly_seen"))
    if partly.isEmpty():
        return added
    of_partly = F.col("event_id").eqNullSafe(F.col("partly_seen"))
    again, stored = (df.join(partly, of_partly, "left_semi") for df in (shaped, existing))
    return added.unionByName(not_yet_in(pairs(again), stored, ["trade_id", "event_id"]))


def _trades_digest(trade: Column) -> list[Column]:
    """Number of rows, and sums and exclusive or of the trades' hashes: alike whatever the order."""
    code = F.xxhash64(trade)
    return [
        F.count(F.lit(1)).alias("d_rows"),
        F.sum(code.bitwiseAND(F.lit(0xFFFFFFFF))).alias("d_low"),
        F.sum(F.shiftright(code, 32)).alias("d_high"),
        F.bit_xor(code).alias("d_xor"),
    ]


def _seen_events(events: DataFrame, traded: DataFrame, existing: DataFrame) -> DataFrame:
    """(event_id, whole): the events of stored pairs, and whether exactly all of their pairs are stored.

    Told by a digest of an event's trades, that of the pairs-to-be summed from one per
    underlying; no pair is shuffled. Stored below the shared folder, as several steps read it.
    """
    digest = ("d_rows", "d_low", "d_high", "d_xor")
    code = F.xxhash64(F.lit(None).cast(traded.schema["trade_id"].dataType))
    without = (F.lit(1), code.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(code, 32), code)
    per_underlying = traded.groupBy("underlying").agg(*_trades_digest(F.col("trade_id")))
    each = events.join(per_underlying, "underlying", "left")
    due = each.groupBy(F.col("event_id").alias("due_event")).agg(
        *[
            (F.bit_xor if c == "d_xor" else F.sum)(F.coalesce(F.col(c), none)).alias(f"due_{c}")
            for c, none in zip(digest, without)
        ]
    )
    held = existing.groupBy("event_id").agg(*_trades_digest(F.col("trade_id")))
    whole = all_of([F.col(c).eqNullSafe(F.col(f"due_{c}")) for c in digest])
    seen = held.join(due, F.col("event_id").eqNullSafe(F.col("due_event")), "left").select("event_id", whole.alias("whole"))
    path = scratch_path(existing.sparkSession, "seen_events")
    seen.write.parquet(path)
    return existing.sparkSession.read.parquet(path)


def iq_events_delta(
    new_events: DataFrame,
    old_events: DataFrame,
    new_base: DataFrame,
    old_base: DataFrame,
    proximity: DataFrame,
    pairs_per_task: int = PAIRS_PER_TASK,
    fold: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """What `iq_events` over all rows holds beyond `iq_events` over the old ones; neither is made.

    New trades meet all events, old trades the new events alone. New events that nobody
    trades get their row without a trade. `fold` is applied to the rows of either kind where
    they are made, before both are put together.
    """
    seen = old_events.join(new_base.select("underlying").distinct(), "underlying", "left_semi")
    near = proximity.join(new_base.select("trade_id"), "trade_id", "left_semi")
    with_new_trades = iq_events(seen, new_base, near, pairs_per_task=pairs_per_task)
    with_new_events = iq_events(new_events, old_base.unionByName(new_base), proximity, pairs_per_task=pairs_per_task)
    if fold is not None:
        with_new_trades, with_new_events = fold(with_new_trades), fold(with_new_events)
    return with_new_trades.unionByName(with_new_events)


def client_network(
    relationships: DataFrame, trades: DataFrame, events: DataFrame, pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame:
    """Distinct root client, linked client, its trades and the events on their underlyings.

    `trades` is the investigated-trades table; `events` may be the raw events or the
    trade-event table, which hold the same (underlying, date, type) rows. Each input
    is made distinct before the joins: their product then is distinct as well, and
    the large result needs no shuffle of its own.
    """
    links = relationships.select(
        F.col("from_client").alias("root_client"), F.col("to_client").alias("connected_client"), "relationship"
    ).distinct()
    deals = trades.select(
        F.col("client_id").alias("connected_client"),
        "trade_id",
        "underlying",
        "trade_date",
        "notional",
        "kyc_risk_score",
        "days_to_next_event",
    ).distinct()
    happenings = events.select("underlying", "event_date", "event_type").distinct()
    link_rows = rows_per_key(links, ["connected_client"], "left_rows")
    deal_rows = rows_per_key(deals, ["connected_client"], "right_rows")
    per_client = hot_grid(link_rows, deal_rows, ["connected_client"], pairs_per_task)
    linked = pair_join(links, deals, ["connected_client"], ["root_client", "relationship"], ["trade_id"], per_client)
    # rows of `linked` per underlying, from the counts instead of the rows
    linked_rows = (
        deals.where(F.col("underlying").isNotNull())
        .join(link_rows, "connected_client")
        .groupBy("underlying")
        .agg(F.sum("left_rows").alias("left_rows"))
    )
    event_rows = rows_per_key(happenings, ["underlying"], "right_rows")
    return pair_left_join(
        linked,
        happenings,
        ["underlying"],
        ["root_client", "connected_client", "trade_id"],
        ["event_date", "event_type"],
        hot_grid(linked_rows, event_rows, ["underlying"], pairs_per_task),
    ).select(
        "root_client",
        "connected_client",
        "relationship",
        "trade_id",
        "underlying",
        "trade_date",
        "notional",
        "kyc_risk_score",
        "event_date",
        "event_type",
        "days_to_next_event",
    )


def live_links(relationships: DataFrame, trades: DataFrame) -> DataFrame:
    """Distinct links whose far end has traded: the links a client network shows."""
    traders = trades.select(F.col("client_id").alias("to_client")).distinct()
    return (
        relationships.select("from_client", "to_client", "relationship").distinct().join(traders, "to_client", "left_semi")
    )


def iq_clients(
    clients: DataFrame,
    relationships: DataFrame,
    trades: DataFrame,
    existing: DataFrame | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Each client with each live link and each own trade, as a set on all four columns."""
    known = clients.select("client_id").distinct()
    links = live_links(relationships, trades).select(
        F.col("from_client").alias("client_id"), F.col("to_client").alias("connected_client"), "relationship"
    )
    own = trades.select("client_id", "trade_id").distinct()
    linked = known.join(links, "client_id", "left")
    out_links = relationships.withColumnRenamed("from_client", "client_id")
    rows = pair_left_join(
        linked,
        own,
        ["client_id"],
        ["connected_client", "relationship"],
        ["trade_id"],
        counted_grid(out_links, trades, ["client_id"], pairs_per_task),
    ).select("client_id", "connected_client", "relationship", "trade_id")
    if existing is None:
        return rows
    return not_yet_in(rows, existing, ["client_id", "connected_client", "relationship", "trade_id"])


def iq_clients_delta(
    new_clients: DataFrame,
    old_clients: DataFrame,
    new_links: DataFrame,
    old_links: DataFrame,
    new_trades: DataFrame,
    old_trades: DataFrame,
    old_traders: DataFrame | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """What `iq_clients` over all rows holds beyond `iq_clients` over the old ones; neither is made.

    Known clients: their new trades meet all their live links, and links that have come
    alive (new, or their far end's first trade) meet their old trades. New clients meet
    everything of theirs. `old_traders` (`client_id`) may name the clients of the old trades, where a
    smaller table than the trades holds them.
    """
    key = ["client_id", "connected_client", "relationship"]

    def ids(df: DataFrame) -> DataFrame:
        return df.select("client_id").distinct()

    def shaped(links: DataFrame) -> DataFrame:
        return links.select(F.col("from_client").alias("client_id"), F.col("to_client").alias("connected_client"), "relationship").distinct()

    known = ids(old_clients)
    added = not_yet_in(ids(new_clients), known, ["client_id"])
    traded_before = ids(old_traders if old_traders is not None else old_trades)
    trading_now = traded_before.unionByName(ids(new_trades)).distinct()
    far_before = traded_before.withColumnRenamed("client_id", "connected_client")
    far_now = trading_now.withColumnRenamed("client_id", "connected_client")
    links_before = shaped(old_links)
    links = links_before.unionByName(shaped(new_links)).distinct()
    live = links.join(far_now, "connected_client", "left_semi")
    awake = not_yet_in(live, links_before.join(far_before, "connected_client", "left_semi"), key)

    def own(trades: DataFrame, of: DataFrame) -> DataFrame:
        return trades.select("client_id", "trade_id").join(of.select("client_id").distinct(), "client_id", "left_semi").distinct()

    def product(left: DataFrame, trades: DataFrame, how) -> DataFrame:
        grid = counted_grid(left, trades, ["client_id"], pairs_per_task)
        return how(left, trades, ["client_id"], ["connected_client", "relationship"], ["trade_id"], grid).select(*key, "trade_id")

    with_new = known.join(ids(new_trades), "client_id", "left_semi").join(live, "client_id", "left")
    awake_known = awake.join(known, "client_id", "left_semi").select(*key)
    first = product(with_new.select(*key), own(new_trades, known), pair_join)
    second = product(awake_known, own(old_trades, awake_known), pair_join)
    without = awake_known.join(trading_now, "client_id", "left_anti").withColumn("trade_id", F.lit(None).cast(dict(new_trades.dtypes)["trade_id"]))
    every = old_trades.select("client_id", "trade_id").unionByName(new_trades.select("client_id", "trade_id"))
    third = product(added.join(live, "client_id", "left").select(*key), own(every, added), pair_left_join)
    return first.unionByName(second).unionByName(without.select(*key, "trade_id")).unionByName(third)


def iq_instruments(instruments: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct instruments (trades can neither add nor remove any)."""
    rows = instruments.select("underlying", "isin", "sector", "instrument_id").distinct()
    return rows if existing is None else not_yet_in(rows, existing, ["instrument_id"])


# ---- alerts ------------------------------------------------------------------


def agent_alerts(
    scores: DataFrame, existing: DataFrame | None = None, probability: float = ALERT_PROBABILITY
) -> DataFrame:
    """Trades scored above the alert probability, stamped; unseen ones when `existing` is given."""
    alerts = scores.where(F.col("predicted_probability") > probability).select(
        "trade_id",
        "client_id",
        "underlying",
        "risk_flag",
        F.col("predicted_probability").cast("double").alias("risk_score"),
        F.current_timestamp().alias("timestamp"),
    )
    return alerts if existing is None else not_yet_in(alerts, existing, ["trade_id"])
