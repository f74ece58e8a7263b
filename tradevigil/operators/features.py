"""Feature store: enriched trades, client network measures, event proximity, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradevigil.functions import columns as fx
from tradevigil.operators.dimensions import as_of
from tradevigil.operators.joins import PAIRS_PER_TASK, counted_grid, hot_grid, not_yet_in, pair_join, rows_per_key
from tradevigil.schemas import EVENT_HORIZON_DAYS, MONEY, NO_EVENT_DAYS, RATE, UNITS

HOP1_COLUMNS = ("out_degree", "in_degree", "distinct_neighbors_1hop", "has_1hop_link")
HOP3_COLUMNS = ("hop3_path_count", "three_hop_loop_count", "in_three_hop_loop")
PROXIMITY_COLUMNS = (
    "days_to_next_event",
    "event_within_7d",
    "event_within_3d",
    "has_high_importance_event",
    "has_earnings_event",
)


# ---- enriched trades ---------------------------------------------------------

_FIXED_POINT = {
    "notional": MONEY,
    "quantity": UNITS,
    "price": UNITS,
    "dividend_rate": RATE,
    "financing_spread": RATE,
}
_DAYS = ("trade_date", "booking_date", "maturity_date")


def feature_trade_base(
    trades: DataFrame,
    clients: DataFrame,
    instruments: DataFrame,
    existing: DataFrame | None = None,
    client_sent: str | None = None,
) -> DataFrame:
    """Trades with fixed-point amounts, client and instrument attributes and the label.

    With `existing`, only trades it does not hold: they are dropped before the
    lookups, so a small increment joins little. `client_sent` names the column of `clients`
    that says when a row was sent: trades then take their client as known on the trade's day.
    """
    if existing is not None:
        trades = not_yet_in(trades, existing, ["trade_id"])
    shaped = []
    for name in trades.columns:
        if name.startswith("_"):
            continue
        if name in _DAYS:
            shaped.append(fx.as_day(name).alias(name))
        elif name in _FIXED_POINT:
            shaped.append(fx.fixed_point(name, _FIXED_POINT[name]).alias(name))
            if name == "notional":
                shaped.append(F.col(name).alias("notional1"))
        else:
            shaped.append(F.col(name))
    who = clients.select("client_id", "country", "risk_rating", *([client_sent] if client_sent else []))
    what = instruments.select("underlying", "isin", "instrument_id", "sector")
    dealt = trades.select(*shaped)
    known = as_of(dealt, who, ["client_id"], "trade_date", client_sent) if client_sent else dealt.join(who, ["client_id"], "left")
    joined = known.join(what, ["underlying", "isin"], "left")
    return joined.select(
        *_base_order(trades.columns),
        "country",
        "risk_rating",
        "instrument_id",
        "sector",
        fx.insider_label().alias("label_insider"),
    )


def _base_order(landed: list[str]) -> list[str]:
    order = []
    for name in landed:
        if not name.startswith("_"):
            order.append(name)
            if name == "notional":
                order.append("notional1")
    return order


# ---- client network ----------------------------------------------------------


def client_hop1(clients: DataFrame, relationships: DataFrame) -> DataFrame:
    """Degrees and distinct neighbours of every client, zeros where it has no link.

    Links out and distinct neighbours come from one aggregate; Spark plans its
    distinct count as (client, neighbour) first, so a hub is spread.
    """
    outward = relationships.groupBy(F.col("from_client").alias("client_id")).agg(
        F.count(F.lit(1)).alias("out_degree"),
        F.countDistinct("to_client").alias("distinct_neighbors_1hop"),
    )
    inward = relationships.groupBy(F.col("to_client").alias("client_id")).agg(F.count(F.lit(1)).alias("in_degree"))
    return (
        clients.select("client_id")
        .join(outward, "client_id", "left")
        .join(inward, "client_id", "left")
        .select(
            "client_id",
            *[fx.or_zero(c).cast("long").alias(c) for c in HOP1_COLUMNS[:3]],
            fx.flag(F.col("distinct_neighbors_1hop") >= 1).alias("has_1hop_link"),
        )
    )


def link_counts(relationships: DataFrame) -> DataFrame:
    """Parallel links folded into (src, dst, m): how often src points at dst."""
    return (
        relationships.where(F.col("from_client").isNotNull() & F.col("to_client").isNotNull())
        .groupBy(F.col("from_client").alias("src"), F.col("to_client").alias("dst"))
        .agg(F.count(F.lit(1)).alias("m"))
    )


def three_hop_paths(links: DataFrame) -> DataFrame:
    """(client_id, hop3_path_count): number of 3-link walks, without listing any.

    Walks of length k+1 from u are the sum over links u->v of m(u,v) times the walks
    of length k from v. Each step keeps at most one row per link and one per client.
    """
    walks = links.groupBy("src").agg(F.sum("m").alias("walks"))
    for _ in range(2):
        onward = walks.select(F.col("src").alias("dst"), "walks")
        walks = links.join(onward, "dst").groupBy("src").agg(F.sum(F.col("m") * F.col("walks")).alias("walks"))
    return walks.select(F.col("src").alias("client_id"), F.col("walks").alias("hop3_path_count"))


def three_hop_loops(links: DataFrame) -> DataFrame:
    """(client_id, three_hop_loop_count): number of closed 3-link walks per client.

    A loop over three different clients counts once for each of them, so each is
    found once only, at the member with the fewest neighbours (ties by id). Its two
    links at that member lead to better connected clients, of which no client has
    more than sqrt(2 * links): a hub never pairs its own neighbours with each other.
    Loops that stay on a client for a step need only mutual pairs and self links.
    """
    selfs = links.where(F.col("src") == F.col("dst")).select(F.col("src").alias("v"), F.col("m").alias("s"))
    proper = links.where(F.col("src") != F.col("dst"))

    ends = proper.select(F.explode(F.array("src", "dst")).alias("v"))
    degree = ends.groupBy("v").agg(F.count(F.lit(1)).alias("degree"))
    ranked = proper.join(degree.select(F.col("v").alias("src"), F.col("degree").alias("src_degree")), "src").join(
        degree.select(F.col("v").alias("dst"), F.col("degree").alias("dst_degree")), "dst"
    )
    src_rank, dst_rank = F.struct("src_degree", "src"), F.struct("dst_degree", "dst")
    rising = ranked.where(src_rank < dst_rank).select(F.col("src").alias("pivot"), F.col("dst").alias("y"), F.col("m").alias("m_out"))
    falling = ranked.where(src_rank > dst_rank).select(F.col("dst").alias("pivot"), F.col("src").alias("x"), F.col("m").alias("m_in"))
    closing = proper.select(F.col("src").alias("y"), F.col("dst").alias("x"), F.col("m").alias("m_back"))
    triangles = (
        rising.join(falling, "pivot")
        .where(F.col("x") != F.col("y"))
        .join(closing, ["x", "y"])
        .select(
            F.explode(F.array("pivot", "x", "y")).alias("client_id"),
            (F.col("m_in") * F.col("m_out") * F.col("m_back")).alias("loops"),
        )
    )

    back = proper.select(F.col("src").alias("dst"), F.col("dst").alias("src"), F.col("m").alias("m_back"))
    mutual = proper.join(back, ["src", "dst"]).select("src", F.col("dst").alias("v"), (F.col("m") * F.col("m_back")).alias("both"))
    via_self = mutual.join(selfs, "v").select(
        F.explode(
            F.array(
                F.struct(F.col("v").alias("client_id"), (2 * F.col("both") * F.col("s")).alias("loops")),
                F.struct(F.col("src").alias("client_id"), (F.col("both") * F.col("s")).alias("loops")),
            )
        ).alias("part")
    ).select("part.client_id", "part.loops")
    only_self = selfs.select(F.col("v").alias("client_id"), (F.col("s") * F.col("s") * F.col("s")).alias("loops"))
    return (
        triangles.unionByName(via_self)
        .unionByName(only_self)
        .groupBy("client_id")
        .agg(F.sum("loops").alias("three_hop_loop_count"))
    )


def client_hop3(clients: DataFrame, relationships: DataFrame) -> DataFrame:
    """3-link walks and loops of every client, zeros where there are none."""
    links = link_counts(relationships)
    return (
        clients.select("client_id")
        .join(three_hop_paths(links), "client_id", "left")
        .join(three_hop_loops(links), "client_id", "left")
        .select(
            "client_id",
            *[fx.or_zero(c).cast("long").alias(c) for c in HOP3_COLUMNS[:2]],
            fx.flag(F.col("three_hop_loop_count") > 0).alias("in_three_hop_loop"),
        )
    )


def three_hop_walks(relationships: DataFrame, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """The walks themselves, one row each: for listing, not for counting."""
    first = relationships.select(F.col("from_client").alias("root_client"), F.col("to_client").alias("hop1_client"))
    second = relationships.select(F.col("from_client").alias("hop1_client"), F.col("to_client").alias("hop2_client"))
    third = relationships.select(F.col("from_client").alias("hop2_client"), F.col("to_client").alias("hop3_client"))
    two = pair_join(
        first, second, ["hop1_client"], ["root_client"], ["hop2_client"],
        counted_grid(first, second, ["hop1_client"], pairs_per_task),
    )
    # walks that reach a client in two steps, from link counts instead of the walks
    into = rows_per_key(first, ["hop1_client"], "inward")
    arriving = second.join(into, "hop1_client").groupBy("hop2_client").agg(F.sum("inward").alias("left_rows"))
    leaving = rows_per_key(third, ["hop2_client"], "right_rows")
    three = pair_join(
        two, third, ["hop2_client"], ["root_client", "hop1_client"], ["hop3_client"],
        hot_grid(arriving, leaving, ["hop2_client"], pairs_per_task),
    )
    return three.select(
        "root_client",
        "hop1_client",
        "hop2_client",
        "hop3_client",
        fx.flag(F.col("hop3_client") == F.col("root_client")).alias("is_three_hop_loop"),
    )


# ---- event proximity ---------------------------------------------------------


def event_calendar(events: DataFrame, horizon: int = EVENT_HORIZON_DAYS) -> DataFrame:
    """For each (underlying, day) with an event in the next `horizon` days: how near, what kind.

    Trades of one underlying and day see the same events, so the range condition is
    answered once per day rather than once per trade and event: events are folded to
    one row per day, each day is spread back over the days that see it, and the
    nearest wins. Rows are bounded by underlyings times days, whatever the trades.
    """
    daily = (
        events.select("underlying", fx.as_day("event_date").alias("event_day"), "importance", "event_type")
        .where(F.col("underlying").isNotNull() & F.col("event_day").isNotNull())
        .groupBy("underlying", "event_day")
        .agg(*_event_kinds())
    )
    seen = daily.select(
        "underlying", "event_day", "high", "earnings", F.explode(F.sequence(F.lit(0), F.lit(horizon))).alias("gap")
    ).withColumn("trade_date", F.date_sub("event_day", F.col("gap")))
    return seen.groupBy("underlying", "trade_date").agg(
        F.min("gap").alias("nearest"), F.max("high").alias("high"), F.max("earnings").alias("earnings")
    )


def _event_kinds():
    return (
        F.max(fx.flag(fx.same_word("importance", "HIGH"))).alias("high"),
        F.max(fx.flag(fx.mentions("event_type", "EARNING"))).alias("earnings"),
    )


def event_proximity(
    trades: DataFrame,
    events: DataFrame,
    horizon: int = EVENT_HORIZON_DAYS,
    unique_trades: bool = False,
    undated_events: bool = False,
) -> DataFrame:
    """Days to the next event per trade and what that horizon holds; 9999 for none.

    `unique_trades=True` (a loaded table with checked keys) saves the closing
    aggregate. `undated_events=True` lets events without a date set the two kind
    flags of all trades on their underlying, as a join without a date range does.
    """
    shaped = trades.select("trade_id", "underlying", fx.as_day("trade_date").alias("trade_date"))
    near = shaped.join(event_calendar(events, horizon), ["underlying", "trade_date"], "left")
    if undated_events:
        near = near.join(_undated_kinds(events), "underlying", "left")
        blind = F.col("trade_date").isNull()
        for kind in ("high", "earnings"):
            extra = F.when(blind, F.col(f"any_{kind}")).otherwise(F.col(f"undated_{kind}"))
            near = near.withColumn(kind, F.greatest(F.col(kind), extra))
    if not unique_trades:
        near = near.groupBy("trade_id").agg(
            F.min("nearest").alias("nearest"), F.max("high").alias("high"), F.max("earnings").alias("earnings")
        )
    return near.select(
        "trade_id",
        F.coalesce("nearest", F.lit(NO_EVENT_DAYS)).alias("days_to_next_event"),
        fx.flag(F.col("nearest") <= 7).alias("event_within_7d"),
        fx.flag(F.col("nearest") <= 3).alias("event_within_3d"),
        fx.or_zero("high").alias("has_high_importance_event"),
        fx.or_zero("earnings").alias("has_earnings_event"),
    )


def _undated_kinds(events: DataFrame) -> DataFrame:
    high = fx.flag(fx.same_word("importance", "HIGH"))
    earnings = fx.flag(fx.mentions("event_type", "EARNING"))
    undated = fx.as_day("event_date").isNull()
    return (
        events.where(F.col("underlying").isNotNull())
        .groupBy("underlying")
        .agg(
            F.max(F.when(undated, high)).alias("undated_high"),
            F.max(F.when(undated, earnings)).alias("undated_earnings"),
            F.max(high).alias("any_high"),
            F.max(earnings).alias("any_earnings"),
        )
    )


# ---- the store ---------------------------------------------------------------


def _scores():
    return (
        fx.rating_score("jurisdiction_risk").alias("jurisdiction_risk_score"),
        fx.rating_score("risk_rating").alias("kyc_risk_score"),
        fx.at_least("notional", fx.ONE_BILLION).alias("notional_ge_1bn"),
        fx.at_least("notional", fx.HALF_BILLION).alias("notional_ge_500m"),
    )


def feature_store(
    base: DataFrame, hop1: DataFrame, hop3: DataFrame, proximity: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Trades with all features and scores; network columns stay NULL for unknown clients.

    The measures are brought together per distinct (trade, client) first, so that the wide
    rows of the trades are shuffled once.
    """
    if existing is not None:
        base = not_yet_in(base, existing, ["trade_id"])
    network = hop1.join(hop3, "client_id", "full")
    keys = base.select("trade_id", "client_id").distinct()
    measures = keys.join(network, "client_id", "left").join(proximity, "trade_id", "left").select(
        F.col("trade_id").alias("same_trade"),
        F.col("client_id").alias("same_client"),
        *HOP1_COLUMNS,
        *HOP3_COLUMNS,
        *PROXIMITY_COLUMNS,
    )
    same = F.col("trade_id").eqNullSafe(F.col("same_trade")) & F.col("client_id").eqNullSafe(F.col("same_client"))
    return base.join(measures, same, "left").select(
        *[c for c in base.columns if c != "label_insider"],
        *HOP1_COLUMNS,
        *HOP3_COLUMNS,
        *PROXIMITY_COLUMNS,
        *_scores(),
        "label_insider",
    )


def feature_store_csv(
    trades: DataFrame, clients: DataFrame, events: DataFrame, instruments: DataFrame, relationships: DataFrame
) -> DataFrame:
    """The full-refresh store straight from the feeds: amounts as doubles, gaps filled."""
    who = clients.select("client_id", "country", "risk_rating")
    what = instruments.select("underlying", "isin", "instrument_id", "sector")
    network = client_hop1(clients, relationships).join(client_hop3(clients, relationships), "client_id", "full")
    near = event_proximity(trades, events, undated_events=True)
    zero = dict.fromkeys(HOP1_COLUMNS + HOP3_COLUMNS + PROXIMITY_COLUMNS, 0) | {"days_to_next_event": NO_EVENT_DAYS}
    landed = [c for c in trades.columns if not c.startswith("_")]
    return (
        trades.select(*landed)
        .join(who.join(network, "client_id", "left"), "client_id", "left")
        .join(what, ["underlying", "isin"], "left")
        .join(near, "trade_id", "left")
        .fillna(zero)
        .select(
            *landed,
            "country",
            "risk_rating",
            "instrument_id",
            "sector",
            *HOP1_COLUMNS,
            *HOP3_COLUMNS,
            *PROXIMITY_COLUMNS,
            *_scores(),
            fx.insider_label().alias("label_insider"),
        )
    )


def investigation_view(store: DataFrame) -> DataFrame:
    """The investigator's columns with the heuristic surveillance score."""
    return store.select(
        "trade_id", "trade_date", "client_id", "client_name", "underlying", "notional", "notional1",
        "jurisdiction_risk", "risk_rating", "days_to_next_event", "has_1hop_link", "in_three_hop_loop",
        "event_within_7d", "label_insider",
        F.lit(0).alias("label_other"),
        fx.heuristic_score().alias("heuristic_surveillance_score"),
    )
