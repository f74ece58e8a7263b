"""The registered queries: (spark, folder of sample parquet files) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tradevigil.functions.columns import MAX_HEURISTIC_SCORE
from tradevigil.operators import client_state, dimensions, features, graph, investigation, model, report
from tradevigil.operators.joins import named, numbered, ordered_numbers
from tradevigil.plans.views import SurveillanceViews
from tradevigil.schemas import FEEDS
from tradevigil.session import scratch_path
from tradevigil.sources import tables
from tradevigil.sources.feeds import feed_table, load_feed
from tradevigil.sources.sample import feed_view
from tradevigil.streaming.ingest import feature_step
from tradevigil.streaming.ingest import ingest_stream as start_ingest

Query = Callable[[SurveillanceViews], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and days as text, which every engine hands out alike."""
    casts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            casts.append(F.col(field.name).cast("double").alias(field.name))
        elif isinstance(field.dataType, T.DateType):
            casts.append(F.col(field.name).cast("string").alias(field.name))
        else:
            casts.append(F.col(field.name))
    return df.select(*casts)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(QUERIES[name](SurveillanceViews(spark, sf_dir)))


# ---- features ----------------------------------------------------------------


@query
def feature_trade_base(v):
    return v.base_plan()


@query
def feature_trade_base_incremental(v):
    """Sold trades are stored first; the increment adds the rest."""
    sold = features.feature_trade_base(v.trades.where(F.col("direction") == "SELL"), v.clients, v.instruments)
    return sold.unionByName(features.feature_trade_base(v.trades, v.clients, v.instruments, existing=sold))


def _client_sends(v) -> DataFrame:
    """Clients, a third of them sent again later with another rating, and a ninth once more."""
    return feed_view(v.spark, v.sf_dir, "client_sends")


@query
def feature_trade_base_latest(v):
    """Trades with their client as last sent."""
    return features.feature_trade_base(v.trades, dimensions.latest(_client_sends(v), ["client_id"], "sent"), v.instruments)


@query
def feature_trade_base_as_of(v):
    """Trades with their client as known on the trade's day."""
    return features.feature_trade_base(v.trades, _client_sends(v), v.instruments, client_sent="sent")


@query
def client_hop1(v):
    return v.hop1_plan()


@query
def client_hop3(v):
    return v.hop3_plan()


@query
def hop3_walks(v):
    return features.three_hop_walks(v.relationships)


@query
def event_proximity(v):
    return v.proximity_plan()


@query
def feature_store(v):
    return v.store_plan()


@query
def feature_store_csv(v):
    return features.feature_store_csv(v.trades, v.clients, v.events, v.instruments, v.relationships)


@query
def investigation_view(v):
    return v.investigation


# ---- investigation tables ----------------------------------------------------


@query
def iq_trades(v):
    return v.iq_trades_plan()


def _bought(v) -> DataFrame:
    """Stands for an earlier load: the investigated trades that are not sales."""
    return v.iq_trades.where(F.col("direction") != "SELL")


@query
def iq_trades_incremental(v):
    return investigation.iq_trades(v.store, existing=_bought(v), scope="history")


@query
def iq_trades_batch_scope(v):
    return investigation.iq_trades(v.store, existing=_bought(v), scope="batch")


@query
def iq_trades_by_state(v):
    """Sold trades measured with the stored state of all other ones, which are not read for it."""
    state = client_state.stored_form(client_state.client_state(v.store.where(F.col("direction") != "SELL")))
    stored = v.stage("client_state_before", lambda: state)
    return client_state.iq_trades_increment(v.store.where(F.col("direction") == "SELL"), stored)


@query
def client_trade_state(v):
    """The states of sold and other trades, merged."""
    sold = F.col("direction") == "SELL"
    halves = [client_state.stored_form(client_state.client_state(v.store.where(side))) for side in (sold, ~sold)]
    return client_state.merged_state(*halves).drop("firsts")


def _with_trade_ids(v, folded: DataFrame, *columns: str) -> DataFrame:
    return named(folded, v.trade_numbers, "trade_id", columns)


def _with_ids(v, folded: DataFrame, *trades: str) -> DataFrame:
    """Rows folded per event number, with event and trade ids."""
    return _with_trade_ids(v, named(folded, v.event_numbers, "event_id", ["event_id"]), *trades)


@query
def iq_events_grown(v):
    """Pairs that earnings releases and sold trades add to those of all other events and trades."""
    new = F.col("event_type") == "Earnings Release"
    sold, base = F.col("direction") == "SELL", v.numbered_base
    events = v.numbered_events

    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy("event_id").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("trade_id").alias("trades"),
            F.min("trade_id").alias("first_trade"),
            F.max("trade_id").alias("last_trade"),
            F.sum("days_to_next_event").alias("days_sum"),
        )

    halves = investigation.iq_events_delta(
        events.where(new), events.where(~new), base.where(sold), base.where(~sold), v.numbered_proximity, fold=fold
    )
    folded = halves.groupBy("event_id").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("trades").alias("trades"),
        F.min("first_trade").alias("first_trade"),
        F.max("last_trade").alias("last_trade"),
        F.sum("days_sum").alias("days_sum"),
    )
    return _with_ids(v, folded, "first_trade", "last_trade")


@query
def iq_clients_grown(v):
    """Rows that new clients, links of a second kind and sold trades add to the client table."""
    late, kind, sold = F.col("client_id").endswith("7"), F.col("relationship") == "FAMILY", F.col("direction") == "SELL"
    return investigation.iq_clients_delta(
        v.clients.where(late), v.clients.where(~late), v.relationships.where(~kind), v.relationships.where(kind),
        v.iq_trades.where(sold), v.iq_trades.where(~sold),
    )


@query
def iq_events_by_event(v):
    """All trade-event pairs are made; per event they are folded to hand out less."""
    rows = v.event_rows
    events = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).withColumn("event_id", F.col("number"))
    pairs = investigation.iq_events(events, v.numbered_base, v.numbered_proximity)
    folded = pairs.groupBy(F.col("event_id").alias("number")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("trade_id").alias("trades"),
        F.min("trade_id").alias("first_trade"),
        F.max("trade_id").alias("last_trade"),
        F.sum("days_to_next_event").alias("days_sum"),
        F.sum("event_within_7d").alias("within_7d"),
        F.sum("event_within_3d").alias("within_3d"),
        F.sum("has_high_importance_event").alias("high_importance"),
        F.sum("has_earnings_event").alias("earnings"),
    )
    of_events = rows.drop("copies").join(folded, "number").drop("number")
    return _with_trade_ids(v, of_events, "first_trade", "last_trade")


@query
def iq_events_incremental(v):
    """Pairs of all other event types are stored; the increment is the earnings pairs."""
    events, base, proximity = v.numbered_events, v.numbered_base, v.numbered_proximity
    stored = investigation.iq_events(events.where(F.col("event_type") != "Earnings Release"), base, proximity)
    fresh = investigation.iq_events(events, base, proximity, existing=stored)
    folded = fresh.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("trade_id").alias("trades"),
        F.min("trade_id").alias("first_trade"),
        F.max("trade_id").alias("last_trade"),
    )
    return _with_ids(v, folded, "first_trade", "last_trade")


@query
def client_network_by_link(v):
    """All network rows are made; per link and underlying they are folded to hand out less.

    Links and trades stand in the rows by their numbers, by which the rows are folded first.
    """
    kinds = v.stage("event_type_numbers", lambda: ordered_numbers(v.events, "event_type"))
    links, deals = v.link_rows, v.deal_rows
    rows = investigation.client_network(
        links.withColumn("from_client", F.col("number")),
        deals.withColumn("trade_id", F.col("number")),
        numbered(v.events, kinds, "event_type"),
    )
    per_deal = rows.groupBy(F.col("root_client").alias("link"), F.col("trade_id").alias("deal")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("kyc_risk_score").alias("kyc"),
        F.sum("days_to_next_event").alias("days"),
        F.min("event_date").alias("first"),
        F.max("event_date").alias("last"),
        F.max("event_type").alias("type"),
    )
    # the amount is a wide decimal, which is not added up row by row
    amounts = F.col("notional") * F.col("rows").cast("decimal(18,0)")
    own = deals.select(F.col("number").alias("deal"), "trade_id", "underlying", "trade_date", "notional")
    folded = per_deal.join(own, "deal").groupBy("link", "underlying").agg(
        F.sum("rows").alias("n_rows"),
        F.countDistinct("trade_id").alias("trades"),
        F.sum(amounts).cast("double").alias("notional_sum"),
        F.sum("kyc").alias("kyc_sum"),
        F.sum("days").alias("days_sum"),
        F.min("trade_date").alias("first_trade_date"),
        F.min("first").alias("first_event_date"),
        F.max("last").alias("last_event_date"),
        F.max("type").alias("last_event_type"),
    )
    ends = links.select(
        F.col("number").alias("link"), F.col("from_client").alias("root_client"), F.col("to_client").alias("connected_client"), "relationship"
    )
    return named(ends.join(folded, "link").drop("link"), kinds, "event_type", ["last_event_type"])


@query
def iq_clients(v):
    return v.iq_clients


@query
def iq_instruments(v):
    return v.iq_instruments


def _heuristic_scores(v) -> DataFrame:
    """The heuristic score as a classifier: exact, so that any engine can check it."""
    flags = v.store.select("trade_id", "risk_flag")
    share = F.col("heuristic_surveillance_score") / F.lit(float(MAX_HEURISTIC_SCORE))
    return v.investigation.join(flags, "trade_id").select(
        "trade_id",
        "client_id",
        "underlying",
        "risk_flag",
        "label_insider",
        share.alias("predicted_probability"),
        (share > 0.5).cast("int").alias("predicted_label"),
    )


@query
def agent_alerts(v):
    return investigation.agent_alerts(_heuristic_scores(v)).drop("timestamp")


@query
def correct_isin(v):
    fixes = v.instruments.where(F.col("underlying").isin("Brand#1", "Brand#2")).select("underlying").distinct()
    fixes = fixes.withColumn("isin", F.concat(F.lit("FIXED-"), F.substring_index("underlying", "#", -1)))
    return tables.corrected(v.instruments, fixes, "underlying", "isin")


# ---- graph -------------------------------------------------------------------


@query
def graph_nodes_trade(v):
    return graph.trade_nodes(v.iq_trades)


@query
def graph_nodes_client(v):
    return graph.client_nodes(v.iq_clients)


@query
def graph_nodes_instrument(v):
    return graph.instrument_nodes(v.iq_instruments)


@query
def graph_nodes_event(v):
    return graph.event_nodes(v.events)


@query
def graph_edges_connected_to(v):
    return graph.connected_to(v.relationships, v.clients)


@query
def graph_edges_executes(v):
    return graph.executes(v.clients, v.iq_trades)


@query
def graph_edges_references(v):
    return graph.references(v.iq_trades, v.iq_instruments)


@query
def graph_edges_has_event(v):
    return graph.has_event(v.iq_instruments, v.events)


@query
def entity_trade(v):
    return graph.entity("Trade", v.iq_trades)


@query
def entity_client(v):
    return graph.entity("Client", v.iq_clients)


@query
def entity_instrument(v):
    return graph.entity("Instrument", v.iq_instruments)


@query
def entity_event_by_event(v):
    folded = graph.entity("Event", v.numbered_iq_events).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("trade_id").alias("first_trade"),
        F.sum("days_to_next_event").alias("days_sum"),
    )
    return _with_ids(v, folded, "first_trade")


@query
def entity_repeated_keys(v):
    return graph.repeated_keys(graph.entity("Client", v.iq_clients), ["client_id"])


@query
def trade_nodes_by_prefix(v):
    return graph.trade_nodes_by_prefix(graph.trade_nodes(v.iq_trades))


@query
def reachable_1_3(v):
    return graph.reachable(v.connections)


@query
def reachable_walks(v):
    return graph.reachable_walks(v.connections)


@query
def relationship_chain(v):
    return graph.relationship_chain(v.connections)


@query
def event_clusters(v):
    return graph.event_clusters(v.connections, v.iq_trades, v.iq_instruments)


@query
def pre_event_cluster(v):
    return graph.pre_event_cluster(v.connections, v.iq_trades, v.iq_instruments)


@query
def pre_event_cluster_walks(v):
    return graph.pre_event_cluster(v.connections, v.iq_trades, v.iq_instruments, multiplicity="path")


@query
def peer_exposure_listing(v):
    return graph.peer_exposure_listing(v.connections, v.iq_trades, v.iq_instruments)


@query
def potential_insider_cluster(v):
    return graph.potential_insider_cluster(v.connections, v.iq_trades, v.iq_instruments)


@query
def hot_instruments(v):
    return graph.hot_instruments(v.iq_trades)


@query
def coordinated_trading(v):
    return graph.coordinated_instrument_trading(v.connections, v.iq_trades, v.iq_instruments)


@query
def explain_flags(v):
    return graph.explain_flags(v.store)


# ---- reports -----------------------------------------------------------------


@query
def total_exposure(v):
    return report.measure_by(v.iq_trades, [], [report.total_exposure()])


@query
def avg_risk(v):
    return report.measure_by(v.iq_trades, [], [report.avg_risk()])


@query
def cluster_flag(v):
    return report.measure_by(v.iq_trades, [], [report.cluster_flag()])


@query
def cluster_flag_by_client(v):
    return report.measure_by(v.iq_trades, ["client_id"], [report.cluster_flag()])


@query
def measures_by_underlying(v):
    return report.measure_by(v.iq_trades, ["underlying", "jurisdiction_risk"], [report.total_exposure(), report.avg_risk()])


@query
def trade_risk_table(v):
    return report.trade_risk_table(v.iq_trades, low=0.5)


@query
def days_to_event_sum(v):
    return report.measure_by(v.proximity, [], [report.days_to_event_sum()])


@query
def days_to_event_sum_known(v):
    return report.measure_by(v.proximity, [], [report.days_to_event_sum(skip_sentinel=True)])


@query
def network_edges(v):
    return report.network_edges(v.clients, v.relationships, v.iq_trades)


@query
def exposure_by_from_client(v):
    return report.exposure_by_link_end(v.iq_trades, v.relationships, "from_client")


@query
def exposure_by_to_client(v):
    return report.exposure_by_link_end(v.iq_trades, v.relationships, "to_client")


# ---- model -------------------------------------------------------------------


@query
def class_balance(v):
    return model.class_balance(v.store)


@query
def stratified_split(v):
    return model.stratified_split(v.store.select("trade_id", "label_insider"))


@query
def confusion_matrix(v):
    return model.confusion_matrix(_heuristic_scores(v))


@query
def classification_report(v):
    return model.classification_report(model.confusion_matrix(_heuristic_scores(v)))


@query
def roc_auc(v):
    return model.roc_auc(_heuristic_scores(v))


def _forest_scores(v, path: dict) -> DataFrame:
    def scores() -> DataFrame:
        fitted, split = model.train_forest(v.store, path)
        return model.score_rows(fitted, split)

    return v.stage(f"scores_{path['source_mode']}", scores)


@query
def rf_scores(v):
    """Scores of the store path's forest for every trade, likeliest first."""
    scored = _forest_scores(v, model.STORE_PATH)
    return scored.orderBy(F.desc("predicted_probability"), "trade_id")


@query
def rf_scores_csv(v):
    return _forest_scores(v, model.CSV_PATH)


@query
def rf_run_record(v):
    return model.run_record(_forest_scores(v, model.STORE_PATH), model.STORE_PATH)


# ---- ingest ------------------------------------------------------------------


def _database(v) -> str:
    """A new database in the shared folder, for queries that write tables."""
    path = scratch_path(v.spark, "tables")
    name = "tv_" + path.rsplit("-", 1)[-1]
    v.spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def _land(v, folder: str, rows: DataFrame) -> None:
    rows.write.mode("append").option("header", True).csv(folder)


@query
def ingest_incremental(v):
    """Trades landed as CSV in two goes, each loaded; a third load finds nothing new."""
    landing, db = scratch_path(v.spark, "landing"), _database(v)
    for side in ("SELL", "BUY"):
        _land(v, landing, v.trades.where(F.col("direction") == side))
        load_feed(v.spark, "trades", landing, db)
    if load_feed(v.spark, "trades", landing, db) is not None:
        raise RuntimeError("files were loaded twice")
    return feed_table(v.spark, "trades", db)


#: Columns by which `ingest_feeds` hands out the rows of each feed.
_SHOWN = {
    "clients": ("client_id", "name", "country", "risk_rating"),
    "events": ("event_id", "underlying", "event_type", "event_date"),
    "instruments": ("instrument_id", "underlying", "isin", "sector"),
    "relationships": ("from_client", "to_client", "relationship", None),
    "trades": ("trade_id", "client_id", "underlying", "trade_date"),
}


@query
def ingest_feeds(v):
    """All five feeds landed as CSV and loaded twice; the second load finds nothing."""
    landing, db = scratch_path(v.spark, "landing"), _database(v)
    shown = None
    for name, columns in _SHOWN.items():
        _land(v, f"{landing}/{name}", getattr(v, name))
        load_feed(v.spark, name, f"{landing}/{name}", db)
        if load_feed(v.spark, name, f"{landing}/{name}", db) is not None:
            raise RuntimeError("files were loaded twice")
        cells = [(F.col(c) if c else F.lit(None)).cast("string").alias(f"c{i + 1}") for i, c in enumerate(columns)]
        rows = feed_table(v.spark, name, db).select(F.lit(name).alias("feed"), *cells)
        shown = rows if shown is None else shown.unionByName(rows)
    return shown


@query
def ingest_stream(v):
    """The same landing folder as a stream, run to its end after each landing."""
    landing, db = scratch_path(v.spark, "landing"), _database(v)
    checkpoint = scratch_path(v.spark, "stream")
    for side in ("SELL", "BUY"):
        _land(v, landing, v.trades.where(F.col("direction") == side))
        start_ingest(v.spark, "trades", landing, checkpoint, f"{db}.trades_raw").awaitTermination()
    return feed_table(v.spark, "trades", db)


@query
def ingest_stream_features(v):
    """Streamed trades carried on to the investigated trades, batch by batch."""
    landing, db = scratch_path(v.spark, "landing"), _database(v)
    for name, rows in {
        "clients_raw": v.clients,
        "instruments_raw": v.instruments,
        "events_raw": v.events,
        "feature_client_hop1": v.hop1,
        "feature_client_hop3": v.hop3,
    }.items():
        tables.create_if_missing(rows, f"{db}.{name}")
    _land(v, landing, v.trades)
    step = feature_step(db)
    start_ingest(
        v.spark, "trades", landing, scratch_path(v.spark, "stream"), f"{db}.trades_raw", then=step
    ).awaitTermination()
    return v.spark.table(f"{db}.iq_trades")


@query
def clear_tables(v):
    """Row counts after a reset: tables stay, rows go."""
    db = _database(v)
    stored = {"clients_raw": v.clients, "instruments_raw": v.instruments, "events_raw": v.events}
    for name, rows in stored.items():
        tables.create_if_missing(rows, f"{db}.{name}")
    tables.clear_tables(v.spark, [f"{db}.{n}" for n in stored])
    left = [v.spark.table(f"{db}.{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in stored]
    return left[0].unionByName(left[1]).unionByName(left[2])


@query
def preview(v):
    return tables.preview(v.trades.select("trade_id", "client_id", "underlying"), 1000, by=["trade_id"])


