"""All tables of the solution over one folder of sample parquet files.

Tables that several later steps read are written once per application below the
shared folder, as the solution's own stages do, and read back: that cuts the lineage
at the stage borders, gives the planner real sizes, and lets a lost executor re-read
instead of recompute. The rest are plain plans.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tradevigil.operators import features, graph, investigation
from tradevigil.operators.joins import numbered, ordered_numbers, row_numbers
from tradevigil.session import scratch_path, tune
from tradevigil.sources.sample import feed_view

_stage_roots: dict[tuple[str, str], str] = {}
_written: set[str] = set()


class SurveillanceViews:
    """Feeds and everything derived from them; each property is one table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        run = (spark.sparkContext.applicationId, sf_dir)
        if run not in _stage_roots:
            _stage_roots[run] = scratch_path(spark, "stages")
        self.root = _stage_roots[run]

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A stored table, made and written on first use."""
        path = f"{self.root}/{name}"
        if path not in _written:
            make().write.mode("overwrite").parquet(path)
            _written.add(path)
        return self.spark.read.parquet(path)

    def _feed(self, name: str) -> DataFrame:
        return self.stage(name, lambda: feed_view(self.spark, self.sf_dir, name))

    @cached_property
    def trades(self) -> DataFrame:
        return self._feed("trades_raw")

    @cached_property
    def clients(self) -> DataFrame:
        return self._feed("clients_raw")

    @cached_property
    def events(self) -> DataFrame:
        return self._feed("events_raw")

    @cached_property
    def instruments(self) -> DataFrame:
        return self._feed("instruments_raw")

    @cached_property
    def relationships(self) -> DataFrame:
        return self._feed("relationships_raw")

    def base_plan(self) -> DataFrame:
        return features.feature_trade_base(self.trades, self.clients, self.instruments)

    def hop1_plan(self) -> DataFrame:
        return features.client_hop1(self.clients, self.relationships)

    def hop3_plan(self) -> DataFrame:
        return features.client_hop3(self.clients, self.relationships)

    def proximity_plan(self) -> DataFrame:
        return features.event_proximity(self.trades, self.events)

    def store_plan(self) -> DataFrame:
        return features.feature_store(self.base, self.hop1, self.hop3, self.proximity)

    def iq_trades_plan(self) -> DataFrame:
        return investigation.iq_trades(self.store)

    @cached_property
    def base(self) -> DataFrame:
        return self.stage("feature_trade_base", self.base_plan)

    @cached_property
    def hop1(self) -> DataFrame:
        return self.stage("feature_client_hop1", self.hop1_plan)

    @cached_property
    def hop3(self) -> DataFrame:
        return self.stage("feature_client_hop3", self.hop3_plan)

    @cached_property
    def proximity(self) -> DataFrame:
        return self.stage("feature_event_proximity", self.proximity_plan)

    @cached_property
    def store(self) -> DataFrame:
        return self.stage("feature_store_trade_ml", self.store_plan)

    @cached_property
    def iq_trades(self) -> DataFrame:
        return self.stage("iq_trades", self.iq_trades_plan)

    @cached_property
    def iq_events(self) -> DataFrame:
        return investigation.iq_events(self.events, self.base, self.proximity)

    @cached_property
    def trade_numbers(self) -> DataFrame:
        """Trade ids numbered in their order, for pair rows that are folded to their first and last trade."""
        return self.stage("trade_numbers", lambda: ordered_numbers(self.base, "trade_id"))

    @cached_property
    def numbered_base(self) -> DataFrame:
        return numbered(self.base, self.trade_numbers, "trade_id")

    @cached_property
    def numbered_proximity(self) -> DataFrame:
        return numbered(self.proximity, self.trade_numbers, "trade_id")

    @cached_property
    def event_numbers(self) -> DataFrame:
        """Event ids numbered, for pair rows that are folded per event."""
        return self.stage("event_numbers", lambda: ordered_numbers(self.events, "event_id"))

    @cached_property
    def numbered_events(self) -> DataFrame:
        return numbered(self.events, self.event_numbers, "event_id")

    @cached_property
    def event_rows(self) -> DataFrame:
        """Distinct event rows, as pairs show them, with their number and copies."""
        shown = ["event_id", "underlying", "event_type", "event_date"]
        return self.stage("event_rows", lambda: row_numbers(self.events.select(*shown)))

    @cached_property
    def link_rows(self) -> DataFrame:
        return self.stage("link_rows", lambda: row_numbers(self.relationships.select("from_client", "to_client", "relationship")))

    @cached_property
    def deal_rows(self) -> DataFrame:
        """Distinct trades, as a client network shows them, with their number."""
        shown = ["client_id", "trade_id", "underlying", "trade_date", "notional", "kyc_risk_score", "days_to_next_event"]
        return self.stage("deal_rows", lambda: row_numbers(self.iq_trades.select(*shown)))

    @cached_property
    def numbered_iq_events(self) -> DataFrame:
        return investigation.iq_events(self.numbered_events, self.numbered_base, self.numbered_proximity)

    @cached_property
    def iq_clients(self) -> DataFrame:
        return investigation.iq_clients(self.clients, self.relationships, self.iq_trades)

    @cached_property
    def iq_instruments(self) -> DataFrame:
        return investigation.iq_instruments(self.instruments)

    @cached_property
    def investigation(self) -> DataFrame:
        return features.investigation_view(self.store)

    @cached_property
    def connections(self) -> DataFrame:
        return self.stage("graph_connected_to", lambda: graph.connected_to(self.relationships, self.clients))
