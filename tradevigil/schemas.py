"""Declared schemas, keys and casts of the landed feeds and derived tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = "decimal(20,2)"
UNITS = "decimal(20,4)"
RATE = "decimal(18,6)"

NO_EVENT_DAYS = 9999
EVENT_HORIZON_DAYS = 30


@dataclass(frozen=True)
class FeedSpec:
    """One landed CSV feed: where it lands, where it goes, what is cast."""

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    dates: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    table: str = field(default="")
    ledger: str = field(default="")

    @property
    def landed_schema(self) -> T.StructType:
        """Header order as declared; every cell lands as text."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def raw_schema(self) -> T.StructType:
        kinds = dict.fromkeys(self.dates, T.DateType()) | dict.fromkeys(self.doubles, T.DoubleType())
        return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in self.columns])


FEEDS = {
    f.name: f
    for f in (
        FeedSpec(
            "trades",
            (
                "trade_id", "trade_date", "booking_date", "trade_status", "product_type", "underlying",
                "isin", "currency", "notional", "quantity", "price", "direction", "client_id", "client_name",
                "trader_id", "desk", "legal_entity", "portfolio", "dividend_rate", "financing_spread",
                "maturity_date", "risk_flag", "jurisdiction_risk",
            ),
            ("trade_id",),
            dates=("trade_date", "booking_date", "maturity_date"),
            doubles=("notional", "quantity", "price", "dividend_rate", "financing_spread"),
            table="trades_raw",
            ledger="processed_trade_files",
        ),
        FeedSpec(
            "clients",
            ("client_id", "name", "country", "risk_rating"),
            ("client_id",),
            table="clients_raw",
            ledger="processed_client_files",
        ),
        FeedSpec(
            "events",
            ("event_id", "underlying", "event_type", "event_date", "importance"),
            ("event_id",),
            dates=("event_date",),
            table="events_raw",
            ledger="processed_event_files",
        ),
        FeedSpec(
            "instruments",
            ("instrument_id", "underlying", "isin", "sector"),
            ("instrument_id",),
            table="instruments_raw",
            ledger="processed_instrument_files",
        ),
        FeedSpec(
            "relationships",
            ("from_client", "to_client", "relationship"),
            ("from_client", "to_client", "relationship"),
            table="relationships_raw",
            ledger="processed_relationship_files",
        ),
    )
}

# Keys by which the derived tables take only unseen rows.
TABLE_KEYS = {
    "feature_trade_base": ("trade_id",),
    "feature_store_trade_ml": ("trade_id",),
    "iq_trades": ("trade_id",),
    "iq_events": ("trade_id", "event_id"),
    "iq_clients": ("client_id", "connected_client", "relationship", "trade_id"),
    "iq_instruments": ("instrument_id",),
    "iq_agent_input": ("trade_id",),
}

# The tables a reset empties (fixed values).
RESET_TABLES = (
    tuple(f.ledger for f in FEEDS.values())
    + tuple(f.table for f in FEEDS.values())
    + (
        "feature_trade_base",
        "feature_client_hop1",
        "feature_client_hop3",
        "feature_event_proximity",
        "feature_store_trade_ml",
        "feature_store_trade_ml_csv_pipeline",
        "trade_scores_from_csv_landing",
        "trade_scores_from_feature_store",
        "iq_clients",
        "iq_events",
        "iq_instruments",
        "iq_trades",
        "iq_agent_input",
    )
)
