"""Report measures: cards, the risk table and the client network picture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradevigil.functions import columns as fx
from tradevigil.operators.investigation import live_links
from tradevigil.schemas import NO_EVENT_DAYS


def total_exposure() -> Column:
    """Summed as fixed point, so the order of rows cannot change the last digits."""
    return F.sum(fx.exposure()).cast("double").alias("total_exposure")


def avg_risk() -> Column:
    return F.avg("anomaly_score").alias("avg_risk")


def cluster_flag(max_days: int = fx.NEAR_EVENT_DAYS, min_exposure: float = fx.HALF_BILLION) -> Column:
    exposure = F.sum(fx.exposure())
    suspicious = (exposure > min_exposure) & (F.min("days_to_next_event") <= max_days)
    return F.when(suspicious, F.lit("Suspicious Cluster")).otherwise(F.lit("Normal")).alias("cluster_flag")


def days_to_event_sum(skip_sentinel: bool = False) -> Column:
    """Sum of the days to the next event; the plain figure counts 9999 for "none"."""
    days = F.col("days_to_next_event")
    if skip_sentinel:
        days = F.when(days != NO_EVENT_DAYS, days)
    return F.sum(days).alias("sum_days_to_next_event")


def measure_by(
    df: DataFrame,
    dimensions: Sequence[str],
    measures: Sequence[Column],
    related: DataFrame | None = None,
    via: str = "from_client",
) -> DataFrame:
    """Any measures by any slicer columns.

    With `related` (client links), only trades of clients on that end of a link count.
    A semi join filters them; it cannot multiply a trade.
    """
    if related is not None:
        ends = related.select(F.col(via).alias("client_id")).distinct()
        df = df.join(ends, "client_id", "left_semi")
    return df.groupBy(*dimensions).agg(*measures)


def exposure_by_link_end(iq_trades: DataFrame, relationships: DataFrame, via: str) -> DataFrame:
    return measure_by(iq_trades, ["client_id"], [total_exposure()], related=relationships, via=via)


def trade_risk_table(iq_trades: DataFrame, low: float = 0.03, high: float = 1.0) -> DataFrame:
    """Anomaly score per trade and client, highlighted between two shares of its range."""
    scores = iq_trades.groupBy("trade_id", "client_id").agg(F.sum("anomaly_score").alias("sum_anomaly_score"))
    least = scores.select(F.min("sum_anomaly_score")).scalar()
    most = scores.select(F.max("sum_anomaly_score")).scalar()
    span = most - least
    inside = (F.col("sum_anomaly_score") >= least + F.lit(low) * span) & (
        F.col("sum_anomaly_score") <= least + F.lit(high) * span
    )
    return scores.select("trade_id", "client_id", "sum_anomaly_score", fx.flag(inside).alias("highlight"))


def network_edges(clients: DataFrame, relationships: DataFrame, iq_trades: DataFrame) -> DataFrame:
    """Distinct (client, connected client) with the number of client-table rows as weight.

    A client's rows are its links times its trades (once where it has none), so the
    weight is a product of two counts; the rows themselves are not made.
    """
    known = clients.select("client_id").distinct()
    links = (
        live_links(relationships, iq_trades)
        .groupBy(F.col("from_client").alias("client_id"), F.col("to_client").alias("connected_client"))
        .agg(F.count(F.lit(1)).alias("links"))
        .join(known, "client_id", "left_semi")
    )
    own = iq_trades.select("client_id", "trade_id").distinct().groupBy("client_id").agg(F.count(F.lit(1)).alias("trades"))
    return links.join(own, "client_id", "left").select(
        "client_id", "connected_client", (F.col("links") * F.coalesce("trades", F.lit(1))).alias("weight")
    )
