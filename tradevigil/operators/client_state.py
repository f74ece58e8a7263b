"""Stored sums of a client's trades that merge: what an increment needs of the past.

One row per (client, underlying): trades, sum and number of amounts, and those of the
pair's trades that were among the client's first ones. States of different trades add up, so
each load stores its own small state, and a new trade is measured without reading old ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tradevigil.functions import columns as fx
from tradevigil.operators.investigation import (
    EARLIER_ROWS,
    first_trades_of,
    listed_firsts,
    measured_trades,
    pair_stats,
    with_place,
)
from tradevigil.session import scratch_path

PAIR = ("client_id", "underlying")
SUMS = ("pair_trades", "pair_sum", "pair_amounts")


def merged_state(*states: DataFrame) -> DataFrame:
    """One state of all the trades; of a pair's first trades as many as can matter."""
    together = reduce(lambda a, b: a.unionByName(b), states)
    firsts = F.slice(F.sort_array(F.flatten(F.collect_list("firsts"))), 1, EARLIER_ROWS)
    return together.groupBy(*PAIR).agg(*[F.sum(c).alias(c) for c in SUMS], firsts.alias("firsts"))


def client_state(trades: DataFrame) -> DataFrame:
    """The state of these trades. Sums and first trades are cut in the map tasks, then merged."""
    place = ["row_place"] if "row_place" in trades.columns else []
    amount = F.col("notional").cast("float")
    sums = trades.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("pair_trades"),
        F.sum(amount.cast("double")).alias("pair_sum"),
        F.count(amount).alias("pair_amounts"),
    )
    firsts = first_trades_of(trades.select(*PAIR, "trade_date", "trade_id", *place))
    firsts = firsts.groupBy(*PAIR).agg(F.collect_list(F.struct("trade_date", "trade_id", *place)).alias("firsts"))
    kind = firsts.schema["firsts"].dataType
    zeros = [F.lit(0).cast(sums.schema[c].dataType).alias(c) for c in SUMS]
    return merged_state(
        sums.withColumn("firsts", F.array().cast(kind)), firsts.select(*PAIR, *zeros, "firsts")
    )


def stored_form(state: DataFrame) -> DataFrame:
    """Without the places of rows in files, which mean nothing to later loads."""
    return state.withColumn("firsts", F.transform("firsts", lambda f: F.struct(f["trade_date"].alias("trade_date"), f["trade_id"].alias("trade_id"))))


def _placeable(state: DataFrame, like: DataFrame) -> DataFrame:
    """A stored state beside one with places: earlier trades come first among equals."""
    kind = like.schema["firsts"].dataType
    if "row_place" not in kind.elementType.names:
        return state
    none = F.lit(None).cast(kind.elementType["row_place"].dataType)
    entry = lambda f: F.struct(f["trade_date"].alias("trade_date"), f["trade_id"].alias("trade_id"), none.alias("row_place"))
    return state.withColumn("firsts", F.transform("firsts", entry))


def state_stats(state: DataFrame) -> DataFrame:
    """The statistics `measured_trades` takes: per pair its trades, the client's average and first trades."""
    averages = state.groupBy("client_id").agg(fx.ratio(F.sum("pair_sum"), F.sum("pair_amounts")).alias("client_average"))
    firsts = first_trades_of(state.select(*PAIR, F.explode("firsts").alias("f")).select(*PAIR, "f.*"))
    return pair_stats(state.select(*PAIR, "pair_trades"), averages, listed_firsts(firsts))


def _kept(state: DataFrame) -> DataFrame:
    """A state written below the shared folder, as several steps read it."""
    path = scratch_path(state.sparkSession, "state")
    state.write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def batch_state(fresh: DataFrame) -> DataFrame:
    """The state of new trades with their places, made and stored once for all that need it."""
    return _kept(client_state(with_place(fresh)))


def iq_trades_increment(fresh: DataFrame, state: DataFrame | None, batch: DataFrame | None = None) -> DataFrame:
    """`fresh` trades measured against all trades: their own and those the stored state sums up.

    Equals `iq_trades` over all trades, of these rows. Old trades are not read; of the state, the
    clients of the new trades. Trades that came before sort first among equal day and id.
    `batch` is the `batch_state` of `fresh`, where it is made already; without a `state` it is all there is.
    """
    placed = with_place(fresh)
    own = client_state(placed) if batch is None else batch
    if state is None:
        return measured_trades(placed, state_stats(own))
    touched = fresh.select(F.col("client_id").alias("touched_client")).distinct()
    known = state.select(*PAIR, *SUMS, "firsts").join(touched, F.col("client_id").eqNullSafe(F.col("touched_client")), "left_semi")
    merged = merged_state(_placeable(known, own), own)
    return measured_trades(placed, state_stats(merged if batch is None else _kept(merged)))
