"""The ordered stages over catalog tables; each reads tables and writes tables.

A failed stage raises and so stops what follows. Scheduling and retries are left to
whatever runs these functions. Stages that add rows read new files of their sources alone
and enter them in the table `stage_runs`, so a run that stopped is taken up where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradevigil.operators import client_state, dimensions, features, investigation, model
from tradevigil.operators.joins import not_yet_in, repeats_settled
from tradevigil.schemas import EVENT_HORIZON_DAYS, FEEDS, TABLE_KEYS
from tradevigil.session import tune
from tradevigil.sources import tables
from tradevigil.sources.feeds import LOAD_COLUMNS, feed_sends, feed_table, load_feed
from tradevigil.sources.runs import Batch, StageLedger, keep_only, write_batch

#: Segments of the clients' stored state from which they are merged into one.
MOST_SEGMENTS = 64


class Stages:
    """Runs the stages in one database of the session's catalog."""

    def __init__(self, spark: SparkSession, database: str = "default"):
        self.spark = tune(spark)
        self.database = database
        self.ledger = StageLedger(spark, f"{database}.stage_runs")
        tables.recover_all(spark, database)

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def _existing(self, name: str) -> DataFrame | None:
        return self.table(name) if self.spark.catalog.tableExists(self._name(name)) else None

    def feed(self, name: str) -> DataFrame:
        return feed_table(self.spark, name, self.database)

    def _grow(self, name: str, df: DataFrame) -> None:
        """Keyed append; creates the table on the first run."""
        tables.append_unseen(df, self._name(name), TABLE_KEYS[name])

    def _add(self, name: str, df: DataFrame, seen: bool) -> None:
        """Append a batch's rows; those the table holds are left out where some can be (`seen`)."""
        existing = self._existing(name)
        if seen and existing is not None:
            df = not_yet_in(df, existing, list(TABLE_KEYS[name]))
        tables.append(df, self._name(name))

    def _new(self, source: str, batch: Batch) -> DataFrame:
        """The batch's rows of a feed or derived table."""
        return self._rows(source, lambda name: self.ledger.rows(name, batch))

    def _old(self, source: str, batch: Batch) -> DataFrame:
        """Rows of a feed or derived table that the batch's stage took before."""
        return self._rows(source, lambda name: self.ledger.earlier(name, batch))

    def _rows(self, source: str, read) -> DataFrame:
        feed = FEEDS.get(source)
        name = self._name(feed.table if feed else source)
        if feed and not self.spark.catalog.tableExists(name):
            return self.feed(source)
        return read(name).drop(*LOAD_COLUMNS)

    def _batches(self, stage: str, *sources: str) -> list[Batch]:
        return self.ledger.batches(stage, [self._name(FEEDS[s].table if s in FEEDS else s) for s in sources])

    def dimension(self, name: str) -> DataFrame:
        """A feed of keyed rows, each key once: as last sent."""
        return dimensions.latest(feed_sends(self.spark, name, self.database), FEEDS[name].key, "sent")

    # -- ingest ----------------------------------------------------------------

    def load_feeds(self, landing: str) -> None:
        for name in FEEDS:
            load_feed(self.spark, name, f"{landing}/{name}", self.database)

    # -- features --------------------------------------------------------------

    def build_features(self, refresh: bool = False) -> None:
        """Base, network, proximity and store; `refresh=True` recomputes stored rows too."""
        clients, links = self.dimension("clients"), self.feed("relationships")
        if refresh:
            base = features.feature_trade_base(self.feed("trades"), clients, self.dimension("instruments"))
            tables.replace(base, self._name("feature_trade_base"))
        else:
            self.grow_base()
        tables.replace(features.client_hop1(clients, links), self._name("feature_client_hop1"))
        tables.replace(features.client_hop3(clients, links), self._name("feature_client_hop3"))
        tables.replace(features.event_proximity(self.feed("trades"), self.feed("events")), self._name("feature_event_proximity"))
        if refresh:
            tables.replace(self._store(self.table("feature_trade_base"), self.table("feature_event_proximity")), self._name("feature_store_trade_ml"))
        else:
            self.grow_store()

    def grow_base(self, unique: bool = False) -> None:
        """Enriched trades of newly loaded files. Only the keys of stored ones are read.

        With `unique`, a key that comes several times in the new files is taken once.
        """
        clients, instruments = self.dimension("clients"), self.dimension("instruments")
        for batch in self._batches("feature_trade_base", "trades"):
            rows = self._new("trades", batch)
            if unique:
                rows = repeats_settled(rows, ["trade_id"])
            stored = self._existing("feature_trade_base")
            tables.append(features.feature_trade_base(rows, clients, instruments, stored), self._name("feature_trade_base"))
            self.ledger.finish("feature_trade_base", batch)
        if self._existing("feature_trade_base") is None:
            tables.append(features.feature_trade_base(self.feed("trades"), clients, instruments), self._name("feature_trade_base"))

    def _store(self, base: DataFrame, proximity: DataFrame) -> DataFrame:
        return features.feature_store(base, self.table("feature_client_hop1"), self.table("feature_client_hop3"), proximity)

    def grow_store(self, proximity_of_batch: bool = False) -> None:
        """Feature rows of new enriched trades.

        With `proximity_of_batch`, days to events are found for the new trades alone and stored
        as well, from events on their underlyings within their days; else they are read.
        """
        for batch in self._batches("feature_store_trade_ml", "feature_trade_base"):
            base, seen = self._new("feature_trade_base", batch), batch.again or batch.rewritten
            if proximity_of_batch:
                near = features.event_proximity(base, self._events_near(base), unique_trades=True)
                self._add_proximity(near, seen)
            else:
                near = self.table("feature_event_proximity").join(base.select("trade_id"), "trade_id", "left_semi")
            self._add("feature_store_trade_ml", self._store(base, near), seen)
            self.ledger.finish("feature_store_trade_ml", batch)
        if self._existing("feature_store_trade_ml") is None:
            tables.append(self._store(self.table("feature_trade_base").limit(0), features.event_proximity(self.feed("trades").limit(0), self.feed("events"))), self._name("feature_store_trade_ml"))

    def _add_proximity(self, near: DataFrame, seen: bool) -> None:
        stored = self._existing("feature_event_proximity")
        if seen and stored is not None:
            near = not_yet_in(near, stored, ["trade_id"])
        tables.append(near, self._name("feature_event_proximity"))

    def _events_near(self, trades: DataFrame) -> DataFrame:
        """Events that some of the trades can see: on their underlyings, from their first day to the horizon of their last."""
        first, last = trades.agg(F.min("trade_date"), F.max("trade_date")).first()
        events = self.feed("events").join(trades.select("underlying").distinct(), "underlying", "left_semi")
        day = F.col("event_date").try_cast("date")
        return events.where(day.between(F.lit(first), F.date_add(F.lit(last), EVENT_HORIZON_DAYS)))

    def build_csv_store(self) -> None:
        store = features.feature_store_csv(*(self.feed(n) for n in ("trades", "clients", "events", "instruments", "relationships")))
        tables.replace(store, self._name("feature_store_trade_ml_csv_pipeline"))

    # -- model -----------------------------------------------------------------

    def train(self, path: dict, model_dir: str, trees: int | None = None, depth: int | None = None) -> None:
        """Train on a store, write scores, add a run record, save the model."""
        from_csv = path["source_mode"] == "csv_landing"
        source = "feature_store_trade_ml_csv_pipeline" if from_csv else "feature_store_trade_ml"
        target = "trade_scores_from_csv_landing" if from_csv else "trade_scores_from_feature_store"
        fitted, split = model.train_forest(self.table(source), path, trees, depth)
        tables.replace(model.score_rows(fitted, split), self._name(target))
        tables.append(model.run_record(self.table(target), path, trees, depth), self._name("model_runs"))
        fitted.write().overwrite().save(f"{model_dir}/{path['run_name']}")

    # -- investigation ---------------------------------------------------------

    def raise_alerts(self) -> None:
        scores = self.table("trade_scores_from_feature_store")
        self._grow("iq_agent_input", investigation.agent_alerts(scores))

    def build_investigation(self, scope: str = "history") -> None:
        """The investigation tables, each grown by what is new in its sources; none is read to find out."""
        self.grow_iq_trades(scope)
        self.grow_iq_events()
        self.grow_iq_clients()
        self._grow("iq_instruments", investigation.iq_instruments(self.feed("instruments")))

    def _state(self, without: str) -> DataFrame | None:
        """The clients' stored sums but for one batch; None where nothing is stored."""
        name = self._name("iq_client_state")
        if not self.spark.catalog.tableExists(name):
            return None
        return self.spark.table(name).where(F.col("_batch") != without).drop("_batch")

    def grow_iq_trades(self, scope: str = "history") -> None:
        """New feature rows, measured with the stored state of their clients, which then takes them in."""
        state_name = self._name("iq_client_state")
        for batch in self._batches("iq_trades", "feature_store_trade_ml"):
            fresh, existing = self._new("feature_store_trade_ml", batch), self._existing("iq_trades")
            state = client_state.batch_state(fresh)
            if batch.rewritten or scope == "batch":
                rows = investigation.iq_trades(fresh, existing if batch.rewritten or batch.again else None, scope)
            else:
                rows = client_state.iq_trades_increment(fresh, self._state(batch.id), state)
            self._add("iq_trades", rows, batch.again and not batch.rewritten)
            write_batch(client_state.stored_form(state), state_name, batch.id)
            if batch.rewritten:  # it holds all rows there are
                keep_only(self.spark, state_name, batch.id)
            self.ledger.finish("iq_trades", batch)
        self._merge_state(state_name)
        if self._existing("iq_trades") is None:
            tables.append(investigation.iq_trades(self.table("feature_store_trade_ml")), self._name("iq_trades"))

    def _merge_state(self, name: str) -> None:
        """Many small segments into one, so that an increment reads few files."""
        if not self.spark.catalog.tableExists(name):
            return
        segments = [r["partition"].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()]
        if len(segments) <= MOST_SEGMENTS:
            return
        stored = self.spark.table(name)
        merged = client_state.merged_state(stored.drop("_batch")).withColumn("_batch", F.lit("merged"))
        tables.replace(merged.select(*stored.columns), name, reads_itself=True)

    def grow_iq_events(self) -> None:
        """Pairs of new trades with all events and of old trades with new events."""
        stage, base, proximity = "iq_events", "feature_trade_base", self.table("feature_event_proximity")
        for batch in self._batches(stage, base, "events"):
            if batch.rewritten:
                rows = investigation.iq_events(self.feed("events"), self.table(base), proximity)
            else:
                old_events = self._old("events", batch)
                new_events = not_yet_in(self._new("events", batch), old_events, ["event_id"])
                rows = investigation.iq_events_delta(
                    new_events, old_events, self._new(base, batch), self._old(base, batch), proximity
                )
            self._add(stage, rows, batch.again or batch.rewritten)
            self.ledger.finish(stage, batch)
        if self._existing(stage) is None:
            tables.append(investigation.iq_events(self.feed("events"), self.table(base), proximity), self._name(stage))

    def grow_iq_clients(self) -> None:
        """Rows that new clients, new links and new trades add."""
        stage, sources = "iq_clients", ("clients", "relationships", "iq_trades")
        for batch in self._batches(stage, *sources):
            if batch.rewritten:
                rows = investigation.iq_clients(self.feed("clients"), self.feed("relationships"), self.table("iq_trades"))
            else:
                sides = [side for s in sources for side in (self._new(s, batch), self._old(s, batch))]
                rows = investigation.iq_clients_delta(*sides)
            self._add(stage, rows, batch.again or batch.rewritten)
            self.ledger.finish(stage, batch)
        if self._existing(stage) is None:
            tables.append(investigation.iq_clients(self.feed("clients"), self.feed("relationships"), self.table("iq_trades")), self._name(stage))


def ingest_and_train(stages: Stages, landing: str, model_dir: str, **forest) -> None:
    """Landed CSV files to features and both trained models."""
    stages.load_feeds(landing)
    stages.build_csv_store()
    stages.train(model.CSV_PATH, model_dir, **forest)
    stages.build_features()
    stages.train(model.STORE_PATH, model_dir, **forest)


def prepare_investigation(stages: Stages) -> None:
    """Alerts, then the investigation tables."""
    stages.raise_alerts()
    stages.build_investigation()
