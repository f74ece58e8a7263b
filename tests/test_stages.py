import tempfile

import pytest
from pyspark.sql import functions as F

from tradevigil.operators import investigation, model
from tradevigil.plans.stages import Stages, ingest_and_train, prepare_investigation
from tradevigil.sources import tables


@pytest.fixture(scope="module")
def landing(views):
    folder = tempfile.mkdtemp(prefix="tradevigil-landing-")
    feeds = {
        "trades": views.trades.where("direction = 'BUY'"),
        "clients": views.clients,
        "events": views.events,
        "instruments": views.instruments,
        "relationships": views.relationships,
    }
    for name, rows in feeds.items():
        rows.coalesce(2).write.option("header", True).csv(f"{folder}/{name}")
    return folder


def test_all_stages_in_two_runs(spark, views, database, landing, same_rows):
    stages = Stages(spark, database)
    models = tempfile.mkdtemp(prefix="tradevigil-models-")
    ingest_and_train(stages, landing, models, trees=5, depth=3)
    prepare_investigation(stages)
    bought = views.trades.where("direction = 'BUY'").count()
    assert stages.table("feature_store_trade_ml").count() == bought
    assert stages.table("trade_scores_from_feature_store").count() == bought
    assert stages.table("trade_scores_from_csv_landing").count() == bought
    assert stages.table("model_runs").count() == 2

    views.trades.where("direction = 'SELL'").coalesce(1).write.mode("append").option("header", True).csv(f"{landing}/trades")
    ingest_and_train(stages, landing, models, trees=5, depth=3)
    prepare_investigation(stages)
    same_rows(stages.table("feature_store_trade_ml"), views.store)
    same_rows(stages.table("iq_trades").where("direction = 'SELL'"), views.iq_trades.where("direction = 'SELL'"))
    # rows are only ever added: a client without trades at first keeps its empty row
    clients = stages.table("iq_clients")
    assert views.iq_clients.exceptAll(clients).count() == 0
    extra = clients.exceptAll(views.iq_clients)
    assert extra.where("trade_id IS NOT NULL AND connected_client IS NOT NULL").count() == 0
    assert stages.table("iq_events").count() == views.iq_events.count()
    assert stages.table("model_runs").count() == 4

    # a third run finds nothing new
    before = {n: stages.table(n).count() for n in ("iq_trades", "iq_events", "iq_clients", "iq_instruments", "iq_agent_input")}
    prepare_investigation(stages)
    assert before == {n: stages.table(n).count() for n in before}


def test_refresh_takes_late_events(spark, views, database):
    stages = Stages(spark, database)
    for name, rows in {
        "trades_raw": views.trades,
        "clients_raw": views.clients,
        "instruments_raw": views.instruments,
        "relationships_raw": views.relationships,
        "events_raw": views.events.limit(0),
    }.items():
        tables.create_if_missing(rows, f"{database}.{name}")
    stages.build_features()
    assert stages.table("feature_store_trade_ml").where("days_to_next_event < 9999").count() == 0
    tables.append(views.events, f"{database}.events_raw")
    stages.build_features()
    assert stages.table("feature_store_trade_ml").where("days_to_next_event < 9999").count() == 0
    stages.build_features(refresh=True)
    assert stages.table("feature_store_trade_ml").where("days_to_next_event < 9999").count() > 0
