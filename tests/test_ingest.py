import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tradevigil.schemas import FEEDS, RESET_TABLES
from tradevigil.sources import feeds, tables
from tradevigil.streaming.ingest import feature_step, ingest_stream

HEADER = ",".join(FEEDS["trades"].columns)


def land(folder, name, rows):
    """rows: (trade_id, trade_date, notional)"""
    os.makedirs(folder, exist_ok=True)
    place = {c: i for i, c in enumerate(FEEDS["trades"].columns)}
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + "\n")
        for trade_id, day, notional in rows:
            cells = [""] * len(place)
            cells[place["trade_id"]], cells[place["trade_date"]], cells[place["notional"]] = trade_id, day, notional
            f.write(",".join(cells) + "\n")


@pytest.fixture
def landing():
    return tempfile.mkdtemp(prefix="tradevigil-landing-")


def ids(df):
    return sorted(r["trade_id"] for r in df.select("trade_id").collect())


def test_only_new_files_are_loaded(spark, database, landing):
    land(landing, "one.csv", [("t1", "2024-01-01", "10.5"), ("t2", "31-31-2024", "n/a")])
    land(landing, "note.txt", [("no", "", "")])
    first = feeds.load_feed(spark, "trades", landing, database)
    assert ids(first) == ["t1", "t2"]
    assert feeds.load_feed(spark, "trades", landing, database) is None
    land(landing, "TWO.CSV", [("t3", "2024-02-01", "7")])
    assert ids(feeds.load_feed(spark, "trades", landing, database)) == ["t3"]
    rows = feeds.feed_table(spark, "trades", database)
    assert ids(rows) == ["t1", "t2", "t3"]
    assert dict(rows.dtypes)["notional"] == "double" and dict(rows.dtypes)["trade_date"] == "date"
    bad = rows.where("trade_id = 't2'").first()
    assert bad["notional"] is None and bad["trade_date"] is None
    ledger = spark.table(f"{database}.processed_trade_files")
    assert ledger.count() == 2 and ledger.where("load_ts IS NULL").count() == 0


def test_many_files_are_loaded_in_parts(spark, database, landing):
    for i in range(7):
        land(landing, f"f{i}.csv", [(f"t{i}", "2024-01-01", "1")])
    spec = FEEDS["trades"]
    batch = feeds.incremental_load_from_dir(
        spark, landing, f"{database}.{spec.table}", f"{database}.{spec.ledger}", spec.dates, spec.doubles, files_per_load=3
    )
    assert ids(batch) == [f"t{i}" for i in range(7)]
    assert batch.select("_load_id").distinct().count() == 3


def test_run_that_stopped_before_its_ledger_rows(spark, database, landing, monkeypatch):
    land(landing, "one.csv", [("t1", "2024-01-01", "1")])
    with monkeypatch.context() as m:
        m.setattr(feeds, "_enter", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            feeds.load_feed(spark, "trades", landing, database)
    land(landing, "two.csv", [("t2", "2024-01-01", "1")])
    assert ids(feeds.load_feed(spark, "trades", landing, database)) == ["t2"]
    assert ids(feeds.feed_table(spark, "trades", database)) == ["t1", "t2"]


def test_missing_table_reads_as_declared_schema(spark, database):
    empty = feeds.feed_table(spark, "events", database)
    assert empty.count() == 0 and empty.schema == FEEDS["events"].raw_schema


def stream(spark, feed, landing, target, checkpoint=None):
    ingest_stream(spark, feed, landing, checkpoint or tempfile.mkdtemp(prefix="tradevigil-cp-"), target).awaitTermination()


def text_file(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_stream_keeps_every_row_as_batch_does(spark, database, landing, same_rows):
    land(landing, "one.csv", [("t1", "2024-01-01", "10.5"), ("t1", "2024-01-01", "10.5"), ("", "bad", "x"), ("", "", "1")])
    checkpoint = tempfile.mkdtemp(prefix="tradevigil-cp-")
    target = f"{database}.trades_raw"
    stream(spark, "trades", landing, target, checkpoint)
    land(landing, "two.csv", [("t2", "2024-05-05", "5"), ("t3", "2024-02-01", "7")])
    stream(spark, "trades", landing, target, checkpoint)
    stream(spark, "trades", landing, target, checkpoint)
    rows = feeds.feed_table(spark, "trades", database)
    assert rows.count() == 6 and rows.schema == FEEDS["trades"].raw_schema
    # a lost checkpoint replays every file and still adds nothing
    stream(spark, "trades", landing, target)
    spec = FEEDS["trades"]
    batch = feeds.incremental_load_from_dir(
        spark, landing, f"{database}.by_batch", f"{database}.by_batch_files", spec.dates, spec.doubles
    )
    same_rows(feeds.feed_table(spark, "trades", database), batch.drop(*feeds.LOAD_COLUMNS))


def test_batch_and_stream_share_a_table(spark, database, landing):
    target = f"{database}.trades_raw"
    for i, load in enumerate([feeds.load_feed, None, feeds.load_feed, None]):
        land(landing, f"f{i}.csv", [(f"t{i}", "2024-01-01", "1")])
        if load:
            load(spark, "trades", landing, database)
        else:
            stream(spark, "trades", landing, target)
    assert ids(spark.table(target)) == ["t0", "t1", "t2", "t3"]
    assert spark.table(f"{database}.processed_trade_files").count() == 4


@pytest.mark.parametrize("streamed", [False, True])
def test_files_match_columns_by_name(spark, database, landing, streamed):
    target = f"{database}.instruments_raw"

    def load():
        if streamed:
            stream(spark, "instruments", landing, target)
        else:
            feeds.load_feed(spark, "instruments", landing, database)

    text_file(landing, "a.csv", "instrument_id,underlying,isin,sector\ni1,U1,X1,S1\n")
    text_file(landing, "b.csv", "underlying,instrument_id,sector,isin\nU2,i2,S2,X2\n")
    text_file(landing, "empty.csv", "")
    load()
    text_file(landing, "c.csv", "instrument_id,notional\ni3,7\n")
    load()
    text_file(landing, "d.csv", "Instrument_ID,underlying\ni4,U4\n")
    load()
    load()
    found = spark.table(target).select("instrument_id", "underlying", "isin", "sector", "notional").orderBy("instrument_id")
    assert [tuple(r) for r in found.collect()] == [
        ("i1", "U1", "X1", "S1", None), ("i2", "U2", "X2", "S2", None), ("i3", None, None, None, "7"), ("i4", "U4", None, None, None),
    ]
    assert spark.table(f"{database}.processed_instrument_files").count() == 4  # none for the empty one, yet


def test_a_file_without_a_numeric_column_is_loaded(spark, database, landing):
    land(landing, "one.csv", [("t1", "2024-01-01", "10.5")])
    feeds.load_feed(spark, "trades", landing, database)
    text_file(landing, "two.csv", "trade_id\nt2\n")
    feeds.load_feed(spark, "trades", landing, database)
    rows = feeds.feed_table(spark, "trades", database)
    assert dict(rows.dtypes)["notional"] == "double"
    assert sorted(map(tuple, rows.select("trade_id", "notional").collect())) == [("t1", 10.5), ("t2", None)]


def test_load_after_correction_and_after_reset(spark, database, landing):
    target = f"{database}.instruments_raw"
    text_file(landing, "a.csv", "instrument_id,underlying,isin,sector\ni1,U1,old,S\n")
    feeds.load_feed(spark, "instruments", landing, database)
    fixes = spark.createDataFrame([("U1", "new")], "underlying string, isin string")
    tables.correct_table(spark, target, fixes, "underlying", "isin")
    text_file(landing, "b.csv", "instrument_id,underlying,isin,sector\ni2,U2,y,S\n")
    feeds.load_feed(spark, "instruments", landing, database)
    rows = feeds.feed_table(spark, "instruments", database)
    assert sorted(map(tuple, rows.select("instrument_id", "isin").collect())) == [("i1", "new"), ("i2", "y")]
    tables.clear_tables(spark, [f"{database}.{n}" for n in RESET_TABLES])
    assert feeds.load_feed(spark, "instruments", landing, database).count() == 2
    assert feeds.load_feed(spark, "instruments", landing, database) is None
    assert spark.table(f"{database}.processed_instrument_files").count() == 2


def test_streamed_features_in_two_batches_equal_one_batch(spark, database, views, same_rows):
    landing, checkpoint = tempfile.mkdtemp(prefix="tradevigil-l-"), tempfile.mkdtemp(prefix="tradevigil-cp-")
    for name, rows in {
        "clients_raw": views.clients,
        "instruments_raw": views.instruments,
        "events_raw": views.events,
        "feature_client_hop1": views.hop1,
        "feature_client_hop3": views.hop3,
    }.items():
        tables.create_if_missing(rows, f"{database}.{name}")
    for side in ("BUY", "SELL"):
        views.trades.where(F.col("direction") == side).coalesce(1).write.mode("append").option("header", True).csv(landing)
        ingest_stream(
            spark, "trades", landing, checkpoint, f"{database}.trades_raw", then=feature_step(database)
        ).awaitTermination()
    same_rows(spark.table(f"{database}.feature_store_trade_ml"), views.store)
    # first-write-wins: rows of the first batch keep what was known then
    late = views.iq_trades.where("direction = 'SELL'")
    same_rows(spark.table(f"{database}.iq_trades").where("direction = 'SELL'"), late)


def test_table_upkeep(spark, database):
    name = f"{database}.instruments_raw"
    first = spark.createDataFrame([("i1", "INFY", "old"), ("i2", "MASTEK", "old"), ("i3", "OTHER", "same")], "instrument_id string, underlying string, isin string")
    assert tables.create_if_missing(first, name) and not tables.create_if_missing(first, name)
    fixes = spark.createDataFrame([("INFY", "INE009A01021"), ("MASTEK", "INE759A01021")], "underlying string, isin string")
    tables.correct_table(spark, name, fixes, "underlying", "isin")
    assert sorted(r["isin"] for r in spark.table(name).collect()) == ["INE009A01021", "INE759A01021", "same"]
    more = spark.createDataFrame([("i3", "OTHER", "new"), ("i4", "N", "a"), ("i4", "N", "b")], first.schema)
    tables.append_unseen(more, name, ["instrument_id"], unique=True)
    tables.append_unseen(more, name, ["instrument_id"], unique=True)
    assert sorted((r["instrument_id"], r["isin"]) for r in spark.table(name).collect())[2:] == [("i3", "same"), ("i4", "a")]
    tables.replace(spark.table(name).withColumn("extra", F.lit(1)), name, reads_itself=True)
    assert "extra" in spark.table(name).columns and spark.table(name).count() == 4
    cleared = tables.clear_tables(spark, [f"{database}.{n}" for n in RESET_TABLES])
    assert cleared == [name] and spark.table(name).count() == 0 and "extra" in spark.table(name).columns
    assert len(RESET_TABLES) == 23


def test_preview(spark):
    assert [r[0] for r in tables.preview(spark.range(50), 3, by=["id"]).collect()] == [0, 1, 2]
