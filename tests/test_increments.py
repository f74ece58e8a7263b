"""Increments by stored state and delta joins, the stage ledger, swaps, and rows sent twice."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from test_investigation import COLUMNS, windows, with_hot_client

from tradevigil.operators import client_state, dimensions, features, investigation
from tradevigil.plans import stages as stage_module
from tradevigil.plans.stages import Stages
from tradevigil.sources import feeds, tables
from tradevigil.sources.runs import StageLedger, write_batch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def state_of(trades):
    return client_state.stored_form(client_state.client_state(trades))


@pytest.fixture(scope="module")
def third(views):
    """Trades in three lots by a hash of the id."""
    store = with_hot_client(views.store)
    lot = F.pmod(F.xxhash64("trade_id", F.lit(5)), F.lit(3))
    return store, [store.where(lot == i) for i in range(3)]


def test_measures_by_state_equal_windows_over_all_trades(third, same_rows):
    store, (a, b, c) = third
    state = client_state.merged_state(state_of(a), state_of(b))
    got = client_state.iq_trades_increment(c, state).select(*COLUMNS)
    same_rows(got, windows(store).join(c.select("trade_id"), "trade_id", "left_semi"))
    # rows that do not come straight from files, and segments that were not merged
    made = client_state.iq_trades_increment(c.join(c.select("trade_id"), "trade_id"), state_of(a).unionByName(state_of(b)))
    same_rows(made.select(*COLUMNS), got)


def test_states_add_up(third, same_rows):
    store, (a, b, c) = third
    whole, parts = state_of(store), client_state.merged_state(state_of(a), client_state.merged_state(state_of(c), state_of(b)))
    same_rows(whole.drop("firsts"), parts.drop("firsts"))
    firsts = [client_state.state_stats(s).select("client_id", "first_trades").distinct() for s in (whole, parts)]
    same_rows(*firsts)


def test_rows_repeated_in_a_batch_are_counted_one_by_one(spark, views):
    one = views.store.limit(1).withColumn("client_id", F.lit("c"))

    def lot(ids, day):
        keys = spark.createDataFrame([(i,) for i in ids], "new_id string")
        return one.crossJoin(keys).withColumn("trade_id", F.col("new_id")).drop("new_id").withColumn("trade_date", F.lit(day))

    old = state_of(lot(["a", "b"], dt.date(2024, 1, 1)))
    path = tempfile.mkdtemp(prefix="tradevigil-rows-")
    lot(["x", "x", "x", "y"], dt.date(2024, 1, 2)).coalesce(1).write.mode("overwrite").parquet(path)
    for fresh in (spark.read.parquet(path), lot(["x", "x", "x", "y"], dt.date(2024, 1, 2))):
        got = client_state.iq_trades_increment(fresh, old).select("trade_id", "rolling_frequency").collect()
        assert sorted(map(tuple, got)) == [("x", 3), ("x", 4), ("x", 5), ("y", 6)]


def test_an_increment_reads_new_trades_and_state_alone(spark, views, third):
    _, (a, b, c) = third
    folder = tempfile.mkdtemp(prefix="tradevigil-lots-")
    a.unionByName(b).write.parquet(f"{folder}/old")
    c.write.parquet(f"{folder}/new")
    state_of(spark.read.parquet(f"{folder}/old")).write.parquet(f"{folder}/state")
    text = plan(client_state.iq_trades_increment(spark.read.parquet(f"{folder}/new"), spark.read.parquet(f"{folder}/state")))
    assert f"{folder}/old" not in text and f"{folder}/new" in text and f"{folder}/state" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text


@pytest.mark.parametrize("seed", [1, 2])
def test_event_delta_equals_the_rebuild(views, same_rows, seed):
    events = views.events.where(F.pmod(F.xxhash64("event_id"), F.lit(20)) == 0)
    events = events.withColumn("underlying", F.when(F.pmod(F.xxhash64("event_id", F.lit(3)), F.lit(9)) == 0, F.lit("NOBODY")).otherwise(F.col("underlying")))
    new_e = F.pmod(F.xxhash64("event_id", F.lit(seed)), F.lit(4)) == 0
    new_t = F.pmod(F.xxhash64("trade_id", F.lit(seed)), F.lit(5)) == 0
    old = investigation.iq_events(events.where(~new_e), views.base.where(~new_t), views.proximity)
    delta = investigation.iq_events_delta(events.where(new_e), events.where(~new_e), views.base.where(new_t), views.base.where(~new_t), views.proximity, 200)
    same_rows(old.unionByName(delta), investigation.iq_events(events, views.base, views.proximity))


def test_client_delta_equals_the_rebuild(spark, same_rows):
    ids = [*"ABCDEFGH", None]
    clients = [(c,) for c in ids]
    links = [(a, b, r) for i, a in enumerate(ids) for j, b in enumerate(ids) for r in "FS" if (i * 5 + j * 3 + ord(r)) % 7 == 0]
    trades = [(c, f"t{i}{k}") for i, c in enumerate(ids) if i % 3 for k in range(i % 4)]
    schemas = ("client_id string", "from_client string, to_client string, relationship string", "client_id string, trade_id string")
    for seed in range(2):
        sides = []
        for rows, schema in zip((clients, links, trades), schemas, strict=True):
            new = [r for n, r in enumerate(rows) if (n * 7 + seed * 3) % 5 < 2 + seed % 2]
            sides += [spark.createDataFrame([r for r in rows if r in new], schema), spark.createDataFrame([r for r in rows if r not in new], schema)]
        old = investigation.iq_clients(sides[1], sides[3], sides[5])
        every = investigation.iq_clients(*(spark.createDataFrame(r, s) for r, s in zip((clients, links, trades), schemas, strict=True)))
        same_rows(investigation.iq_clients_delta(*sides, pairs_per_task=1), every.exceptAll(old))


TABLES = ("feature_trade_base", "feature_store_trade_ml", "feature_event_proximity", "iq_trades", "iq_events", "iq_clients")
STEPS = ("grow_base", "grow_store", "grow_iq_trades", "grow_iq_events", "grow_iq_clients")


def feed_tables(spark, views, database, side):
    few = F.pmod(F.xxhash64("event_id"), F.lit(30)) == 0
    kind = F.col("event_type") == "view"
    tables.append(views.trades.where(F.col("direction") == side), f"{database}.trades_raw")
    tables.append(views.events.where(few & (kind if side == "BUY" else ~kind)), f"{database}.events_raw")
    for name in ("clients", "instruments", "relationships"):
        tables.create_if_missing(getattr(views, name), f"{database}.{name}_raw")
    tables.create_if_missing(views.hop1, f"{database}.feature_client_hop1")
    tables.create_if_missing(views.hop3, f"{database}.feature_client_hop3")


def grow(stages, killed=None):
    for step in STEPS:
        given = {"proximity_of_batch": True} if step == "grow_store" else {}
        if killed:
            with killed.context() as m, pytest.raises(RuntimeError, match="killed"):
                m.setattr(StageLedger, "finish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
                getattr(stages, step)(**given)
        getattr(stages, step)(**given)


def contents(stages):
    rows = {n: sorted(map(tuple, stages.table(n).collect()), key=repr) for n in TABLES}
    state = client_state.merged_state(stages.table("iq_client_state").drop("_batch"))
    # a pair may keep more first trades than matter; those of the client are what counts
    firsts = client_state.state_stats(state).select("client_id", "first_trades").distinct()
    return rows | {n: sorted(map(tuple, df.collect()), key=repr) for n, df in {"state": state.drop("firsts"), "firsts": firsts}.items()}


def test_a_run_that_stops_at_any_stage_is_taken_up(spark, views, database, monkeypatch):
    """Each stage of the second run killed before it is entered as done: the tables of an undisturbed run."""
    other = f"{database}_k"
    spark.sql(f"CREATE DATABASE {other} LOCATION '{tempfile.mkdtemp(prefix='tradevigil-db-')}'")
    clean, killed = Stages(spark, database), Stages(spark, other)
    for side in ("BUY", "SELL"):
        for stages in (clean, killed):
            feed_tables(spark, views, stages.database, side)
        grow(clean)
        grow(killed, monkeypatch if side == "SELL" else None)
    before = contents(clean)
    assert contents(killed) == before
    measured = [t.where("direction = 'SELL'").select(*COLUMNS) for t in (clean.table("iq_trades"), views.iq_trades)]
    assert measured[0].exceptAll(measured[1]).count() == 0 == measured[1].exceptAll(measured[0]).count()
    # a table written anew is recognised, and its rows are not added again; the segments merge
    tables.replace(clean.table("feature_store_trade_ml"), f"{database}.feature_store_trade_ml", reads_itself=True)
    monkeypatch.setattr(stage_module, "MOST_SEGMENTS", 0)
    clean.grow_iq_trades()
    assert contents(clean) == before
    assert clean.ledger.batches("iq_trades", [f"{database}.feature_store_trade_ml"]) == []


def test_many_segments_are_merged(spark, database, third, monkeypatch, same_rows):
    name = f"{database}.iq_client_state"
    for i, lot in enumerate(third[1]):
        write_batch(state_of(lot), name, f"batch{i}")
    write_batch(state_of(third[1][2]), name, "batch2")  # a repeated batch takes its own place
    monkeypatch.setattr(stage_module, "MOST_SEGMENTS", 2)
    Stages(spark, database)._merge_state(name)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["_batch=merged"]
    same_rows(spark.table(name).drop("_batch", "firsts"), state_of(third[0]).drop("firsts"))
    write_batch(state_of(third[1][0]), name, "late")
    Stages(spark, database)._merge_state(name)
    assert spark.table(name).where("_batch = 'merged'").agg(F.sum("pair_trades")).first()[0] == third[0].count()


def test_a_partitioned_table_replaced_from_itself(spark, database):
    name = f"{database}.p"
    spark.range(30).withColumn("p", (F.col("id") % 3).cast("string")).write.partitionBy("p").saveAsTable(name)
    rows = spark.table(name)
    moved = rows.where("p <> '1'").withColumn("p", F.when(F.col("id") % 2 == 0, F.lit("9")).otherwise(F.col("p"))).withColumn("extra", F.col("id") * 2)
    tables.replace(moved.select("id", "extra", "p"), name, reads_itself=True)
    assert sorted((r["id"], r["extra"], r["p"]) for r in spark.table(name).collect()) == [
        (i, 2 * i, "9" if i % 2 == 0 else str(i % 3)) for i in range(30) if i % 3 != 1
    ]
    tables.replace(spark.table(name).where("id < 0"), name, reads_itself=True)
    assert spark.table(name).count() == 0 and spark.sql(f"SHOW PARTITIONS {name}").count() == 0


@pytest.fixture
def instruments(spark, database):
    folder, name = tempfile.mkdtemp(prefix="tradevigil-l-"), f"{database}.instruments_raw"
    for i in range(3):
        with open(os.path.join(folder, f"{i}.csv"), "w") as f:
            f.write(f"instrument_id,underlying,isin,sector\ni{i},U{i},old,S\nj{i},V,old,S\n")
        feeds.load_feed(spark, "instruments", folder, database)
    return name


@pytest.mark.parametrize("stop", ["_beside", "recover", "_remove"])
def test_a_correction_that_stops_leaves_old_or_new_rows(spark, instruments, monkeypatch, stop):
    fixes = spark.createDataFrame([("U0", "new"), ("U2", "new")], "underlying string, isin string")
    own, calls = getattr(tables, stop), []

    def stopping(*given, **named):
        calls.append(given)
        if stop != "recover" or len(calls) > 1:  # the first call only looks for an older swap
            raise RuntimeError("killed")
        return own(*given, **named)

    with monkeypatch.context() as m:
        m.setattr(tables, stop, stopping)
        with pytest.raises(RuntimeError, match="killed"):
            tables.correct_table(spark, instruments, fixes, "underlying", "isin")

    def isins():
        return sorted((r["instrument_id"], r["isin"]) for r in spark.table(instruments).collect())

    new = [("i0", "new"), ("i1", "old"), ("i2", "new"), ("j0", "old"), ("j1", "old"), ("j2", "old")]
    old = [(i, "old") for i, _ in new]
    assert isins() == (new if stop == "_remove" else old)
    tables.recover_all(spark, instruments.split(".")[0])
    assert isins() == (old if stop == "_beside" else new)
    tables.correct_table(spark, instruments, fixes, "underlying", "isin")
    assert isins() == new
    left = [t.name for t in spark.catalog.listTables(instruments.split(".")[0]) if "__" in t.name]
    assert left == []


def test_only_partitions_with_a_fixed_key_are_written(spark, instruments):
    def files():
        return set(spark.table(instruments).inputFiles())

    before = files()
    tables.correct_table(spark, instruments, spark.createDataFrame([("U1", "new")], "underlying string, isin string"), "underlying", "isin")
    assert len(before & files()) == 2 * len(before) // 3


def test_header_names_as_users_write_them(spark, database):
    folder = tempfile.mkdtemp(prefix="tradevigil-l-")

    def land(name, text):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)

    land("a.csv", "trade_id,notional,trade_date\nt1,1.5,2024-01-01\n")
    feeds.load_feed(spark, "trades", folder, database)
    land("b.csv", "Trade_ID, Notional ,TRADE_DATE\nt2,2.5,2024-01-02\n")
    land("c.csv", "trade_id,notional,Notional\nt3,1,2\n")
    feeds.load_feed(spark, "trades", folder, database)
    land("d.csv", "notional,trade_id\n3.5,t4\n")
    feeds.load_feed(spark, "trades", folder, database)
    rows = feeds.feed_table(spark, "trades", database)
    assert [c.strip().lower() for c in rows.columns] == rows.columns
    assert sorted(map(tuple, rows.select("trade_id", "notional", F.col("trade_date").cast("string")).collect())) == [
        ("t1", 1.5, "2024-01-01"), ("t2", 2.5, "2024-01-02"), ("t4", 3.5, None),
    ]
    bad = spark.table(f"{database}.processed_trade_files").where("error IS NOT NULL").collect()
    assert [(r["file_path"].rsplit("/", 1)[1], "notional" in r["error"]) for r in bad] == [("c.csv", True)]
    assert feeds.load_feed(spark, "trades", folder, database) is None


def test_rows_sent_twice(spark, database):
    sends = spark.createDataFrame(
        [("a", "low", 1), ("a", "high", 5), ("a", "mid", 9), ("b", "low", 3), (None, "x", 1), ("c", "q", None), ("c", "r", 4)], "k string, rating string, sent int"
    )
    facts = spark.createDataFrame([("a", 0), ("a", 1), ("a", 4), ("a", 5), ("a", 100), ("b", 2), ("z", 5), (None, 5), ("a", None), ("c", 1)], "k string, day int")
    got = dimensions.as_of(facts, sends, ["k"], "day", "sent")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("a", 0, "low"), ("a", 1, "low"), ("a", 4, "low"), ("a", 5, "high"), ("a", 100, "mid"), ("b", 2, "low"), ("z", 5, None), (None, 5, None), ("a", None, "low"), ("c", 1, "q")],
        key=repr,
    )
    assert {tuple(r) for r in dimensions.latest(sends.where("k <> 'c'"), ["k"], "sent").collect()} == {("a", "mid"), ("b", "low")}
    # a client landed twice is one client to the stages, as last sent
    folder = tempfile.mkdtemp(prefix="tradevigil-l-")
    for i, rating in enumerate(("Low", "High")):
        with open(os.path.join(folder, f"{i}.csv"), "w") as f:
            f.write(f"client_id,name,country,risk_rating\nc1,n,x,{rating}\n")
        feeds.load_feed(spark, "clients", folder, database)
    assert [r["risk_rating"] for r in Stages(spark, database).dimension("clients").collect()] == ["High"]
    assert features.client_hop1(Stages(spark, database).dimension("clients"), feeds.feed_table(spark, "relationships", database)).count() == 1


def test_the_state_of_a_batch_is_made_once(spark, third, same_rows):
    """Measuring new trades reads their stored state: it is not made anew for each figure of it."""
    store, (a, b, c) = third
    folder = tempfile.mkdtemp(prefix="tradevigil-once-")
    c.write.parquet(f"{folder}/new")
    fresh, old = spark.read.parquet(f"{folder}/new"), state_of(a.unionByName(b))
    batch = client_state.batch_state(fresh)
    for state in (old, None):
        rows = client_state.iq_trades_increment(fresh, state, batch)
        assert plan(rows).count(f"{folder}/new") == 1 and plan(rows).count("WindowGroupLimit") <= 2
        same_rows(rows, client_state.iq_trades_increment(fresh, old if state is not None else old.limit(0)))
