"""The ledger as events: transitions, crashes, feeds side by side, deliveries of one path."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loadkit.contracts import ColumnMap, ContractError, FeedContract
from loadkit.operators.ledger import LEDGER_KEY
from loadkit.plans import runner
from loadkit.plans.event_ledger import ALLOWED, ORDER, EventLedger
from loadkit.plans.runner import load_feed, load_many, merged_outcome, stage_files
from loadkit.plans.snapshots import SnapshotTable

T1 = dt.datetime(2024, 1, 1)
FEED = FeedContract("cc", (ColumnMap("_c0", "k", "string"), ColumnMap("_c1", "v", "decimal(5,2)")), sep="|", extract_type="incremental",
                    load_type="append", load_all_incremental=True)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def _setup(spark, tmp, n=3):
    land = os.path.join(tmp, "landing")
    for i in range(n):
        _write(f"{land}/cc/CC_{i}.txt", f"a{i}|1.00\n")
    ledger = EventLedger(spark, os.path.join(tmp, "ledger"))
    _stage(spark, land, ledger)
    return land, ledger, SnapshotTable(spark, os.path.join(tmp, "raw"))


def _stage(spark, land, ledger):
    systems = spark.createDataFrame([("ERP", 1, land, "active")], "src_sys_key string, src_sys_id int, src_entity_path string, src_sys_status string")
    ents = spark.createDataFrame([("ERP", "CC", 2, "cc/CC_*.txt", "active")],
                                 "src_sys_key string, src_entity_key string, src_entity_id int, src_entity_pattern string, src_entity_status string")
    stage_files(spark, land, "ERP", systems, ents, ledger, T1)


def _tell(ledger, rows, status, minute):
    return ledger.record(rows.select(*LEDGER_KEY, F.lit(status).alias("src_entity_load_status"), F.lit("m").alias("src_entity_load_mesg"),
                                     F.lit("r").alias("src_entity_load_run_id")), T1 + dt.timedelta(minutes=minute))


def _states(ledger):
    return {r.src_entity_name: r.src_entity_load_status for r in ledger.read().collect()}


def test_every_transition(spark, tmp):
    _, ledger, _ = _setup(spark, tmp, 1)
    file = ledger.files.read()
    assert set(ORDER) == set(ALLOWED)
    at, state = 0, "staged"
    for path in (["started", "failed", "started", "error", "started", "started", "success"],):
        for step in path:
            for status in ORDER:
                if status not in ALLOWED[state]:
                    assert _tell(ledger, file, status, at) == {"accepted": 0, "refused": 1}
            at += 1
            assert _tell(ledger, file, step, at) == {"accepted": 1, "refused": 0}
            state = step
    assert _states(ledger) == {"CC_0.txt": "success"} and ledger.queue().count() == 0
    life = ledger.lifecycle().first()
    assert life.n_attempts == 4 and life.src_entity_load_start_time == T1 + dt.timedelta(minutes=1)
    assert life.src_entity_load_finish_time == T1 + dt.timedelta(minutes=7)
    assert ledger.refused().filter("met = 'staged'").count() == 4
    ledger.fold()
    assert ledger.events().count() == 0 and _states(ledger) == {"CC_0.txt": "success"}
    assert _tell(ledger, file, "started", 9)["refused"] == 1


def test_a_feed_appends_and_a_crash_is_taken_up(spark, tmp, monkeypatch):
    land, ledger, raw = _setup(spark, tmp)
    versions = len(ledger.files.snapshots())
    with monkeypatch.context() as mp:
        mp.setattr(runner, "file_outcomes", lambda df: (_ for _ in ()).throw(RuntimeError("disk gone")))
        with pytest.raises(RuntimeError):
            load_feed(spark, FEED, ledger, raw, "CC", "r1")
    assert set(_states(ledger).values()) == {"error"}
    assert load_feed(spark, FEED, ledger, raw, "CC", "r2").status == "completed"
    assert set(_states(ledger).values()) == {"success"} and raw.read().count() == 3
    assert len(ledger.files.snapshots()) == versions            # no rewrite
    # a run that died between publishing and its outcome: started, published
    _write(f"{land}/cc/CC_9.txt", "z|1.00\n")
    _stage(spark, land, ledger)
    with monkeypatch.context() as mp:
        mp.setattr(runner.Book, "outcome", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            load_feed(spark, FEED, ledger, raw, "CC", "r3")
    assert _states(ledger)["CC_9.txt"] == "started" and raw.read().count() == 4
    load_feed(spark, FEED, ledger, raw, "CC", "r4")
    assert _states(ledger)["CC_9.txt"] == "success" and raw.read().count() == 4
    assert raw.published().count() == 4


@pytest.mark.parametrize("events", [True, False])
def test_a_path_delivered_again_is_loaded_once(spark, tmp, events):
    land, ledger, raw = _setup(spark, tmp, 1)
    os.utime(f"{land}/cc/CC_0.txt", (2_000_000_000, 2_000_000_000))
    _write(f"{land}/cc/CC_0.txt", "new|2.00\n")
    os.utime(f"{land}/cc/CC_0.txt", (2_000_000_500, 2_000_000_500))
    _stage(spark, land, ledger)
    book = ledger
    if not events:
        book = SnapshotTable(spark, os.path.join(tmp, "plain"))
        book.write(ledger.read())
    load_feed(spark, FEED, book, raw, "CC", "r1")
    got = sorted((r.src_entity_timestamp, r.src_entity_load_status) for r in book.read().collect())
    assert [s for _, s in got] == ["skipped", "success"]
    assert [r.k for r in raw.read().collect()] == ["new"]


def test_feeds_side_by_side_need_events(spark, tmp):
    land, ledger, raw = _setup(spark, tmp)
    with pytest.raises(ContractError):
        load_many(spark, [(FEED, raw, "CC")], SnapshotTable(spark, os.path.join(tmp, "x")), "r", stop_at_failure=False, parallel=2)
    with pytest.raises(ContractError):
        load_many(spark, [(FEED, raw, "CC")], ledger, "r", parallel=2)
    feeds = [(FEED, SnapshotTable(spark, os.path.join(tmp, f"raw{i}")), "CC") for i in range(1)]
    bad = FeedContract("bad", FEED.columns, sep="|", extract_type="nothing")
    got = load_many(spark, [(bad, raw, "CC"), *feeds], ledger, "r", stop_at_failure=False)
    assert merged_outcome(got, 2) == {"status": "failed", "n_completed": 1, "n_failed": 1, "n_not_run": 0}
    assert "nothing" in got[0].message


def test_an_update_meets_the_ledger_in_three_shuffles(spark, tmp, monkeypatch):
    """updates, staged files and events are shuffled by the key once each and grouped without
    a sort; of events at the same time the later state counts, to the microsecond and before 1970."""
    from loadkit.operators.ledger import LEDGER_SCHEMA
    from loadkit.plans.event_ledger import EVENT_SCHEMA
    ledger = EventLedger(spark, f"{tmp}/ledger")
    ledger.stage(spark.createDataFrame([(k, "S", "E", 1, k, k, T1, 1, T1, "staged", "Staged", "R") for k in ("a", "b", "c", "d")], LEDGER_SCHEMA))
    old = dt.datetime(1960, 1, 1, 23, 59, 59, 999998)
    spark.createDataFrame([
        ("a", "S", "E", "failed", old.replace(microsecond=999999), "", "R", None, "started", True), ("a", "S", "E", "started", old, "", "R", None, "staged", True),
        ("b", "S", "E", "success", T1, "", "R", 5, "started", True), ("b", "S", "E", "started", T1, "", "R", None, "staged", True),
        ("c", "S", "E", "success", T1, "", "R", 5, "staged", False)], EVENT_SCHEMA).write.parquet(f"{tmp}/ledger/events/0")
    assert {r.src_entity_inst_key: (r.src_entity_load_status, r.n_attempts) for r in ledger.lifecycle().collect()} == {
        "a": ("failed", 1), "b": ("success", 1), "c": ("staged", 0), "d": ("staged", 0)}
    plans, write = [], type(spark.range(1).write).parquet

    def spied(self, path, *a, **k):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *a, **k)
    monkeypatch.setattr(type(spark.range(1).write), "parquet", spied)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = spark.createDataFrame([(k, "S", "E", "started", "", "R") for k in ("a", "b", "c", "x")], [*LEDGER_SCHEMA.names[:3], *LEDGER_SCHEMA.names[9:]])
        assert ledger.record(told) == {"accepted": 2, "refused": 2}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plans[0].count("Exchange hashpartitioning") == 3 and "SortAggregate" not in plans[0]
    assert {r.src_entity_inst_key: r.met for r in ledger.refused().collect() if r.src_entity_inst_key != "c"} == {"b": "success", "x": None}


def test_a_listing_is_never_sent_to_the_driver(spark):
    """the exploded listing outgrows the file that a broadcast is planned from."""
    from conftest import SMALL
    from loadkit.harness import events_listing
    from loadkit.operators.ledger import discover_files
    got = discover_files(*events_listing(spark, SMALL))
    joins = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "_folder#" in x and "Join" in x]
    assert joins and all("BuildRight" in x for x in joins)
