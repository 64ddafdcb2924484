"""Checks between events and corrections inside a running stream."""

import pytest
from conftest import event
from pyspark.sql import functions as F
from test_streaming import NOW, Topic

from orderloom.operators import quality as dq
from orderloom.operators.events import (dedup_events, dedup_stream, late_events, tag_late,
                                        with_lateness)
from orderloom.operators.lifecycle import lifecycle_snapshot
from orderloom.sources.tables import read_snapshot_table, write_snapshot_table
from orderloom.streaming import corrections, live_checks, pipeline, sinks

HOUR = 3_600_000


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "out")


def order(i, at=0, skip=(), **times):
    """An order with a route, its acknowledgement and a fill; `times` moves events by type."""
    ids = {"customer_order_id": f"O{i}", "firm_order_id": f"F{i}"}
    child = {**ids, "firm_order_id": f"F{i}-1", "route_id": f"R{i}"}
    rows = {"NEW": (0, ids), "ROUTE": (100, {**child, "parent_firm_order_id": f"F{i}"}),
            "ACK": (150, child), "FILL": (200, {**child, "exec_id": f"X{i}"})}
    return [event(kind, at + times.get(kind, ms), event_id=f"{kind}-{i}", **fields)
            for kind, (ms, fields) in rows.items() if kind not in skip]


def checked(topic, root):
    for query in [pipeline.start_link_checks(with_lateness(topic.stream()), root, trigger=NOW)]:
        query.awaitTermination()
    found = topic.spark.read.parquet(f"{root}/link_exceptions")
    return sorted((r.t, r.o) for r in found.select(
        F.get_json_object("value", "$.exception_type").alias("t"),
        F.get_json_object("value", "$.customer_order_id").alias("o")).collect())


def test_each_violation_comes_once_over_several_batches(topic, root):
    topic.send(*order(1), *order(2, skip=["NEW"]), *order(3, skip=["ROUTE"]),
               *order(4, skip=["ACK"]), *order(5, skip=["FILL"]))
    assert checked(topic, root) == []  # nothing is missing yet
    topic.send(*order(6, HOUR, NEW=250), *order(7, HOUR, FILL=120), *order(8, HOUR, ACK=50),
               *order(9, HOUR))
    waited = [("MISSING_PARENT", "O2"), ("ORPHANED_EXECUTION", "O3"), ("ROUTE_NO_OUTCOME", "O4")]
    out_of_order = [("ACK_BEFORE_ROUTE", "O8"), ("FILL_BEFORE_ACK", "O7"),
                    ("FILL_BEFORE_NEW", "O6"), ("ROUTE_BEFORE_NEW", "O6")]
    assert checked(topic, root) == sorted(waited + out_of_order)
    again = dict(order(9, HOUR)[3])
    topic.send(again, *order(10, 2 * HOUR), *order(11, 3 * HOUR, skip=["ROUTE"]))
    assert checked(topic, root) == sorted(waited + out_of_order)
    topic.send(*order(12, 5 * HOUR))
    assert checked(topic, root) == sorted(waited + out_of_order + [("ORPHANED_EXECUTION", "O11")])


def test_stream_equals_batch_rules(spark, topic, root):
    topic.send(*order(1, skip=["NEW"]), *order(2, FILL=120), *order(3, skip=["ACK"]))
    topic.send(*order(4, HOUR, NEW=300), *order(5, HOUR, skip=["ROUTE"]))
    topic.send(*order(6, 9 * HOUR))
    checked(topic, root)
    live = spark.read.parquet(f"{root}/link_exceptions").select(
        F.get_json_object("value", "$.exception_id").alias("exception_id"))
    events = dedup_events(topic.batch())
    batch = (dq.missing_parent(events).unionByName(dq.orphaned_execution(events))
             .unionByName(dq.order_exceptions(events, ["ROUTE_BEFORE_NEW", "FILL_BEFORE_NEW"]))
             .unionByName(dq.route_exceptions(events)))
    assert sorted(r[0] for r in live.collect()) == sorted(
        r.exception_id for r in batch.collect())


def test_state_is_bounded(topic, root):
    """An answer that comes after the wait is no answer any more, and what was asked is forgotten."""
    topic.send(*order(1, skip=["ACK"]))
    topic.send(*order(2, 50 * HOUR))
    assert checked(topic, root) == [("ROUTE_NO_OUTCOME", "O1")]
    state = topic.spark.read.format("statestore").option("operatorId", 1).option(
        "joinSide", "left").load(sinks.checkpoint_path(root, "link_exceptions"))
    orders = {r[0] for r in state.select("value.customer_order_id").collect()}
    assert "O1" not in orders


# --- corrections --------------------------------------------------------------------------

LATE = 10 * 60_000


@pytest.fixture
def published(spark, topic, root):
    """A table without the late events of two orders, and a way to correct it."""
    topic.send(*order(1, skip=["FILL"]), *order(2, skip=["FILL", "ACK"]), *order(3))
    table = f"{root}/table"
    write_snapshot_table(lifecycle_snapshot(dedup_events(topic.batch()), 1), table,
                         ("trade_date",))

    def writer():
        return corrections.correction_writer(topic.batch, table, f"{root}/fix",
                                             ("trade_date",), 1, 1)
    return table, writer


def late(i, kind):
    row = next(r for r in order(i) if r["event_type"] == kind)
    return {**row, "ts_ingest": row["ts_ingest"] + LATE}


def audits(spark, root):
    return sorted((r.customer_order_id, r.triggering_event_id)
                  for r in sinks.read_batches(spark, f"{root}/fix/audit").collect())


def state(spark, table):
    return sorted((r.customer_order_id, r.filled_qty, r.has_late_events)
                  for r in read_snapshot_table(spark, table).collect())


def test_batches_of_late_events_correct_the_table(spark, topic, root, published):
    table, _ = published

    def run():
        corrections.start_corrections(
            late_events(with_lateness(topic.stream())), topic.batch, table, f"{root}/fix",
            ("trade_date",), 1, 1, NOW).awaitTermination()

    run()
    topic.send(late(1, "FILL"))
    run()
    assert state(spark, table) == [("O1", 100, True), ("O2", 0, False), ("O3", 100, False)]
    topic.send(late(2, "ACK"), late(2, "FILL"))
    run()
    run()
    assert state(spark, table) == [("O1", 100, True), ("O2", 100, True), ("O3", 100, False)]
    assert audits(spark, root) == [("O1", "FILL-1"), ("O2", "FILL-2")]
    expected = lifecycle_snapshot(dedup_events(topic.batch()), 1)
    assert expected.select("customer_order_id", "filled_qty", "status").exceptAll(
        read_snapshot_table(spark, table).select("customer_order_id", "filled_qty", "status")
    ).isEmpty()


@pytest.mark.parametrize("lost_after", ["planned", "applied", "audited"])
def test_a_repeated_batch_corrects_and_audits_once(spark, topic, root, published, monkeypatch,
                                                   lost_after):
    table, writer = published
    topic.send(late(1, "FILL"))
    batch = late_events(topic.batch())

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if lost_after == "planned":
            m.setattr(corrections, "apply_corrections", fail)
        elif lost_after == "applied":
            m.setattr(corrections, "audit_of", fail)
        if lost_after == "audited":
            writer()(batch, 4)
        else:
            with pytest.raises(RuntimeError):
                writer()(batch, 4)
    writer()(batch, 4)
    assert state(spark, table)[0] == ("O1", 100, True)
    assert audits(spark, root) == [("O1", "FILL-1")]


def test_the_pipeline_can_run_both(spark, topic, root, published):
    table, _ = published
    topic.send(*order(4, HOUR, FILL=120), late(1, "FILL"))
    pipeline.run_pipeline(
        spark, topic.stream(), root, trigger=NOW, snapshot_ms=1, link_checks=True,
        corrected={"log": topic.batch, "table": table, "partition_by": ("trade_date",)})
    assert state(spark, table)[0] == ("O1", 100, True)
    kinds = spark.read.parquet(f"{root}/link_exceptions").select(
        F.get_json_object("value", "$.exception_type")).distinct().collect()
    assert "FILL_BEFORE_ACK" in {r[0] for r in kinds}
    assert sinks.read_batches(spark, f"{root}/corrected/audit").count() == 1


def test_arrival_tags(topic):
    topic.send(late(1, "FILL"), order(1)[0])
    assert sorted(r.is_late for r in tag_late(topic.batch()).collect()) == [False, True]


# --- exceptions by id, finalisation -------------------------------------------------------

def test_an_undone_violation_is_resolved(spark, topic, root):
    table = f"{root}/open"

    def run():
        sinks.write_snapshots(
            lifecycle_snapshot(dedup_stream(with_lateness(topic.stream())), 1), root,
            dq.snapshot_exceptions, NOW, exceptions_table=table).awaitTermination()

    def held(state):
        return sorted((r.customer_order_id, r.exception_type)
                      for r in sinks.read_exceptions(spark, table, state).collect())

    topic.send(*order(1), {**order(1)[3], "event_id": "again", "exec_id": "Y1"}, *order(2),
               {**order(2)[3], "event_id": "again2", "exec_id": "Y2"})
    run()
    assert held("OPEN") == [("O1", "OVERFILL"), ("O2", "OVERFILL")]
    bust = {**order(1, 1000)[3], "event_id": "bust", "event_type": "BUST", "exec_id": "Y1"}
    topic.send(bust)
    run()
    assert held("OPEN") == [("O2", "OVERFILL")] and held("RESOLVED") == [("O1", "OVERFILL")]
    batch = dq.snapshot_exceptions(lifecycle_snapshot(dedup_events(topic.batch()), 1))
    assert [r.exception_id for r in batch.collect()] == [
        r.exception_id for r in sinks.read_exceptions(spark, table).collect()]
    topic.send({**bust, "event_id": "fill", "event_type": "FILL", "ts_event": bust["ts_event"] + 1})
    run()
    assert held("OPEN") == [("O1", "OVERFILL"), ("O2", "OVERFILL")] and held("RESOLVED") == []


def test_a_repeated_batch_leaves_the_same_exceptions(spark, topic, root):
    topic.send(*order(1), {**order(1)[3], "event_id": "again", "exec_id": "Y1"})
    snapshots = lifecycle_snapshot(dedup_events(topic.batch()), 1)
    for _ in range(2):
        sinks.merge_exceptions(snapshots, f"{root}/open")
    assert sinks.read_exceptions(spark, f"{root}/open").count() == 1


def test_a_day_is_final_once_the_watermark_has_passed_it(spark, topic, root):
    def run():
        pipeline.start_finalization(dedup_stream(with_lateness(topic.stream())), root, 1,
                                    trigger=NOW).awaitTermination()
        return sorted(r[0] for r in spark.read.parquet(f"{root}/finalized").select(
            F.get_json_object("value", "$.customer_order_id")).collect())

    topic.send(*order(1), *order(2))
    assert run() == []
    topic.send(*order(3, 24 * HOUR))  # the next day, after a restart from the checkpoint
    assert run() == ["O1", "O2"]
    topic.send(*order(4, 48 * HOUR))
    assert run() == ["O1", "O2", "O3"]


def test_questions_hold_nothing_twice(spark, log):
    """What `ref` or the time tells as well does not wait in the state."""
    asked = live_checks.questions(log(order(1)))
    assert not {"parent_firm_order_id", "route_id", "day"} & set(asked.columns)
    assert {(r.kind, r.event_id) for r in asked.where("event_type = 'FILL'").collect()} == {
        ("ROUTE", "FILL-1"), ("ACK", None), ("NEW", "FILL-1")}
