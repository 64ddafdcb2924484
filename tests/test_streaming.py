import json
import uuid
from types import SimpleNamespace

import pytest
from conftest import BASE_MS, event
from pyspark.sql import functions as F

from orderloom.functions.columns import trade_date
from orderloom.operators import lifecycle as lc
from orderloom.operators.events import (decode_events, dedup_events, dedup_stream,
                                        late_events, tag_late, with_lateness)
from orderloom.operators.linkage import linkages
from orderloom.operators.quality import snapshot_exceptions
from orderloom.operators.reconcile import reconcile_late
from orderloom.schema import MESSAGE_SCHEMA
from orderloom.session import cut_lineage
from orderloom.sources.event_log import (read_event_stream, read_message_stream, read_messages,
                                         source_options, subscription)
from orderloom.sources.tables import drop_expired, read_snapshot_table
from orderloom.streaming import pipeline, progress, sinks

NOW = pipeline.AVAILABLE_NOW
KEY = ["customer_order_id", "trade_date"]


class Topic:
    """A folder of messages; each `send` adds one file, so that it becomes one batch."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.offset = spark, str(folder / "topic"), 0

    def send(self, *rows, late_ms=0):
        messages = []
        for row in rows:
            body = row if isinstance(row, str) else json.dumps(row)
            arrival = BASE_MS if isinstance(row, str) else row["ts_ingest"]
            messages.append(("k", body, arrival + late_ms, 0, self.offset))
            self.offset += 1
        frame = self.spark.createDataFrame(
            messages, "key string, value string, ms long, partition int, offset long")
        (frame.withColumn("timestamp", F.timestamp_millis("ms")).coalesce(1)
         .select(*MESSAGE_SCHEMA.fieldNames()).write.mode("append").parquet(self.path))

    def stream(self):
        return read_event_stream(self.spark, "parquet", self.path)

    def batch(self):
        return tag_late(decode_events(read_messages(self.spark, self.path)))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "out")


def order(name, start=0):
    return [event("NEW", start, customer_order_id=name),
            event("ROUTE", start + 10, customer_order_id=name, route_id=f"R{name}",
                  parent_firm_order_id="F1"),
            event("FILL", start + 20, customer_order_id=name, route_id=f"R{name}",
                  exec_id=f"X{name}", qty=150 if name == "A" else 40, exec_price=2.0)]


def run(spark, topic, root, **options):
    return pipeline.run_pipeline(spark, topic.stream(), root, trigger=NOW, snapshot_ms=0,
                                 **options)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def json_rows(spark, path, schema):
    return spark.read.parquet(path).select(
        F.from_json("value", schema).alias("r")).select("r.*")


def test_pipeline_equals_batch_over_several_runs(spark, topic, root):
    """Two runs on one checkpoint, with resent events between them."""
    topic.send(*order("A"), *order("B"))
    run(spark, topic, root)
    topic.send(*order("A"), *order("C", 1_000), "not an event")
    run(spark, topic, root)

    unique = dedup_events(topic.batch().where("event_id IS NOT NULL"))
    snapshots = lc.lifecycle_snapshot(unique, 0)
    streamed = sinks.read_newest(spark, f"{root}/lifecycle", KEY).select(snapshots.columns)
    assert same(streamed, snapshots) and streamed.count() == 3

    edges = linkages(unique)
    assert same(json_rows(spark, f"{root}/linkages", edges.schema), edges)

    found = sinks.read_newest(spark, f"{root}/exceptions", ["exception_id"])
    assert same(found, snapshot_exceptions(snapshots).select(found.columns))
    assert [r.exception_type for r in found.collect()] == ["OVERFILL"]


def test_repeated_batch_replaces_its_own_output(spark, topic, root):
    """As after a failure between the write and the commit of a batch."""
    topic.send(*order("A"))
    seen = []
    write = sinks.snapshot_batch_writer(
        root, snapshot_exceptions, publish=lambda df, kind: seen.append((kind, df.count())))
    batch = lc.lifecycle_snapshot(topic.batch(), 0)
    for _ in range(2):
        write(batch, 0)
    write(batch.withColumn("ts_snapshot", F.lit(9).cast("long")), 1)
    assert spark.read.parquet(f"{root}/lifecycle").count() == 2  # one per batch
    assert sinks.read_newest(spark, f"{root}/lifecycle", KEY).first().ts_snapshot == 9
    assert sinks.read_newest(spark, f"{root}/exceptions", ["exception_id"]).count() == 1
    assert seen == [("lifecycle", 1), ("exceptions", 1)] * 3


def test_late_event_is_lost_to_the_stream_and_reconciled(spark, topic, root):
    """Behind the watermark, deduplication drops a row whose day is still open; the late
    query keeps it and the batch reconciliation puts it back."""
    topic.send(event("NEW"), event("FILL", 5, qty=40, exec_price=1.0))
    run(spark, topic, root)
    topic.send(event("ACK", 3_600_000))         # moves the watermark an hour ahead
    run(spark, topic, root)
    topic.send(event("FILL", 30, event_id="late", qty=60, exec_price=1.0,
                     ts_ingest=BASE_MS + 3_700_000))
    run(spark, topic, root)

    published = sinks.read_newest(spark, f"{root}/lifecycle", KEY)
    assert published.first().filled_qty == 40 and not published.first().is_provisional
    late = json_rows(spark, f"{root}/late_events", late_events(topic.batch()).schema)
    assert [r.event_id for r in late.collect()] == ["late"]

    fixed = reconcile_late(topic.batch(), late, published, 1).first()
    assert (fixed.filled_qty, fixed.status, fixed.is_corrected) == (100, "FILLED", True)


def test_dedup_by_id_within_the_watermark(spark, topic, root):
    topic.send(event("FILL", 0, event_id="E"), event("FILL", 1, event_id="E"))
    for mode, kept in (("event_time", 2), ("event_id", 1)):
        unique = dedup_stream(with_lateness(topic.stream()), mode)
        out = f"{root}/{mode}"
        sinks.write_batches(unique, "unique", out, trigger=NOW).awaitTermination()
        assert sinks.read_batches(spark, f"{out}/unique").count() == kept


def test_days_are_final_once_the_watermark_passes(spark, topic, root):
    day = 86_400_000
    topic.send(*order("A"))
    final = lc.finalized_stream(dedup_stream(with_lateness(topic.stream())), 0)
    sinks.write_batches(final, "final", root, trigger=NOW).awaitTermination()
    topic.send(event("NEW", day, customer_order_id="B"))
    sinks.write_batches(final, "final", root, trigger=NOW).awaitTermination()
    rows = sinks.read_batches(spark, f"{root}/final").collect()
    assert [(r.customer_order_id, r.is_finalized) for r in rows] == [("A", True)]


def test_orders_across_days_close_when_quiet(spark, topic, root):
    day = 86_400_000
    topic.send(*order("A"), event("FILL", day, customer_order_id="A", qty=1, exec_price=1.0))
    topic.send(event("NEW", 10 * day, customer_order_id="B"))
    stream = lc.lifecycle_sessions(dedup_stream(with_lateness(topic.stream())), "2 days", 0)
    sinks.write_batches(stream, "orders", root, trigger=NOW).awaitTermination()
    topic.send(event("FILL", 12 * day, customer_order_id="A", event_id="later", qty=1,
                     exec_price=1.0))
    topic.send(event("NEW", 30 * day, customer_order_id="C"))
    assert sinks.read_batches(spark, f"{root}/orders").count() == 1
    sinks.write_batches(stream, "orders", root, trigger=NOW).awaitTermination()
    closed = sinks.read_batches(spark, f"{root}/orders")
    merged = {r.customer_order_id: r for r in lc.merge_sessions(closed).collect()}
    assert (merged["A"].filled_qty, merged["A"].total_qty, merged["A"].status) == (
        152, 100, "FILLED")
    (row,) = closed.where("customer_order_id = 'A' AND filled_qty > 1").collect()
    assert (row.customer_order_id, row.spans_days, row.filled_qty) == ("A", True, 151)


def test_progress_and_state(spark, topic, root):
    topic.send(*order("A"))
    log = progress.ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        assert log.wait_for(run(spark, topic, root))
    finally:
        spark.streams.removeListener(log)
    rows = progress.progress_table(spark, f"{root}/progress")
    assert {r.query for r in rows.collect()} == {
        "linkages", "lifecycle", "late_events", "audit", "event_exceptions"}
    assert rows.agg(F.sum("input_rows")).first()[0] == 15
    state = progress.read_state(spark, sinks.checkpoint_path(root, "linkages"))
    assert state.count() == 3


def test_progress_of_every_batch_is_kept(spark, topic, root):
    log = progress.ProgressLog(spark, f"{root}/progress", every=40)
    for i in range(150):  # more batches than Spark remembers
        fields = {"name": "many", "batchId": i, "timestamp": "t", "numInputRows": 2,
                  "durationMs": {}}
        log.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(json=json.dumps(fields))))
    log.onQueryTerminated(SimpleNamespace(runId="r"))
    assert log.wait_for([SimpleNamespace(runId="r")], 1)
    rows = progress.progress_table(spark, f"{root}/progress")
    assert rows.agg(F.count_distinct("batch_id"), F.sum("input_rows")).first() == (150, 300)


def test_quarantine_audit_and_row_rules(spark, topic, root):
    topic.send(*order("A"), "oops", '{"event_id": 5}', "[]")
    topic.send(dict(event("FILL", 50, customer_order_id="A", event_id="late"),
                    ts_ingest=BASE_MS + 900_000))
    run(spark, topic, root, messages=read_message_stream(spark, "parquet", topic.path),
        as_of_ms=BASE_MS + 86_400_000)
    aside = spark.read.parquet(f"{root}/quarantine")
    assert aside.count() == 3
    audit = json_rows(spark, f"{root}/audit", "action string, triggering_event_id string")
    assert [tuple(r) for r in audit.collect()] == [("LATE_EVENT_RECEIVED", "late")]
    found = json_rows(spark, f"{root}/event_exceptions", "exception_type string, event_id string")
    assert [tuple(r) for r in found.collect()] == [("MISSING_REQUIRED_ID", "late")]


def test_newest_snapshots_are_merged_into_a_table(spark, topic, root):
    path = f"{root}/table"
    for rows in (order("A"), order("B"), [event("CANCEL", 60, customer_order_id="B")]):
        topic.send(*rows)
        run(spark, topic, root, publish=sinks.to_table(path))
    table = read_snapshot_table(spark, path)
    assert {r.customer_order_id: r.status for r in table.collect()} == {
        "A": "FILLED", "B": "CANCELED"}
    before = sorted(map(str, table.collect()))
    sinks.merge_newest(cut_lineage(table, "copy"), path)  # a repeated batch
    assert sorted(map(str, read_snapshot_table(spark, path).collect())) == before


def test_expired_partitions_are_deleted(spark, topic, root):
    rows = spark.createDataFrame([("a", "2026-01-01"), ("b", "2026-02-01")], "v string, day string")
    rows.write.partitionBy("day").parquet(f"{root}/dated")
    assert drop_expired(spark, f"{root}/dated", "2026-01-15", "day") == ["2026-01-01"]
    assert [r.v for r in spark.read.parquet(f"{root}/dated").collect()] == ["b"]


def test_console_and_counts(spark, topic, root, capfd):
    topic.send(*order("A"))
    sinks.write_console(topic.stream().groupBy("event_type").count(),
                        "c" + uuid.uuid4().hex[:6], NOW).awaitTermination()
    from orderloom.operators.reports import events_by_type
    sinks.write_batches(events_by_type(topic.stream()), "n", root, "complete",
                        NOW).awaitTermination()
    newest = sinks.read_newest(spark, f"{root}/n", ["event_type"])
    assert {r.event_type: r.n for r in newest.collect()} == {"NEW": 1, "ROUTE": 1, "FILL": 1}


def test_broker_options():
    plain = source_options("broker:9092")
    assert plain == {"kafka.bootstrap.servers": "broker:9092"}
    assert source_options(iam=True)["kafka.sasl.mechanism"] == "AWS_MSK_IAM"
    assert subscription("events") == {
        "subscribe": "events", "startingOffsets": "latest", "failOnDataLoss": "false"}


def test_trade_date_is_utc(spark):
    row = spark.range(1).select(F.lit(1_768_521_599_999).alias("ts_event")).select(
        trade_date().alias("d")).first()
    assert row.d == "2026-01-15"
