import json

from conftest import BASE_MS, event
from pyspark.sql import functions as F

from orderloom.functions.columns import trade_date
from orderloom.operators import reconcile as rc
from orderloom.operators.events import dedup_events, tag_late
from orderloom.operators.lifecycle import lifecycle_snapshot
from orderloom.operators.skew import hot_keys
from orderloom.sources import tables

LATE = 600_000
DAY = 86_400_000


def late_case(log):
    rows = [event("NEW"), event("FILL", 10, qty=40, exec_price=1.0),
            event("FILL", 20, qty=60, exec_price=1.0, event_id="late",
                  ts_ingest=BASE_MS + LATE)]
    rows.append(dict(rows[-1], ts_ingest=BASE_MS + LATE + 5))  # the late event, twice
    rows += [event("NEW", customer_order_id="O2")]
    frame = log(rows)
    raw = tag_late(frame.withColumn("kafka_timestamp", F.timestamp_millis("ts_ingest")))
    published = lifecycle_snapshot(dedup_events(raw.where("NOT is_late")), 1)
    return raw, raw.where("is_late"), published


def test_reconcile_repairs_only_what_late_events_touch(log):
    raw, late, published = late_case(log)
    found = {r.customer_order_id: r for r in rc.reconcile_late(raw, late, published, 2).collect()}
    assert (found["O1"].status, found["O1"].is_corrected, found["O1"].is_provisional) == (
        "FILLED", True, True)
    assert (found["O2"].is_corrected, found["O2"].ts_snapshot) == (False, 1)
    keys = hot_keys(raw.withColumn("trade_date", trade_date()),
                    ["customer_order_id", "trade_date"], min_rows=1)
    assert len(keys) == 2
    assert found["O1"].ts_snapshot == 2
    hot = rc.reconcile_late(raw, late, published, 2, hot=keys)
    assert {r.customer_order_id: r.status for r in hot.collect()} == {
        k: r.status for k, r in found.items()}


def price_case(log):
    """A late event that changes nothing but the mean price."""
    rows = [event("NEW"), event("FILL", 10, qty=40, exec_price=10.0),
            event("NEW", 3 * DAY, customer_order_id="O2")]
    first = log(rows)
    changed = dict(rows[1], exec_price=12.0, event_id="late", ts_ingest=BASE_MS + LATE)
    bust = event("BUST", 10, qty=40, event_id="bust", ts_ingest=BASE_MS + LATE)
    raw = tag_late(log(rows + [changed, bust]).withColumn(
        "kafka_timestamp", F.timestamp_millis("ts_ingest")))
    return raw, raw.where("is_late"), lifecycle_snapshot(dedup_events(first), 1)


def test_all_published_columns_are_compared(log):
    raw, _, published = price_case(log)
    other = published.withColumn("avg_exec_price", F.col("avg_exec_price") + 2.0)
    (row,) = rc.audit_corrections(published, other, raw.where("is_late"), 5).collect()
    assert json.loads(row.previous_state)["avg_exec_price"] == 10.0
    assert json.loads(row.new_state)["avg_exec_price"] == 12.0


def test_table_is_corrected_in_place(spark, log, tmp_path):
    raw, late, published = price_case(log)
    path, log_path = str(tmp_path / "table"), str(tmp_path / "log")
    tables.write_snapshot_table(published, path, ("trade_date",))
    raw.withColumn("trade_date", trade_date()).write.partitionBy("trade_date").parquet(log_path)
    stored = tables.read_snapshot_table(spark, log_path)
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "table").glob(
        "trade_date=2026-01-18/*.parquet")}
    audit = rc.correct_table(spark, stored, late, path, snapshot_ms=2, audited_ms=5)
    assert [r.triggering_event_id for r in audit.collect()] == ["late"]
    found = {r.customer_order_id: r for r in tables.read_snapshot_table(spark, path).collect()}
    assert (found["O1"].avg_exec_price, found["O1"].filled_qty, found["O1"].ts_snapshot) == (
        11.0, 40, 2)
    assert found["O2"].ts_snapshot == 1
    assert untouched == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "table").glob(
        "trade_date=2026-01-18/*.parquet")}
    again = rc.correct_table(spark, stored, late, path, snapshot_ms=3, audited_ms=5)
    assert again.isEmpty()


def test_recomputing_reads_only_the_named_partitions(spark, log, tmp_path):
    raw, late, _ = price_case(log)
    path = str(tmp_path / "log")
    raw.withColumn("trade_date", trade_date()).write.partitionBy("trade_date").parquet(path)
    stored = tables.read_snapshot_table(spark, path).where(F.col("trade_date").isin("2026-01-15"))
    plan = rc.recompute_affected(stored, late)._jdf.queryExecution().toString()
    assert "PartitionFilters: [trade_date" in plan.replace("isnotnull(", "").replace(
        "PartitionFilters: [(", "PartitionFilters: [")


def test_correction_audit(log):
    raw, late, published = late_case(log)
    current = lifecycle_snapshot(dedup_events(raw), 2)
    (row,) = rc.audit_corrections(published, current, late, 5).collect()
    assert row.reason == "Late FILL event received" and row.triggering_event_id == "late"
    assert json.loads(row.previous_state)["filled_qty"] == 40
    assert json.loads(row.new_state)["status"] == "FILLED"
    assert rc.audit_corrections(current, current, late, 5).isEmpty()


def test_late_audit_is_repeatable(log):
    _, late, _ = late_case(log)
    ids = [{r.audit_id for r in rc.audit_late(dedup_events(late), 5).collect()}
           for _ in range(2)]
    assert len(ids[0]) == 1 and ids[0] == ids[1]


def test_finalization(log):
    raw, _, published = late_case(log)
    midnight = BASE_MS - BASE_MS % DAY + DAY
    assert not rc.mark_finalized(published, midnight - 1).where("is_finalized").count()
    final = rc.mark_finalized(published, midnight)
    assert final.where("is_finalized").count() == 2
    assert {r.action for r in rc.audit_finalization(final, 1).collect()} == {
        "LIFECYCLE_FINALIZED"}
    assert rc.updates_after_final(raw, 120_000).isEmpty()
    after = log([event("FILL", 0, event_id="next day", ts_ingest=BASE_MS)], arrival=DAY)
    assert rc.updates_after_final(after, 120_000).count() == 1


def test_comparative_review(spark, log):
    events = log([event("NEW"), event("FILL", 1, exec_id="X1", qty=50, exec_price=1.0),
                  event("FILL", 2, exec_id="X2", qty=50, exec_price=1.0, event_id="f2"),
                  event("NEW", customer_order_id="O2"),
                  event("NEW", customer_order_id="O3", qty=7)])
    orders = spark.createDataFrame([("O1", 90), ("O2", 100), ("O4", 1)],
                                   "customer_order_id string, total_qty long")
    executions = spark.createDataFrame(
        [("O1", "X1", 50, 1.5), ("O1", "X3", 5, 1.0)],
        "customer_order_id string, exec_id string, qty long, price double")
    found = {(r.discrepancy, r.customer_order_id, r.exec_id)
             for r in rc.comparative_review(events, orders, executions).collect()}
    assert found == {
        ("QUANTITY_MISMATCH", "O1", None), ("ORDER_MISSING_IN_BOOKS", "O3", None),
        ("ORDER_MISSING_IN_LOG", "O4", None), ("PRICE_MISMATCH", "O1", "X1"),
        ("MISSING_IN_INTERNAL", "O1", "X2"), ("MISSING_IN_CAT", "O1", "X3")}
    row = rc.match_rate(events, orders, executions).first()
    assert (row.orders, row.matched, row.match_rate) == (4, 1, 0.25)
