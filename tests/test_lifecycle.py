from conftest import BASE_MS, event
from pyspark.sql import functions as F

from orderloom.operators import lifecycle as lc
from orderloom.operators.events import dedup_events
from orderloom.operators.quality import snapshot_exceptions

DAY = 86_400_000


def snapshot(log, rows):
    return lc.lifecycle_snapshot(dedup_events(log(rows)), 0)


def fill(after, qty, **more):
    return event("FILL", after, qty=qty, event_id=more.pop("event_id", f"fill{after}"),
                 exec_price=10.0, **more)


def test_filled_order(log, one):
    row = one(snapshot(log, [event("NEW"), event("ROUTE", 100), fill(200, 100)]))
    assert (row.status, row.total_qty, row.filled_qty) == ("FILLED", 100, 100)
    assert row.last_event.event_type == "FILL" and row.trade_date == "2026-01-15"
    assert row.avg_exec_price == 10.0 and row.route_count == 1 and row.fill_count == 1


def test_latest_event_is_latest_by_time_then_by_name(log, one):
    row = one(snapshot(log, [event("NEW"), fill(300, 50), event("ROUTE", 100)]))
    assert row.last_event.event_type == "FILL"
    row = one(snapshot(log, [fill(300, 50), event("ROUTE", 300)]))
    assert row.last_event.event_type == "ROUTE"


def test_resent_fill_counts_once(log, one):
    row = one(snapshot(log, [event("NEW"), fill(5, 50), {**fill(5, 50), "ts_ingest": 9**13}]))
    assert (row.filled_qty, row.status) == (50, "PARTIALLY_FILLED")


def test_cancel_beats_fill_and_open_routed(log):
    rows = []
    for order, kinds in {"A": ["NEW", "FILL", "CANCEL"], "B": ["NEW"], "C": ["NEW", "ROUTE"],
                         "D": ["FILL"]}.items():
        rows += [event(k, i, customer_order_id=order) for i, k in enumerate(kinds)]
    status = {r.customer_order_id: (r.status, r.total_qty)
              for r in snapshot(log, rows).collect()}
    assert status == {"A": ("CANCELED", 100), "B": ("OPEN", 100), "C": ("ROUTED", 100),
                      "D": ("PARTIALLY_FILLED", None)}


def test_snapshot_columns_in_order(log):
    assert snapshot(log, [event("NEW")]).columns == [
        "customer_order_id", "last_event", "ts_first_event", "ts_last_event",
        "root_firm_order_id", "account_id", "symbol", "side", "total_qty", "filled_qty",
        "avg_exec_price", "route_count", "fill_count", "is_canceled", "has_late_events",
        "status", "is_provisional", "trade_date", "ts_snapshot"]


def test_one_row_per_day_and_whole_life_views(log):
    rows = [event("NEW"), fill(10, 60), fill(DAY, 40)]
    assert sorted(r.status for r in snapshot(log, rows).collect()) == [
        "PARTIALLY_FILLED", "PARTIALLY_FILLED"]
    for whole in (lc.lifecycle_multi_day(log(rows), 0), lc.lifecycle_sessions(log(rows), "2 days")):
        (row,) = whole.collect()
        assert (row.status, row.filled_qty, row.spans_days) == ("FILLED", 100, True)
    assert lc.lifecycle_sessions(log(rows), "6 hours").count() == 2


def test_as_of_sees_only_the_past(log, one):
    rows = [event("NEW"), event("ROUTE", 100), fill(200, 100)]
    assert one(lc.lifecycle_as_of(log(rows), BASE_MS + 150)).status == "ROUTED"


def test_detail_follows_the_documented_state(log, one):
    rows = [event("NEW", firm_order_id="ROOT"),
            event("ROUTE", 10, route_id="R2", firm_order_id="Z"),
            event("ROUTE", 5, route_id="R1", firm_order_id="Z"),
            event("FILL", 30, qty=40, exec_price=2.0, exec_id="X2"),
            event("FILL", 20, qty=20, exec_price=5.0, exec_id="X1"),
            event("CANCEL", 40)]
    row = one(lc.lifecycle_detail(log(rows)))
    assert row.root_firm_order_id == "ROOT" and row.vwap == 3.0
    assert row.active_routes == ["R1", "R2"]
    assert [(e.exec_id, e.qty) for e in row.executions] == [("X1", 20), ("X2", 40)]
    assert row.status == "PARTIALLY_FILLED"  # here a fill outranks the cancel


def test_detail_states_without_fills(log):
    rows = []
    for order, kinds in {"A": ["NEW", "REPLACE"], "B": ["NEW", "CANCEL", "REPLACE"],
                         "C": ["NEW", "REPLACE", "CANCEL"], "D": ["NEW", "REJECT"],
                         "E": ["NEW"]}.items():
        rows += [event(k, i, customer_order_id=order, reason=k) for i, k in enumerate(kinds)]
    found = {r.customer_order_id: r for r in lc.lifecycle_detail(log(rows)).collect()}
    assert {k: r.status for k, r in found.items()} == {
        "A": "REPLACED", "B": "REPLACED", "C": "CANCELED", "D": "REJECTED", "E": "OPEN"}
    assert found["D"].reject_reason == "REJECT"
    assert found["E"].active_routes == [] and found["E"].executions == []


def test_large_orders_list_their_parts_as_rows(log, one):
    rows = [event("NEW")] + [fill(i, 1, exec_id=f"X{i}") for i in range(1, 8)]
    parts = lc.lifecycle_detail(log(rows), part_rows=3).orderBy("part_no").collect()
    assert [(p.part_no, p.parts, p.execution_count) for p in parts] == [
        (0, 3, 7), (1, 3, 7), (2, 3, 7)]
    assert [e.exec_id for p in parts for e in p.executions] == [f"X{i}" for i in range(1, 8)]
    assert lc.order_executions(log(rows)).count() == 7


def test_an_order_of_twenty_thousand_parts(spark, log):
    i = F.col("id")
    fills = spark.range(20_000).select(
        F.concat(F.lit("e"), i).alias("event_id"), F.lit("FILL").alias("event_type"),
        F.lit(BASE_MS).alias("ts_event"), F.lit("O1").alias("customer_order_id"),
        F.concat(F.lit("X"), i).alias("exec_id"), F.lit(1).alias("qty"),
        F.lit(2.0).alias("exec_price"))
    events = log([event("NEW", qty=20_000)]).unionByName(fills, allowMissingColumns=True)
    parts = lc.lifecycle_detail(events).collect()
    assert [len(p.executions) for p in sorted(parts, key=lambda p: p.part_no)] == [10_000] * 2
    assert {e.exec_id for p in parts for e in p.executions} == {f"X{n}" for n in range(20_000)}
    steps = lc.lifecycle_replay(events).where("event_type = 'FILL'")
    assert steps.agg(F.count_distinct("filled_qty"), F.max("filled_qty")).first() == (
        20_000, 20_000)


def test_fills_without_price_are_not_in_vwap(log, one):
    row = one(lc.lifecycle_detail(log([event("NEW"), fill(1, 30),
                                       event("FILL", 2, qty=50, exec_id="X2")])))
    assert (row.filled_qty, row.vwap) == (80, 10.0)


def test_a_resting_order_is_one_lifecycle(log, one):
    rows = log([event("NEW"), fill(5 * DAY, 100), event("ROUTE", 5 * DAY + 5)])
    sessions = lc.lifecycle_sessions(rows)
    assert sessions.count() == 2
    whole, merged = lc.lifecycle_multi_day(rows, 0), lc.merge_sessions(sessions)
    row = one(merged)
    assert (row.status, row.total_qty, row.filled_qty, row.spans_days) == (
        "FILLED", 100, 100, True)
    shared = [c for c in whole.columns if c != "ts_snapshot"]
    assert set(shared) <= set(merged.columns)
    assert [row[c] for c in shared] == [one(whole)[c] for c in shared]


def test_replay_and_history_cross_chunks(log):
    """Events seconds and minutes apart fall into different chunks of the running totals."""
    rows = [event("NEW"), event("ROUTE", 10), fill(900, 30), fill(1_100, 30), fill(2_500, 40),
            event("BUST", 60_000, qty=40), event("CANCEL", 61_000)]
    steps = lc.lifecycle_replay(log(rows)).orderBy("ts_event").collect()
    assert [s.filled_qty for s in steps] == [0, 0, 30, 60, 100, 60, 60]
    assert [s.status for s in steps] == [
        "OPEN", "ROUTED", "PARTIALLY_FILLED", "PARTIALLY_FILLED", "FILLED",
        "PARTIALLY_FILLED", "CANCELED"]
    history = lc.order_history(log(rows)).orderBy("seq").collect()
    assert [h.seq for h in history] == list(range(1, 8))
    one_order = lc.order_history(log(rows), "O1").collect()
    assert [h.event_id for h in one_order] == [h.event_id for h in history]


def test_filled_before_cancel(log):
    rows = [event("NEW"), fill(10, 30), event("CANCEL", 20), fill(20, 5), fill(30, 7),
            event("CANCEL", 0, customer_order_id="O2"), event("NEW", customer_order_id="O3")]
    found = {r.customer_order_id: r.filled_before_cancel
             for r in lc.filled_before_cancel(log(rows)).collect()}
    assert found == {"O1": 30, "O2": 0}
    assert {r.customer_order_id: r.ts_first_execution - BASE_MS
            for r in lc.first_execution(log(rows)).collect()} == {"O1": 10}


def test_overfill_and_negative_fill(log):
    over = snapshot_exceptions(snapshot(log, [event("NEW"), fill(1, 60), fill(2, 60)]))
    assert [r.exception_type for r in over.collect()] == ["OVERFILL"]
    rows = [event("NEW"), fill(1, 50), event("BUST", 2, qty=50), event("BUST", 3, qty=50)]
    (row,) = snapshot_exceptions(snapshot(log, rows)).collect()
    assert row.exception_type == "NEGATIVE_FILL"
    assert row.metadata == '{"total_qty":100,"filled_qty":-50}'


def test_exception_ids_are_distinct_and_repeat(log):
    rows = [e for o in ("A", "B") for e in (
        event("NEW", customer_order_id=o), fill(1, 150, customer_order_id=o, event_id=f"x{o}"))]
    ids = [{r.exception_id for r in snapshot_exceptions(snapshot(log, rows)).collect()}
           for _ in range(2)]
    assert len(ids[0]) == 2 and ids[0] == ids[1]


def test_filled_without_executions(log):
    rows = [event("NEW", qty=0)]
    (row,) = snapshot_exceptions(snapshot(log, rows)).collect()
    assert row.exception_type == "FILLED_NO_EXECUTIONS"


def test_order_filter_reaches_the_scan(spark, log, tmp_path):
    log([event("NEW")]).write.parquet(str(tmp_path / "log"))
    events = spark.read.parquet(str(tmp_path / "log"))
    plan = lc.lifecycle_snapshot(events, 0).where(F.col("customer_order_id") == "O1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_order_id,O1)" in text and "corr_id" not in text
