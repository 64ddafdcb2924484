from conftest import BASE_MS, event

from orderloom.operators import quality as dq
from orderloom.operators.lifecycle import lifecycle_snapshot

YEAR = 365 * 86_400_000


def kinds(found):
    return sorted((r.exception_type, r.event_id) for r in found.collect())


def test_sequence_against_the_new_event(log):
    rows = log([event("NEW", 100), event("ROUTE", 50, event_id="r"),
                event("FILL", 99, event_id="f", exec_price=1.0), event("ROUTE", 100),
                event("FILL", 0, customer_order_id="no NEW")])
    found = dq.order_exceptions(rows, ["ROUTE_BEFORE_NEW", "FILL_BEFORE_NEW"])
    assert kinds(found) == [("FILL_BEFORE_NEW", "f"), ("ROUTE_BEFORE_NEW", "r")]


def test_prices(log):
    rows = [event("NEW", limit_price=100.0)]
    for name, price in {"ok": 105.0, "above": 105.1, "far": 110.1, "low": 89.0, "zero": 0.0,
                        "none": None}.items():
        rows.append(event("FILL", 5, event_id=name, exec_price=price))
    rows.append(event("FILL", 5, event_id="no limit", customer_order_id="O2", exec_price=9e9))
    assert kinds(dq.order_exceptions(log(rows))) == [
        ("INVALID_PRICE", "zero"), ("PRICE_ABOVE_LIMIT", "above"), ("PRICE_ABOVE_LIMIT", "far"),
        ("PRICE_DEVIATION", "far"), ("PRICE_DEVIATION", "low"), ("PRICE_DEVIATION", "zero")]


def test_route_sequence_and_outcome(log):
    rows = log([
        event("ROUTE", 10, route_id="R1"), event("ACK", 5, route_id="R1"),
        event("ROUTE", 10, route_id="R2"), event("ACK", 20, route_id="R2"),
        event("FILL", 15, route_id="R2"), event("ROUTE", 10, route_id="R3"),
        event("ROUTE", 10, route_id="R4"), event("REJECT", 11, route_id="R4"),
        event("FILL", 12, route_id="R5")])
    found = {(r.exception_type, r.metadata) for r in dq.route_exceptions(rows).collect()}
    assert found == {("ACK_BEFORE_ROUTE", '{"route_id":"R1"}'),
                     ("FILL_BEFORE_ACK", '{"route_id":"R2"}'),
                     ("ROUTE_NO_OUTCOME", '{"route_id":"R3"}')}


def test_required_ids_and_times(log):
    rows = log([
        event("ROUTE", event_id="no parent", route_id="R"),
        event("ROUTE", event_id="empty route", route_id="", parent_firm_order_id="P"),
        event("FILL", event_id="no exec", route_id="R"),
        event("FILL", event_id="complete", route_id="R", exec_id="X"),
        event("ACK", 1, event_id="future"), event("ACK", -YEAR - 1, event_id="stale"),
        event("ACK", 0, event_id="early", ts_ingest=BASE_MS - 1)])
    assert kinds(dq.event_exceptions(rows, BASE_MS)) == [
        ("FUTURE_TIMESTAMP", "future"), ("INGEST_BEFORE_EVENT", "early"),
        ("MISSING_REQUIRED_ID", "empty route"), ("MISSING_REQUIRED_ID", "no exec"),
        ("MISSING_REQUIRED_ID", "no parent"), ("STALE_EVENT", "stale")]


def test_unknown_parents_and_routes(log):
    rows = log([
        event("NEW"), event("ROUTE", 1, event_id="good", firm_order_id="F2", route_id="R1",
                            parent_firm_order_id="F1"),
        event("ROUTE", 2, event_id="child of route", parent_firm_order_id="F2", route_id="R2"),
        event("REPLACE", 3, event_id="bad", parent_firm_order_id="F?"),
        event("ROUTE", 4, event_id="null parent"),
        event("ROUTE", 5, event_id="other order", customer_order_id="O2",
              firm_order_id="F7", parent_firm_order_id="F1"),
        event("FILL", 6, event_id="orphan", route_id="R9"),
        event("FILL", 7, event_id="kept", route_id="R1")])
    assert [e for _, e in kinds(dq.missing_parent(rows))] == [
        "bad", "child of route", "other order"]
    assert [e for _, e in kinds(dq.missing_parent(rows, ("NEW", "ROUTE")))] == [
        "bad", "other order"]
    assert [e for _, e in kinds(dq.orphaned_execution(rows))] == ["orphan"]


def test_allocations(log):
    def part(exec_id, qty, after):
        return event("ALLOCATE", after, exec_id=exec_id, qty=qty, event_id=f"a{exec_id}{after}")
    rows = log([event("FILL", i, exec_id=x, qty=100) for i, x in enumerate("ABC")]
               + [part("A", 60, 10), part("A", 40, 11), part("B", 99, 12), part("D", 5, 13)])
    found = {r.metadata for r in dq.allocation_check(rows).collect()}
    assert found == {'{"executed_qty":100,"allocated_qty":99}',
                     '{"executed_qty":0,"allocated_qty":5}'}


def test_overallocation(log):
    rows = log([event("NEW"), event("ROUTE", 1, qty=60), event("ROUTE", 2, qty=41),
                event("NEW", customer_order_id="O2"),
                event("ROUTE", 1, customer_order_id="O2", qty=100)])
    (row,) = dq.route_overallocation(rows).collect()
    assert (row.customer_order_id, row.metadata) == (
        "O1", '{"total_qty":100,"routed_qty":101}')


def test_all_in_one_frame_split_by_severity(log):
    events = log([event("NEW"), event("FILL", 1, qty=200, exec_price=0.0),
                  event("ROUTE", 2, route_id="R1", parent_firm_order_id="F1")])
    found = dq.all_exceptions(events, lifecycle_snapshot(events, 0), BASE_MS + 9, 77)
    table, log_only = dq.split_by_severity(found)
    assert {r.exception_type for r in table.collect()} == {
        "OVERFILL", "MISSING_REQUIRED_ID", "INVALID_PRICE", "ROUTE_NO_OUTCOME"}
    assert log_only.count() == 0
    assert {r.ts_detected for r in found.collect()} == {77}
    assert found.select("exception_id").distinct().count() == found.count()
