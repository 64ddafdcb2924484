import json
import random

from conftest import BASE_MS, event
from pyspark.sql import functions as F

from orderloom.operators.events import (decodable, decode_events, dedup_events, encode_json,
                                        late_events, quarantine, tag_late, with_lateness)
from orderloom.operators.lifecycle import lifecycle_snapshot
from orderloom.schema import EVENT_FIELDS, MESSAGE_SCHEMA
from orderloom.sources.event_log import read_event_stream, read_messages


def messages(spark, payloads):
    rows = [("k", p, None, 0, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA).withColumn(
        "timestamp", F.timestamp_millis(F.lit(BASE_MS)))


def test_decode_gives_types_envelope_and_event_time(spark, one):
    row = one(decode_events(messages(spark, [json.dumps(event("NEW", 7))])))
    assert row.qty == 100 and row.offset == 0
    assert row.event_time.timestamp() * 1000 == BASE_MS + 7
    assert row.route_id is None


def test_quarantine_keeps_what_is_no_event(spark):
    good = json.dumps(event("NEW"))
    wrong_type = json.dumps(event("NEW", qty="many"))
    incomplete = json.dumps({k: v for k, v in event("NEW").items() if k != "symbol"})
    found = {r.offset: r.missing_fields for r in quarantine(
        messages(spark, [good, "oops", wrong_type, incomplete])).collect()}
    assert found[3] == "symbol" and "qty" in found[2]
    assert 0 not in found and len(found) == 3
    assert len(found[1].split(",")) == 11


def test_late_is_strictly_after_the_delay(log):
    rows = [event("ACK", 0, event_id="on time", ts_ingest=BASE_MS + 120_000),
            event("ACK", 0, event_id="late", ts_ingest=BASE_MS + 120_001)]
    late = late_events(log(rows))
    assert [r.event_id for r in late.collect()] == ["late"]
    assert late.columns == [*EVENT_FIELDS, "is_late"]


def test_dedup_keeps_the_earliest_arrival(log):
    rows = [event("FILL", 0, event_id="E", ts_ingest=BASE_MS + t) for t in (500, 20, 9_000)]
    rows.append(event("FILL", 1, event_id="E"))  # another event time: another event
    kept = dedup_events(log(rows)).collect()
    assert sorted(r.ts_ingest - BASE_MS for r in kept) == [1, 20]


def test_dedup_reduces_copies_before_the_shuffle(log):
    plan = dedup_events(log([event("NEW")]))._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning(")
    assert "Partial" in plan[shuffle:]


def test_order_and_copies_of_messages_do_not_matter(spark, log):
    rows = [event("NEW"), event("ROUTE", 10), event("FILL", 20, qty=40, exec_price=1.0),
            event("BUST", 30, qty=10), event("FILL", 20, qty=60, exec_price=2.0,
                                             event_id="second")]
    expected = lifecycle_snapshot(dedup_events(log(rows)), 0).collect()
    shuffled = rows * 3
    random.Random(1).shuffle(shuffled)
    assert lifecycle_snapshot(dedup_events(log(shuffled)), 0).collect() == expected


def test_encode_leaves_out_nulls_and_adds_key(log, one):
    row = one(encode_json(log([event("NEW")]).select("customer_order_id", "route_id"),
                          "customer_order_id"))
    assert (row.key, row.value) == ("O1", '{"customer_order_id":"O1"}')


def test_tag_late_needs_no_event_time_column(log):
    frame = log([event("NEW")]).drop("event_time", "is_late")
    assert "is_late" in tag_late(frame, "10 seconds").columns


def test_reject_reason_is_decoded(spark):
    from orderloom.schema import EVENT_SCHEMA_WITH_REJECT
    body = '{"event_id": "E", "event_type": "REJECT", "ts_event": 5, "reject_reason": "closed"}'
    messages = spark.createDataFrame([("k", body, 0, 0, 0)], "key string, value string, ms long, "
                                     "partition int, offset long").withColumn(
        "timestamp", F.timestamp_millis("ms"))
    (row,) = decode_events(messages, EVENT_SCHEMA_WITH_REJECT).collect()
    assert (row.event_type, row.reject_reason) == ("REJECT", "closed")


def test_a_message_is_parsed_once(spark, tmp_path, capsys):
    """However many checks and fields follow, the plan holds one parser, in batch and stream."""
    path = str(tmp_path / "topic")
    messages(spark, [json.dumps(event("NEW", 7))]).write.parquet(path)

    def parsers():
        plan = capsys.readouterr().out.lower()
        assert "generate" in plan
        return plan.count("from_json") + plan.count("jsontostructs")

    events = decodable(tag_late(decode_events(read_messages(spark, path))))
    capsys.readouterr()
    lifecycle_snapshot(dedup_events(events)).explain()
    assert parsers() == 1

    stream = decodable(with_lateness(read_event_stream(spark, "parquet", path)))
    query = stream.writeStream.format("noop").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).start()
    query.awaitTermination()
    capsys.readouterr()
    query.explain()
    assert parsers() == 1
