"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Structs are flattened, arrays joined to text and doubles rounded, so that a result can be
compared with SQL by value.
"""

import itertools

from pyspark.sql import functions as F

from orderloom.operators import events as ev
from orderloom.operators import lifecycle as lc
from orderloom.operators import linkage as lk
from orderloom.operators import quality as dq
from orderloom.operators import reconcile as rc
from orderloom.operators import reports as rp
from orderloom.operators import sketches as sk
from orderloom.plans.workspace import (
    AS_OF_MS,
    INDEX_SLOTS,
    SNAPSHOT_MS,
    Workspace,
    write_topic,
)
from orderloom.schema import AUDIT_FIELDS, EVENT_FIELDS, EXCEPTION_FIELDS
from orderloom.session import cut_lineage, work_folder
from orderloom.sources import derived, tables
from orderloom.sources.event_log import read_event_stream, read_message_stream
from orderloom.streaming import corrections, enrichment, pipeline, progress, sinks

ORDER = "customer_order_id"
DELAY = "2 minutes"
QUERIES = {}
WRONG_LINKS = [("a1", "a2"), ("a2", "a3"), ("a3", "a1"), ("s", "s"), ("a3", "p"), ("p", "b1"),
               ("b1", "b2"), ("b2", "b1")]


def query(build):
    """Register `build(workspace)` under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Workspace(spark, sf_dir))
    return build


def _flat_events(df):
    return (df.select(*EVENT_FIELDS, F.unix_millis("kafka_timestamp").alias("arrived_ms"),
                      "partition", "offset", F.unix_millis("event_time").alias("event_ms")))


def _flat_snapshot(df, *more):
    return df.select(
        ORDER, "trade_date", F.col("last_event.ts_event").alias("last_ts"),
        F.col("last_event.event_type").alias("last_type"), "ts_first_event", "ts_last_event",
        "root_firm_order_id", "account_id", "symbol", "side", "total_qty", "filled_qty",
        F.round("avg_exec_price", 6).alias("avg_exec_price"), "route_count", "fill_count",
        "is_canceled", "has_late_events", "status", "is_provisional", "ts_snapshot", *more)


# --- events -------------------------------------------------------------------------------

@query
def decode_events(w):
    return _flat_events(ev.decode_events(w.topic()))


@query
def late_flag(w):
    return ev.with_lateness(w.decoded().drop("is_late"), DELAY).select(
        "event_id", "ts_event", "ts_ingest", "is_late")


@query
def dedup_events(w):
    return _flat_events(ev.dedup_events(w.event_log()))


@query
def late_events(w):
    return ev.late_events(w.event_log())


@query
def encode_json(w):
    return ev.encode_json(lk.linkages(w.unique_events()), ORDER)


@query
def quarantine(w):
    """The topic with another producer's messages mixed in."""
    mixed = w.topic().unionByName(derived.foreign_messages(w.spark, w.sf_dir))
    return ev.quarantine(mixed).select("partition", "offset", "value", "missing_fields")


# --- lifecycles ---------------------------------------------------------------------------

@query
def lifecycle_snapshot(w):
    """The main path: deduplicate the raw log, aggregate by day and order."""
    return _flat_snapshot(lc.lifecycle_snapshot(ev.dedup_events(w.event_log()), SNAPSHOT_MS))


@query
def lifecycle_from_messages(w):
    """The whole chain from the stored JSON messages: decode, tag, deduplicate, aggregate. The
    messages are read twice, so that only those that may have a copy are moved one by one."""
    events = ev.decodable(w.decoded())
    return _flat_snapshot(lc.lifecycle_snapshot(
        ev.dedup_events(events, stored=True), SNAPSHOT_MS))


@query
def lifecycle_as_of(w):
    return _flat_snapshot(lc.lifecycle_as_of(w.unique_events(), AS_OF_MS, SNAPSHOT_MS))


def _flat_multi_day(df):
    return df.select(
        ORDER, "first_trade_date", "last_trade_date", "spans_days", "ts_first_event",
        "ts_last_event", "total_qty", "filled_qty", "status", "has_late_events")


@query
def lifecycle_multi_day(w):
    return _flat_multi_day(lc.lifecycle_multi_day(w.unique_events(), SNAPSHOT_MS))


@query
def lifecycle_sessions(w):
    """A pause of a fifth of a second closes a session here, so that most orders have several."""
    return _flat_multi_day(lc.merge_sessions(
        lc.lifecycle_sessions(w.unique_events(), "200 milliseconds", SNAPSHOT_MS)))


def _flat_detail(df):
    execution = F.transform("executions", lambda e: F.concat_ws(
        ":", e["exec_id"], e["qty"].cast("string"), e["ts_event"].cast("string")))
    return df.select(
        ORDER, "root_firm_order_id", "account_id", "symbol", "side", "total_qty", "filled_qty",
        F.round("vwap", 6).alias("vwap"), "status", "reject_reason",
        F.concat_ws(",", "active_routes").alias("active_routes"),
        F.concat_ws(",", execution).alias("executions"),
        "route_count", "execution_count", "allocated_qty", "ts_first_event", "ts_last_event",
        "is_provisional", "parts", "part_no")


@query
def lifecycle_detail(w):
    return _flat_detail(lc.lifecycle_detail(w.unique_events()))


@query
def lifecycle_detail_parts(w):
    """Parts of three routes and executions, so that most orders have several."""
    return _flat_detail(lc.lifecycle_detail(w.unique_events(), 3))


@query
def lifecycle_detail_ext(w):
    """With rejections and allocations among the events."""
    return _flat_detail(lc.lifecycle_detail(w.extended_events()))


@query
def order_executions(w):
    return lc.order_executions(w.unique_events())


@query
def order_routes(w):
    return lc.order_routes(w.unique_events())


@query
def first_execution(w):
    return lc.first_execution(w.unique_events())


@query
def filled_before_cancel(w):
    return lc.filled_before_cancel(w.unique_events())


@query
def lifecycle_replay(w):
    return lc.lifecycle_replay(w.unique_events())


@query
def order_history(w):
    return lc.order_history(w.unique_events())


# --- links --------------------------------------------------------------------------------

@query
def linkages(w):
    return lk.linkages(ev.dedup_events(w.event_log(), stored=True))


@query
def linkages_ext(w):
    return lk.linkages(w.extended_events(), with_extensions=True)


@query
def execution_trace(w):
    return lk.execution_trace(w.unique_events())


@query
def descendants(w):
    return lk.descendants(w.unique_events())


@query
def descendants_of(w):
    """A node whose NEW event is lost, with chains of replacements and routes below it."""
    events = w.unique_events().unionByName(derived.replaced_again(w.unique_events()))
    lost = F.substring(F.col(ORDER), 4, 20).cast("long") % 101 == 0
    root = events.where((F.col("event_type") == "REPLACE") & lost).agg(
        F.min("parent_firm_order_id")).first()[0]
    return lk.descendants_of(events, root)


def _linked_back(w):
    """The links, with wrong ones added: every 13th urgent order's replacement is linked back to
    what it replaced; and in every 17th order a ring of three, a node linked to itself, and a
    path from the ring to a pair that is linked both ways."""
    edges = lk.linkages(w.unique_events())
    number = F.substring(F.col(ORDER), 4, 20).cast("long")
    back = edges.where((F.col("edge_type") == "REPLACE") & (number % 13 == 0)).select(
        "edge_id", "edge_type", F.col("target_id").alias("source_id"),
        F.col("source_id").alias("target_id"), ORDER, "ts_event")
    wrong = edges.where((F.col("edge_type") == "ROOT") & (number % 17 == 0)).select(
        "edge_id", "edge_type", ORDER, "ts_event", F.explode(F.array(*[
            F.struct(F.lit(a).alias("source_id"), F.lit(b).alias("target_id"))
            for a, b in WRONG_LINKS])).alias("e")).select("*", "e.*").drop("e")
    return edges.unionByName(back).unionByName(wrong)


@query
def circular_linkage(w):
    return lk.circular_linkage(_linked_back(w))


@query
def circular_exceptions(w):
    return lk.circular_exceptions(_linked_back(w))


# --- quality ------------------------------------------------------------------------------

@query
def quality_exceptions(w):
    return dq.snapshot_exceptions(w.snapshots(), detected_ms=SNAPSHOT_MS)


@query
def overfill(w):
    return dq.snapshot_exceptions(w.snapshots(), ["OVERFILL"])


@query
def negative_fill(w):
    return dq.snapshot_exceptions(w.snapshots(), ["NEGATIVE_FILL"])


@query
def missing_required_id(w):
    return dq.event_exceptions(w.unique_events(), AS_OF_MS, ["MISSING_REQUIRED_ID"])


@query
def temporal_checks(w):
    return dq.event_exceptions(w.unique_events(), AS_OF_MS, [
        "FUTURE_TIMESTAMP", "STALE_EVENT", "INGEST_BEFORE_EVENT"])


@query
def sequence_new(w):
    return dq.order_exceptions(w.unique_events(), ["ROUTE_BEFORE_NEW", "FILL_BEFORE_NEW"])


@query
def price_checks(w):
    return dq.order_exceptions(w.unique_events(), [
        "INVALID_PRICE", "PRICE_DEVIATION", "PRICE_ABOVE_LIMIT"])


@query
def sequence_route(w):
    return dq.route_exceptions(w.unique_events(), ["ACK_BEFORE_ROUTE", "FILL_BEFORE_ACK"])


@query
def route_no_outcome(w):
    """Rejected routes have an outcome."""
    return dq.route_exceptions(w.extended_events(), ["ROUTE_NO_OUTCOME"])


@query
def missing_parent(w):
    return dq.missing_parent(w.unique_events())


@query
def orphaned_execution(w):
    return dq.orphaned_execution(w.unique_events())


@query
def route_overallocation(w):
    return dq.route_overallocation(w.unique_events())


@query
def allocation_check(w):
    return dq.allocation_check(w.extended_events())


@query
def all_exceptions(w):
    return dq.all_exceptions(w.unique_events(), w.snapshots(), AS_OF_MS)


# --- reconciliation -----------------------------------------------------------------------

def _late(w):
    return w.event_log().where("is_late")


@query
def reconcile_late(w):
    return _flat_snapshot(
        rc.reconcile_late(w.event_log(), _late(w), w.published(), SNAPSHOT_MS), "is_corrected")


@query
def reconcile_table(w):
    """The published table by month, corrected in place from the log by month."""
    path = w.fresh_folder("published")
    tables.write_snapshot_table(tables.with_month(w.published()), path, ("trade_month",))
    rc.correct_table(w.spark, w.monthly_log(), _late(w), path, ("trade_month",), SNAPSHOT_MS)
    return _flat_snapshot(tables.read_snapshot_table(w.spark, path))


@query
def audit_late(w):
    return rc.audit_late(ev.dedup_events(_late(w)), SNAPSHOT_MS)


@query
def audit_corrections(w):
    return rc.audit_corrections(w.published(), w.snapshots(), _late(w), SNAPSHOT_MS)


@query
def audit_finalization(w):
    return rc.audit_finalization(rc.mark_finalized(w.snapshots(), AS_OF_MS), SNAPSHOT_MS)


@query
def updates_after_final(w):
    """With busts that come three days late."""
    events = w.unique_events()
    return rc.updates_after_final(events.unionByName(derived.after_final(events)), 120_000)


@query
def comparative_review(w):
    return rc.comparative_review(
        w.unique_events(), *w.internal_records())


@query
def review_exceptions(w):
    """The review's differences in the layout of exceptions."""
    return rc.review_exceptions(rc.comparative_review(
        w.unique_events(), *w.internal_records()))


@query
def match_rate(w):
    return rc.match_rate(
        w.unique_events(), *w.internal_records()).select(
        "orders", "matched", F.round("match_rate", 6).alias("match_rate"))


# --- reports ------------------------------------------------------------------------------

@query
def events_by_type(w):
    return rp.events_by_type(w.event_log())


@query
def exceptions_by_type(w):
    return rp.exceptions_by_type(w.exceptions())


@query
def status_distribution(w):
    return rp.status_distribution(w.snapshots())


@query
def event_rate(w):
    return rp.event_rate(w.event_log())


@query
def duplicate_ids(w):
    return rp.duplicate_ids(w.event_log())


@query
def idempotency_report(w):
    return rp.idempotency_report(w.event_log())


@query
def late_rate_by_delay(w):
    return rp.late_rate_by_delay(w.event_log()).select(
        "delay", "events", "late", F.round("late_rate", 6).alias("late_rate"))


@query
def exception_rate(w):
    return rp.exception_rate(w.exceptions(), w.snapshots()).select(
        "exception_type", "n", "lifecycles", F.round("rate", 6).alias("rate"))


@query
def severity_distribution(w):
    return rp.severity_distribution(w.exceptions())


@query
def exception_trend(w):
    return rp.exception_trend(w.exceptions())


@query
def top_exception_symbols(w):
    return rp.top_exception_symbols(w.exceptions())


@query
def top_exception_orders(w):
    return rp.top_exception_orders(w.exceptions())


@query
def log_stats(w):
    return rp.pipeline_stats(w.event_log(), w.unique_events(), w.snapshots(), w.exceptions())


@query
def completion_percentiles(w):
    return rp.completion_percentiles(w.snapshots()).select(
        "lifecycles", *[F.round(c, 6).alias(c)
                        for c in ("mean_ms", "p50_ms", "p95_ms", "p99_ms")])


@query
def sketched_percentiles(w):
    """Years from the stored sketches of their days, and whether the ranks hold the bound."""
    path = f"{work_folder(w.spark, 'sketches')}/days"
    tables.write_snapshot_table(tables.with_month(sk.day_sketches(w.snapshots())), path,
                                ("trade_month",))
    year = F.substring("trade_date", 1, 4).alias("year")
    found = cut_lineage(sk.sketched_percentiles(sk.merge_sketches(
        w.spark.read.parquet(path), year)), "sketched")
    errors = sk.rank_errors(w.snapshots().select("*", year), found, "year")
    return found.select("year", "lifecycles", F.round("mean_ms", 6).alias("mean_ms")).join(
        errors.select("year", *[(F.col(f"{p}_ms") <= sk.rank_bound()).alias(f"{p}_holds")
                                for p in ("p50", "p95", "p99")]), "year")


@query
def mean_latency(w):
    return rp.mean_latency(w.snapshots()).select(
        F.round("mean_latency_ms", 3).alias("mean_latency_ms"))


@query
def overfilled(w):
    return rp.overfilled(w.snapshots())


@query
def slow_lifecycles(w):
    return rp.slow_lifecycles(w.snapshots(), 1_000)


@query
def lifecycle_lookup(w):
    return _flat_snapshot(rp.lifecycle_lookup(w.snapshot_table(), symbol="SYM7", status="FILLED"))


@query
def lifecycle_lookup_day(w):
    return _flat_snapshot(rp.lifecycle_lookup(w.snapshot_table(), trade_date="1995-06-02"))


@query
def lifecycle_lookup_order(w):
    """By order id, through the index."""
    return _flat_snapshot(tables.find(
        w.snapshot_table(), w.order_index(), "CO-33", ["trade_month"], slots=INDEX_SLOTS))


@query
def lifecycle_page(w):
    return _flat_snapshot(rp.lifecycle_page(
        w.snapshot_table(), 50, after=("CO-2", "1995-01-01"), status="PARTIALLY_FILLED"))


@query
def latest_snapshots(w):
    return _flat_snapshot(rp.latest_snapshots(w.snapshot_table(), AS_OF_MS))


@query
def expire(w):
    return _flat_snapshot(rp.expire(w.snapshot_table(), AS_OF_MS, 30))


@query
def enrich_customer(w):
    return rp.enrich_customer(
        w.snapshots(), derived.customer_accounts(w.spark, w.sf_dir)).select(
        ORDER, "trade_date", "account_id", "status", "customer_name", "segment", "nation_key")


# --- tables and streams -------------------------------------------------------------------

@query
def write_snapshot_table(w):
    """By trading day; a second write replaces the days it holds."""
    path = w.fresh_folder("snapshot_table")
    tables.write_snapshot_table(w.published(), path, ("trade_date",))
    tables.write_snapshot_table(w.snapshots(), path, ("trade_date",))
    return _flat_snapshot(tables.read_snapshot_table(w.spark, path))


def _stream(w, **options):
    return read_event_stream(w.spark, "parquet", w.topic_path(), **options)


def _unique_stream(w):
    return ev.dedup_stream(ev.with_lateness(_stream(w), DELAY))


def _finish(*queries):
    for q in queries:
        q.awaitTermination()
    return queries


NOW = pipeline.AVAILABLE_NOW


def _as_it_arrives(w, run, parts=3):
    """`run(path)` on a topic that grows by a stretch of arrival time before each run, so that every
    run is a micro-batch (or more) and goes on from the checkpoint of the one before. The messages
    come from the log, so that each is written once."""
    path, topic = w.fresh_folder("topic"), w.messages()
    first, last = topic.agg(F.unix_millis(F.min("timestamp")),
                            F.unix_millis(F.max("timestamp"))).first()
    stretch = (last - first) // parts + 1
    for i in range(parts):
        write_topic(topic.where(F.expr(
            f"(unix_millis(timestamp) - {first}) div {stretch} = {i}")), path)
        _finish(run(path))


@query
def read_event_stream_files(w):
    """One file per micro-batch."""
    root = w.fresh_folder("stream")
    _finish(sinks.write_batches(
        _stream(w, maxFilesPerTrigger=1), "events", root, trigger=NOW))
    return _flat_events(sinks.read_batches(w.spark, f"{root}/events"))


@query
def write_append(w):
    """Links of the streamed log, as keyed JSON messages in files."""
    root = w.fresh_folder("stream")
    _finish(sinks.write_append(lk.linkages(_unique_stream(w)), "linkages", root, trigger=NOW))
    return w.spark.read.parquet(f"{root}/linkages")


@query
def write_snapshots(w):
    """Snapshots of the streamed log, newest version per order and day."""
    root = w.fresh_folder("stream")
    _finish(sinks.write_snapshots(
        lc.lifecycle_snapshot(_unique_stream(w), SNAPSHOT_MS), root, dq.snapshot_exceptions,
        NOW))
    return _flat_snapshot(
        sinks.read_newest(w.spark, f"{root}/lifecycle", [ORDER, "trade_date"]))


@query
def run_streaming_job(w):
    """The whole job; returns the exceptions it wrote."""
    root = w.fresh_folder("stream")
    pipeline.run_pipeline(w.spark, _stream(w), root, delay=DELAY, trigger=NOW,
                          snapshot_ms=SNAPSHOT_MS)
    return sinks.read_newest(w.spark, f"{root}/exceptions", ["exception_id"])


@query
def events_by_type_stream(w):
    """Running counts in complete mode, one file per micro-batch."""
    root = w.fresh_folder("stream")
    counts = rp.events_by_type(_stream(w, maxFilesPerTrigger=1))
    _finish(sinks.write_batches(counts, "counts", root, "complete", NOW))
    return sinks.read_newest(w.spark, f"{root}/counts", ["event_type"])


@query
def finalized_lifecycles(w):
    """Append mode: only days the watermark has closed."""
    root = w.fresh_folder("stream")
    _finish(sinks.write_batches(
        lc.finalized_stream(_unique_stream(w), SNAPSHOT_MS), "final", root, trigger=NOW))
    return _flat_snapshot(sinks.read_batches(w.spark, f"{root}/final"), "is_finalized")


@query
def lifecycle_multi_day_stream(w):
    """Append mode: orders across days, once they were quiet for two days."""
    root = w.fresh_folder("stream")
    _finish(sinks.write_batches(
        lc.lifecycle_sessions(_unique_stream(w), "2 days", SNAPSHOT_MS), "orders", root,
        trigger=NOW))
    return _flat_multi_day(lc.merge_sessions(sinks.read_batches(w.spark, f"{root}/orders")))


@query
def enrich_customer_stream(w):
    """New orders of a growing topic with the reference data valid when they were processed: the
    accounts change before each of three stretches of arrival time."""
    root, accounts = w.fresh_folder("stream"), w.fresh_folder("accounts")
    base, version = derived.customer_accounts(w.spark, w.sf_dir), itertools.count()

    def run(path):
        base.withColumn("segment", F.concat("segment", F.lit(f" v{next(version)}"))).write.mode(
            "overwrite").parquet(accounts)
        created = read_event_stream(w.spark, "parquet", path).where("event_type = 'NEW'").select(
            "event_id", "partition", "offset", ORDER, "account_id")
        return enrichment.start_enrichment(
            created, lambda spark: spark.read.schema(base.schema).parquet(accounts), root, NOW)

    _as_it_arrives(w, run)
    return sinks.read_batches(w.spark, f"{root}/enriched")


def _measured(w):
    """The streamed links, followed by a progress log."""
    root = w.fresh_folder("stream")
    log = progress.ProgressLog(w.spark, f"{root}/progress")
    w.spark.streams.addListener(log)
    try:
        queries = _finish(sinks.write_append(
            lk.linkages(_unique_stream(w)), "linkages", root, trigger=NOW))
        log.wait_for(queries)
    finally:
        w.spark.streams.removeListener(log)
    return root, progress.progress_table(w.spark, f"{root}/progress")


@query
def progress_table(w):
    return _measured(w)[1].groupBy("query").agg(F.sum("input_rows").alias("input_rows"))


@query
def throughput_report(w):
    """Without its measured rates."""
    return rp.throughput_report(_measured(w)[1]).select("query", "input_rows")


@query
def quarantine_stream(w):
    """The job on a topic with another producer's messages in it: what it put aside."""
    root, mixed = w.fresh_folder("stream"), w.fresh_folder("topic")
    write_topic(w.messages(), mixed)
    write_topic(derived.foreign_messages(w.spark, w.sf_dir), mixed)
    pipeline.run_pipeline(
        w.spark, read_event_stream(w.spark, "parquet", mixed), root, delay=DELAY, trigger=NOW,
        snapshot_ms=SNAPSHOT_MS, messages=read_message_stream(w.spark, "parquet", mixed))
    return w.spark.read.parquet(f"{root}/quarantine").select(F.from_json(
        "value", "`partition` int, offset long, value string, missing_fields string").alias("m")
        ).select("m.*")


@query
def event_exceptions_stream(w):
    """Rules on single events inside the job. The messages travel as digests of 128 bits, as their
    exception ids are."""
    root = w.fresh_folder("stream")
    pipeline.run_pipeline(w.spark, _stream(w), root, delay=DELAY, trigger=NOW,
                          snapshot_ms=SNAPSHOT_MS, as_of_ms=AS_OF_MS)
    return w.spark.read.parquet(f"{root}/event_exceptions").groupBy(
        F.get_json_object("value", "$.exception_type").alias("exception_type")).agg(
        F.countDistinct(F.unhex(F.md5("value"))).alias("n"))


@query
def read_state(w):
    """What the streaming deduplication remembers."""
    root, _ = _measured(w)
    state = progress.read_state(w.spark, sinks.checkpoint_path(root, "linkages"))
    return state.select("key.event_id", F.unix_millis("key.event_time").alias("event_ms"))


@query
def live_link_checks(w):
    """The checks between events of the running stream, over several micro-batches and restarts."""
    root = w.fresh_folder("stream")
    _as_it_arrives(w, lambda path: pipeline.start_link_checks(
        ev.with_lateness(read_event_stream(w.spark, "parquet", path), DELAY), root, trigger=NOW))
    return w.spark.read.parquet(f"{root}/link_exceptions").select(F.from_json("value", ", ".join(
        f"{c} string" for c in EXCEPTION_FIELDS)).alias("e")).select(
        *[f"e.{c}" for c in EXCEPTION_FIELDS if c not in ("event_id", "ts_event")])


def _corrected(w):
    """A published table that lacks the late events, corrected as they arrive."""
    root, table = w.fresh_folder("stream"), w.fresh_folder("published")
    tables.write_snapshot_table(tables.with_month(w.published()), table, ("trade_month",))
    w.event_log()  # written before the stream starts
    _as_it_arrives(w, lambda path: corrections.start_corrections(
        ev.late_events(ev.with_lateness(read_event_stream(w.spark, "parquet", path), DELAY)),
        w.event_log, table, root, ("trade_month",), SNAPSHOT_MS, SNAPSHOT_MS, NOW))
    return root, table


@query
def corrected_table_stream(w):
    return _flat_snapshot(tables.read_snapshot_table(w.spark, _corrected(w)[1]))


@query
def correction_audit_stream(w):
    return sinks.read_batches(w.spark, f"{_corrected(w)[0]}/audit")


def _arriving(w, path):
    return ev.dedup_stream(ev.with_lateness(read_event_stream(w.spark, "parquet", path), DELAY))


@query
def open_exceptions_stream(w):
    """Exceptions of the streamed snapshots by id, as they stand after several micro-batches."""
    root = w.fresh_folder("stream")
    _as_it_arrives(w, lambda path: sinks.write_snapshots(
        lc.lifecycle_snapshot(_arriving(w, path), SNAPSHOT_MS), root, dq.snapshot_exceptions, NOW,
        exceptions_table=f"{root}/exceptions_by_id"))
    return sinks.read_exceptions(w.spark, f"{root}/exceptions_by_id").select(*EXCEPTION_FIELDS)


@query
def finalization_stream(w):
    """Audit records of the days that the stream has closed. Without the states, which lack the late
    events that deduplication drops."""
    root = w.fresh_folder("stream")
    _as_it_arrives(w, lambda path: pipeline.start_finalization(
        _arriving(w, path), root, SNAPSHOT_MS, trigger=NOW))
    return w.spark.read.parquet(f"{root}/finalized").select(F.from_json("value", ", ".join(
        f"{c} string" for c in AUDIT_FIELDS)).alias("a")).select(
        "a.action", f"a.{ORDER}", "a.reason",
        F.get_json_object("a.new_state", "$.status").alias("status"),
        F.get_json_object("a.new_state", "$.filled_qty").cast("long").alias("filled_qty"))
