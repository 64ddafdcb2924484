"""The streaming job: one event stream in; links, snapshots, exceptions, late events and audit
records out."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.columns import DEFAULT_DELAY
from orderloom.operators.events import (
    decodable,
    dedup_stream,
    late_events,
    quarantine,
    with_lateness,
)
from orderloom.operators.lifecycle import finalized_stream, lifecycle_snapshot
from orderloom.operators.linkage import linkages
from orderloom.operators.quality import (
    event_exceptions,
    snapshot_exceptions,
    split_by_severity,
)
from orderloom.operators.reconcile import audit_finalization, audit_late
from orderloom.streaming.corrections import start_corrections
from orderloom.streaming.live_checks import SPAN, WAIT, link_exceptions
from orderloom.streaming.sinks import write_append, write_console, write_snapshots

AVAILABLE_NOW = {"availableNow": True}


def start_pipeline(events: DataFrame, root: str, delay=DEFAULT_DELAY, dedup="event_time",
                   trigger=None, snapshot_ms=None, fmt="parquet", publish=None, debug=False,
                   topics=None, messages=None, as_of_ms=None, link_checks=False,
                   corrected=None, finalize=False, exceptions_table=None, **sink_options):
    """Start the queries on a stream of decoded events; the caller awaits them.

    The watermark comes first, so that the state of both stateful operators is bounded.
    Late events leave before those operators, which drop rows behind the watermark; each has an
    audit record. Rules on single events run beside those on snapshots, against `as_of_ms` (now,
    if None). With the stream of raw `messages`, those that are no event go to a quarantine
    output. `publish=sinks.to_table(path)` keeps a table of the newest snapshots.
    `link_checks=True` adds the checks between events (`live_checks`), `corrected`, a dict with the
    `log`, `table` and `partition_by` of `corrections.start_corrections`, the feedback of late events
    to a published table. `finalize=True` adds an audit record for every order-day that the watermark
    closes; an update after that is an UPDATE_AFTER_FINAL exception. `exceptions_table` is the path
    of a table of open and resolved snapshot exceptions by id.
    """
    tagged = with_lateness(decodable(events), delay)
    now = F.unix_millis(F.current_timestamp()) if as_of_ms is None else as_of_ms
    unique = dedup_stream(tagged, dedup)
    snapshots = lifecycle_snapshot(unique, snapshot_ms)

    def options(kind):
        return {**sink_options, "topic": topics[kind]} if topics else sink_options

    queries = [
        write_append(linkages(unique), "linkages", root, fmt, trigger, **options("linkages")),
        write_snapshots(snapshots, root, snapshot_exceptions, trigger, publish=publish,
                        exceptions_table=exceptions_table),
        write_append(late_events(tagged), "late_events", root, fmt, trigger,
                     **options("late_events")),
        write_append(audit_late(late_events(tagged), snapshot_ms), "audit", root, fmt, trigger,
                     **options("audit")),
        write_append(split_by_severity(event_exceptions(tagged, now))[0], "event_exceptions",
                     root, fmt, trigger, **options("event_exceptions")),
    ]
    if messages is not None:
        queries.append(write_append(quarantine(messages), "quarantine", root, fmt, trigger,
                                    key="key", **options("quarantine")))
    if finalize:
        queries.append(start_finalization(unique, root, snapshot_ms, fmt, trigger,
                                          **options("finalized")))
    if link_checks:
        queries.append(start_link_checks(tagged, root, fmt=fmt, trigger=trigger,
                                         **options("link_exceptions")))
    if corrected is not None:
        queries.append(start_corrections(late_events(tagged), root=f"{root.rstrip('/')}/corrected",
                                         snapshot_ms=snapshot_ms, audited_ms=snapshot_ms,
                                         trigger=trigger, **corrected))
    if debug:
        queries.append(write_console(snapshots, "lifecycle_console", trigger))
    return queries


def start_finalization(unique: DataFrame, root: str, audited_ms=None, fmt="parquet", trigger=None,
                       **options):
    """One LIFECYCLE_FINALIZED audit record for every order-day, when the watermark has closed the
    day and its state is gone."""
    return write_append(audit_finalization(finalized_stream(unique), audited_ms), "finalized", root,
                        fmt, trigger, **options)


def start_link_checks(tagged: DataFrame, root: str, wait=WAIT, span=SPAN, fmt="parquet",
                      trigger=None, **options):
    """The checks between events as a query of its own, on a stream of tagged events."""
    return write_append(link_exceptions(tagged, wait, span), "link_exceptions", root, fmt, trigger,
                        **options)


def run_pipeline(spark: SparkSession, events: DataFrame, root: str, **options):
    """Start the pipeline and wait: for all input with `availableNow`, else until a query ends."""
    queries = start_pipeline(events, root, **options)
    if options.get("trigger") == AVAILABLE_NOW:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    return queries
