"""Late events, corrections with an audit trail, and review against other records.

The names of actions and discrepancies and the reasons in audit records are fixed values.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.columns import content_id, on_type, state_json, trade_date
from orderloom.operators.events import dedup_events
from orderloom.operators.lifecycle import lifecycle_snapshot
from orderloom.operators.skew import join_facts
from orderloom.schema import AUDIT_FIELDS
from orderloom.session import cut_lineage
from orderloom.sources.tables import read_snapshot_table, with_month, write_snapshot_table

ORDER = "customer_order_id"
DAY_KEY = [ORDER, "trade_date"]
# the columns of a snapshot that an audit record shows
STATE = ["status", "total_qty", "filled_qty", "fill_count", "route_count", "ts_first_event",
         "ts_last_event", "is_provisional"]


def audit_late(late: DataFrame, audited_ms=None) -> DataFrame:
    """One LATE_EVENT_RECEIVED record per late event."""
    return late.select(
        content_id(F.lit("LATE_EVENT_RECEIVED"), F.col("event_id"), F.col("ts_event"))
        .alias("audit_id"),
        F.lit("LATE_EVENT_RECEIVED").alias("action"), ORDER,
        F.lit("Event arrived after watermark").alias("reason"),
        F.lit(None).cast("string").alias("previous_state"),
        F.lit(None).cast("string").alias("new_state"),
        F.col("event_id").alias("triggering_event_id"),
        _audit_time(audited_ms).alias("ts_audit")).select(*AUDIT_FIELDS)


def _audit_time(ms):
    return F.lit(ms).cast("long") if ms is not None else F.unix_millis(F.current_timestamp())


def recompute_affected(raw: DataFrame, late: DataFrame, snapshot_ms=None, hot=None) -> DataFrame:
    """Fresh snapshots of the order-days that late events touch, from the whole event log.

    `raw` must hold the late events too; both may hold duplicates. A stored `trade_date` of the
    log is used as it is, so that filters on it reach the partitions. The log is read twice, so that
    only events that may have a copy are moved to find the first of them.
    """
    affected = _dated(late).select(*DAY_KEY).distinct()
    touched = join_facts(_dated(raw), affected, DAY_KEY, "left_semi", hot).drop("trade_date")
    return lifecycle_snapshot(dedup_events(touched, stored=True), snapshot_ms)


def _dated(events: DataFrame) -> DataFrame:
    return events if "trade_date" in events.columns else events.withColumn(
        "trade_date", trade_date())


def corrections(raw: DataFrame, late: DataFrame, published: DataFrame, snapshot_ms=None,
                hot=None) -> DataFrame:
    """The recomputed snapshots that differ from what was published in any column but
    ts_snapshot, as `new` beside `old` (NULL if nothing was published). Work and shuffles are
    those of the order-days that late events touch, not of the whole table."""
    columns = [c for c in published.columns if c != "trade_month"]
    new = recompute_affected(raw, late, snapshot_ms, hot).select(
        *DAY_KEY, F.struct(*columns).alias("new"))
    affected = _dated(late).select(*DAY_KEY).distinct()
    old = published.join(affected, DAY_KEY, "left_semi").select(  # a row per order and day
        *DAY_KEY, F.struct(*columns).alias("old"))
    return new.join(old, DAY_KEY, "left").where(
        F.col("old").isNull() | _differs(columns))


def _differs(columns):
    """Whether `old` and `new` differ in anything but ts_snapshot. The mean price is compared to
    six decimals, as the last bits of a sum depend on its order."""
    out = F.lit(False)
    for c in columns:
        if c != "ts_snapshot":
            old, new = F.col(f"old.{c}"), F.col(f"new.{c}")
            if c == "avg_exec_price":
                old, new = F.round(old, 6), F.round(new, 6)
            out = out | ~old.eqNullSafe(new)
    return out


def reconcile_late(raw: DataFrame, late: DataFrame, published: DataFrame, snapshot_ms=None,
                   hot=None) -> DataFrame:
    """The published snapshots with the corrections of late events in them, marked
    `is_corrected`."""
    columns = published.columns
    found = cut_lineage(corrections(raw, late, published, snapshot_ms, hot).select("new.*"),
                        "corrections").withColumn("is_corrected", F.lit(True))
    kept = published.join(found.select(*DAY_KEY), DAY_KEY, "left_anti").withColumn(
        "is_corrected", F.lit(False))
    return kept.unionByName(found, allowMissingColumns=True).select(*columns, "is_corrected")


def _placed(df: DataFrame, first: str) -> DataFrame:
    df = _dated(df)
    return with_month(df) if first == "trade_month" and first not in df.columns else df


def plan_corrections(spark: SparkSession, raw: DataFrame, late: DataFrame, path: str,
                     partition_by=("trade_date",), snapshot_ms=None) -> DataFrame:
    """`corrections` of the table in `path`: only partitions that late events name are read, of the
    table and of `raw`, which is partitioned by the same first column (trade_date or trade_month)."""
    first = partition_by[0]
    late = cut_lineage(_placed(late, first), "late")
    values = [r[0] for r in late.select(first).distinct().collect()]  # days of the retention
    published = read_snapshot_table(spark, path).where(F.col(first).isin(values))
    return corrections(_placed(raw, first).where(F.col(first).isin(values)), late, published,
                       snapshot_ms)


def apply_corrections(spark: SparkSession, found: DataFrame, path: str,
                      partition_by=("trade_date",)) -> None:
    """Puts the new snapshots of stored `corrections` into the table in `path`. Only partitions with
    a correction are replaced, from a staged copy; applying them again changes nothing."""
    first = partition_by[0]
    new = _placed(found.select("new.*"), first)
    touched = [r[0] for r in new.select(first).distinct().collect()]
    if touched:
        kept = read_snapshot_table(spark, path).where(F.col(first).isin(touched)).join(
            found.select(*DAY_KEY), DAY_KEY, "left_anti")
        staged = cut_lineage(kept.unionByName(new), "staged")
        write_snapshot_table(staged, path, partition_by)


def correct_table(spark: SparkSession, raw: DataFrame, late: DataFrame, path: str,
                  partition_by=("trade_date",), snapshot_ms=None, audited_ms=None) -> DataFrame:
    """Writes the corrections of late events into the published table in `path`, and returns an
    audit record for each. A repeated run finds nothing to correct."""
    found = cut_lineage(plan_corrections(spark, raw, late, path, partition_by, snapshot_ms),
                        "corrections")
    apply_corrections(spark, found, path, partition_by)
    return audit_of(found, late, audited_ms)


def audit_corrections(published: DataFrame, current: DataFrame, late: DataFrame,
                      audited_ms=None) -> DataFrame:
    """One LIFECYCLE_CORRECTION record per order-day of which any published column changed."""
    columns = [c for c in published.columns if c != "trade_month"]
    old = published.select(*DAY_KEY, F.struct(*columns).alias("old"))
    new = current.select(*DAY_KEY, F.struct(*columns).alias("new"))
    changed = old.join(new, DAY_KEY, "full_outer").where(_differs(columns))
    return audit_of(changed, late, audited_ms)


def audit_of(changed: DataFrame, late: DataFrame, audited_ms=None) -> DataFrame:
    """Audit records of changed order-days (`old` and `new` are structs of their columns).

    The states show the columns in `STATE`, and the mean price where it differs.
    The triggering event is the last late one of that order-day, if there is any.
    """
    trigger = (_dated(late).groupBy(*DAY_KEY)
               .agg(F.max(F.struct("ts_ingest", "event_id", "event_type")).alias("t")))

    def state(side):
        price, before, after = (F.round(f"{s}.avg_exec_price", 6) for s in (side, "old", "new"))
        shown = [F.col(f"{side}.{c}").alias(c) for c in STATE]
        shown.append(F.when(~before.eqNullSafe(after), price).alias("avg_exec_price"))
        return F.when(F.col(side).isNotNull(), F.to_json(F.struct(*shown)))

    rows = changed.join(trigger, DAY_KEY, "left").select(
        *DAY_KEY, "t", state("old").alias("previous"), state("new").alias("after"))
    return rows.select(
        content_id(F.lit("LIFECYCLE_CORRECTION"), F.col(ORDER), F.col("trade_date"),
                   F.col("previous"), F.col("after")).alias("audit_id"),
        F.lit("LIFECYCLE_CORRECTION").alias("action"), ORDER,
        F.concat(F.lit("Late "), F.coalesce("t.event_type", F.lit("unknown")),
                 F.lit(" event received")).alias("reason"),
        F.col("previous").alias("previous_state"), F.col("after").alias("new_state"),
        F.col("t.event_id").alias("triggering_event_id"),
        _audit_time(audited_ms).alias("ts_audit")).select(*AUDIT_FIELDS)


def mark_finalized(snapshots: DataFrame, watermark_ms) -> DataFrame:
    """`is_finalized`: the watermark has passed the end of the trading day."""
    day_end = (F.unix_date(F.col("trade_date").cast("date")) + 1).cast("long") * 86_400_000
    return snapshots.withColumn("is_finalized", day_end <= F.lit(watermark_ms))


def audit_finalization(finalized: DataFrame, audited_ms=None) -> DataFrame:
    """One LIFECYCLE_FINALIZED record per finalised snapshot."""
    after = state_json(*STATE)
    return finalized.where("is_finalized").select(
        content_id(F.lit("LIFECYCLE_FINALIZED"), F.col(ORDER), F.col("trade_date"), after)
        .alias("audit_id"),
        F.lit("LIFECYCLE_FINALIZED").alias("action"), ORDER,
        F.lit("Watermark passed the trading day").alias("reason"),
        F.lit(None).cast("string").alias("previous_state"), after.alias("new_state"),
        F.lit(None).cast("string").alias("triggering_event_id"),
        _audit_time(audited_ms).alias("ts_audit")).select(*AUDIT_FIELDS)


def updates_after_final(events: DataFrame, delay_ms) -> DataFrame:
    """Events that arrived after their trading day was final: exceptions, not updates."""
    day_end = (F.floor(F.col("ts_event") / 86_400_000) + 1) * 86_400_000
    return events.where(F.unix_millis("kafka_timestamp") > day_end + F.lit(delay_ms)).select(
        content_id(F.lit("UPDATE_AFTER_FINAL"), F.col("event_id"), F.col("ts_event"))
        .alias("exception_id"),
        F.lit("UPDATE_AFTER_FINAL").alias("exception_type"), F.lit("ERROR").alias("severity"),
        ORDER, "firm_order_id", "event_id", "ts_event",
        trade_date().alias("trade_date"))


def _executions(events: DataFrame) -> DataFrame:
    """One row per execution, so the comparison joins unique keys."""
    return (events.where("event_type = 'FILL'").groupBy(ORDER, "exec_id")
            .agg(F.sum(F.col("qty").cast("long")).alias("qty"),
                 F.max("exec_price").alias("price")))


def order_totals(events: DataFrame) -> DataFrame:
    return events.groupBy(ORDER).agg(
        F.max(on_type("NEW", F.col("qty").cast("long"))).alias("total_qty"))


def comparative_review(events: DataFrame, internal_orders: DataFrame,
                       internal_executions: DataFrame) -> DataFrame:
    """Differences between the event log and a firm's own records.

    Orders are compared by quantity, executions one by one rather than as a set per
    order, so an order with very many executions stays spread out.
    `internal_orders`: customer_order_id, total_qty. `internal_executions`:
    customer_order_id, exec_id, qty, price.
    """
    text = "string"
    ours = order_totals(events).withColumn("in_log", F.lit(True))
    theirs = internal_orders.select(
        ORDER, F.col("total_qty").alias("their_qty"), F.lit(True).alias("in_books"))
    orders = ours.join(theirs, ORDER, "full_outer")
    by_order = orders.select(
        F.when(F.col("in_log").isNull(), "ORDER_MISSING_IN_LOG")
        .when(F.col("in_books").isNull(), "ORDER_MISSING_IN_BOOKS")
        .when(~F.col("total_qty").eqNullSafe(F.col("their_qty")), "QUANTITY_MISMATCH")
        .alias("discrepancy"),
        ORDER, F.lit(None).cast(text).alias("exec_id"),
        F.col("total_qty").cast("double").alias("log_value"),
        F.col("their_qty").cast("double").alias("internal_value"))

    mine = _executions(events).withColumn("in_log", F.lit(True))
    books = internal_executions.select(
        ORDER, "exec_id", F.col("qty").alias("their_qty"), F.col("price").alias("their_price"),
        F.lit(True).alias("in_books"))
    both = F.col("in_log").isNotNull() & F.col("in_books").isNotNull()
    execs = mine.join(books, [ORDER, "exec_id"], "full_outer").select(
        ORDER, "exec_id",
        F.explode(F.array(
            F.when(F.col("in_log").isNull(), F.struct(
                F.lit("MISSING_IN_CAT").alias("discrepancy"),
                F.lit(None).cast("double").alias("log_value"),
                F.col("their_qty").cast("double").alias("internal_value"))),
            F.when(F.col("in_books").isNull(), F.struct(
                F.lit("MISSING_IN_INTERNAL").alias("discrepancy"),
                F.col("qty").cast("double").alias("log_value"),
                F.lit(None).cast("double").alias("internal_value"))),
            F.when(both & ~F.col("qty").eqNullSafe(F.col("their_qty")), F.struct(
                F.lit("EXECUTION_QUANTITY_MISMATCH").alias("discrepancy"),
                F.col("qty").cast("double").alias("log_value"),
                F.col("their_qty").cast("double").alias("internal_value"))),
            F.when(both & ~F.col("price").eqNullSafe(F.col("their_price")), F.struct(
                F.lit("PRICE_MISMATCH").alias("discrepancy"),
                F.col("price").alias("log_value"),
                F.col("their_price").alias("internal_value"))))).alias("d")
    ).where("d IS NOT NULL").select("d.discrepancy", ORDER, "exec_id", "d.log_value",
                                    "d.internal_value")
    return by_order.where("discrepancy IS NOT NULL").unionByName(execs)


def review_exceptions(review: DataFrame, detected_ms=None) -> DataFrame:
    """The differences of a comparative review as exceptions, one each."""
    subject = F.coalesce("exec_id", ORDER)
    empty = F.lit(None).cast("string")
    out = review.select(
        content_id(F.col(ORDER), empty, F.col("discrepancy"), subject).alias("exception_id"),
        F.col("discrepancy").alias("exception_type"), F.lit("ERROR").alias("severity"), ORDER,
        empty.alias("firm_order_id"), empty.alias("event_id"), empty.alias("symbol"),
        F.lit(None).cast("long").alias("ts_event"),
        F.lit("Event log and internal records differ").alias("description"),
        F.to_json(F.struct("exec_id", "log_value", "internal_value")).alias("metadata"))
    return out if detected_ms is None else out.withColumn(
        "ts_detected", F.lit(detected_ms).cast("long"))


def match_rate(events: DataFrame, internal_orders: DataFrame,
               internal_executions: DataFrame) -> DataFrame:
    """One row: orders on either side, orders without any discrepancy, and their share."""
    differing = (
        comparative_review(events, internal_orders, internal_executions)
        .groupBy(ORDER).agg(F.lit(True).alias("differs")))
    orders = order_totals(events).select(ORDER).union(
        internal_orders.select(ORDER)).distinct()
    return (orders.join(differing, ORDER, "left")
            .agg(F.count("*").alias("orders"),
                 F.count(F.when(F.col("differs").isNull(), 1)).alias("matched"))
            .withColumn("match_rate", F.col("matched") / F.col("orders")))
