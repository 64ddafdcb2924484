"""Data-quality rules. Each family finds all its violations in one pass over its input.

The names, severities and texts of exceptions are fixed values.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import content_id, has_value, on_type, trade_date
from orderloom.operators.skew import join_facts
from orderloom.schema import EXCEPTION_FIELDS

ORDER = "customer_order_id"
YEAR_MS = 365 * 24 * 3600 * 1000


@dataclass(frozen=True)
class Rule:
    """A violation: when it holds, what it is about, and the columns that explain it."""
    kind: str
    severity: str
    text: str
    holds: Column
    subject: str
    explain: tuple


def apply_rules(df: DataFrame, rules, only=None, detected_ms=None, keep=()) -> DataFrame:
    """All violations in `df`, one row each.

    Clean rows are filtered out before the rules are spread into rows. The id of an
    exception depends on its content, so a repeated run repeats it. `detected_ms`
    adds the detection time; columns in `keep` stay beside those of the exception.
    """
    rules = [r for r in rules if only is None or r.kind in only]
    any_hit = rules[0].holds
    for rule in rules[1:]:
        any_hit = any_hit | rule.holds
    hits = F.array(*[F.when(r.holds, F.struct(
        F.lit(r.kind).alias("exception_type"), F.lit(r.severity).alias("severity"),
        F.col(r.subject).cast("string").alias("subject"), F.lit(r.text).alias("description"),
        F.to_json(F.struct(*r.explain)).alias("metadata"))) for r in rules])
    for name in ("event_id", "ts_event"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    found = (df.where(any_hit)
             .select(ORDER, "firm_order_id", "event_id", "symbol", "ts_event", "day",
                     *[c for c in keep if c != "day"],
                     F.explode(hits).alias("hit"))
             .where("hit IS NOT NULL")
             .select("*", "hit.*"))
    out = found.withColumn(
        "exception_id", content_id(F.col(ORDER), F.col("day"), F.col("exception_type"),
                                   F.col("subject"))).select(*EXCEPTION_FIELDS, *keep)
    return out if detected_ms is None else out.withColumn(
        "ts_detected", F.lit(detected_ms).cast("long"))


def snapshot_exceptions(snapshots: DataFrame, only=None, detected_ms=None,
                        keep=()) -> DataFrame:
    """Rules on the totals of a lifecycle snapshot. `keep` may name `day`, the trading day."""
    totals = ("total_qty", "filled_qty")
    rules = [
        Rule("OVERFILL", "ERROR", "Filled quantity exceeds total quantity",
             F.col("filled_qty") > F.col("total_qty"), ORDER, totals),
        Rule("NEGATIVE_FILL", "ERROR", "Negative filled quantity (more busted than filled)",
             F.col("filled_qty") < 0, ORDER, totals),
        Rule("FILLED_NO_EXECUTIONS", "ERROR", "Filled order without executions",
             (F.col("status") == "FILLED") & (F.col("fill_count") == 0), ORDER, totals),
    ]
    return apply_rules(
        snapshots.select(
            ORDER, F.col("root_firm_order_id").alias("firm_order_id"), "symbol",
            F.col("ts_last_event").alias("ts_event"), F.col("trade_date").alias("day"),
            "status", "fill_count", *totals), rules, only, detected_ms, keep)


def event_exceptions(events: DataFrame, as_of_ms, only=None, detected_ms=None,
                     final_delay_ms=120_000) -> DataFrame:
    """Rules on a single event: required ids, plausible times, and arrival before its trading
    day was final (`final_delay_ms` after its end; where the arrival is known). Without state,
    so they also run on a stream."""
    arrival = (F.unix_millis("kafka_timestamp") if "kafka_timestamp" in events.columns
               else F.lit(None).cast("long"))
    day_end = (F.floor(F.col("ts_event") / 86_400_000) + 1) * 86_400_000
    route = (F.col("event_type") == "ROUTE") & ~(
        has_value("parent_firm_order_id") & has_value("route_id"))
    fill = (F.col("event_type") == "FILL") & ~(has_value("exec_id") & has_value("route_id"))
    rules = [
        Rule("MISSING_REQUIRED_ID", "ERROR", "Event lacks an id its type requires",
             route | fill, "event_id", ("event_type",)),
        Rule("FUTURE_TIMESTAMP", "ERROR", "Event time lies in the future",
             F.col("ts_event") > as_of_ms, "event_id", ("ts_event",)),
        Rule("STALE_EVENT", "WARNING", "Event is more than a year old",
             F.lit(as_of_ms) - F.col("ts_event") > YEAR_MS, "event_id", ("ts_event",)),
        Rule("INGEST_BEFORE_EVENT", "ERROR", "Event was ingested before it happened",
             F.col("ts_ingest") < F.col("ts_event"), "event_id", ("ts_event", "ts_ingest")),
        Rule("UPDATE_AFTER_FINAL", "ERROR", "Event arrived after its trading day was final",
             F.col("arrival") > day_end + final_delay_ms, "event_id", ("ts_event", "arrival")),
    ]
    return apply_rules(
        events.withColumn("arrival", arrival).select(
            "arrival", ORDER, "firm_order_id", "event_id", "symbol", "event_type", "ts_event",
            "ts_ingest", "parent_firm_order_id", "route_id", "exec_id",
            trade_date().alias("day")), rules, only, detected_ms)


def order_exceptions(events: DataFrame, only=None, hot=None, detected_ms=None) -> DataFrame:
    """Rules that compare an event with the NEW event of its order: sequence and price."""
    placed = (events.where("event_type = 'NEW'").groupBy(ORDER)
              .agg(F.min("ts_event").alias("new_ts"), F.max("limit_price").alias("new_limit")))
    checked = events.where(F.col("event_type").isin("ROUTE", "FILL")).select(
        ORDER, "firm_order_id", "event_id", "symbol", "event_type", "ts_event", "exec_price",
        trade_date().alias("day"))
    fill, early = F.col("event_type") == "FILL", F.col("ts_event") < F.col("new_ts")
    price, limit = F.col("exec_price"), F.col("new_limit")
    has_limit, prices = fill & (limit != 0), ("exec_price", "new_limit")
    rules = [
        Rule("ROUTE_BEFORE_NEW", "ERROR", "Route timestamp precedes order timestamp",
             (F.col("event_type") == "ROUTE") & early, "event_id", ("ts_event", "new_ts")),
        Rule("FILL_BEFORE_NEW", "ERROR", "Execution timestamp precedes order timestamp",
             fill & early, "event_id", ("ts_event", "new_ts")),
        Rule("INVALID_PRICE", "ERROR", "Execution price is not positive",
             fill & (price <= 0), "event_id", prices),
        Rule("PRICE_DEVIATION", "WARNING", "Execution price is over 10% off the limit price",
             has_limit & (F.abs(price - limit) > limit * 0.1), "event_id", prices),
        Rule("PRICE_ABOVE_LIMIT", "WARNING", "Execution price is over 5% above the limit price",
             has_limit & (price > limit * 1.05), "event_id", prices),
    ]
    return apply_rules(join_facts(checked, placed, [ORDER], "left", hot), rules, only,
                       detected_ms)


def route_exceptions(events: DataFrame, only=None, detected_ms=None) -> DataFrame:
    """Rules on the events of one route: their sequence, and that the route has an outcome."""
    def at(kind):
        return F.min(on_type(kind, F.col("ts_event")))

    per_route = (
        events.where(F.col("event_type").isin("ROUTE", "ACK", "REJECT", "FILL")
                     & has_value("route_id"))
        .groupBy(ORDER, "route_id")
        .agg(F.max("firm_order_id").alias("firm_order_id"), F.max("symbol").alias("symbol"),
             F.min("ts_event").alias("ts_event"), at("ROUTE").alias("route_ts"),
             at("ACK").alias("ack_ts"), at("FILL").alias("fill_ts"),
             at("REJECT").alias("reject_ts"))
        .withColumn("day", trade_date()))
    rules = [
        Rule("ACK_BEFORE_ROUTE", "ERROR", "Acknowledgement precedes its route",
             F.col("ack_ts") < F.col("route_ts"), "route_id", ("route_id",)),
        Rule("FILL_BEFORE_ACK", "ERROR", "Execution precedes the acknowledgement of its route",
             F.col("fill_ts") < F.col("ack_ts"), "route_id", ("route_id",)),
        Rule("ROUTE_NO_OUTCOME", "WARNING", "Route was neither acknowledged nor rejected",
             F.col("route_ts").isNotNull() & F.col("ack_ts").isNull()
             & F.col("reject_ts").isNull(), "route_id", ("route_id",)),
    ]
    return apply_rules(per_route, rules, only, detected_ms)


def _unknown(events, id_column, known, rule, hot, detected_ms):
    rows = events.where(has_value(id_column)).select(
        ORDER, "firm_order_id", "event_id", "symbol", "ts_event", id_column,
        trade_date().alias("day"))
    return apply_rules(join_facts(rows, known, [ORDER, id_column], "left_anti", hot), [rule],
                       None, detected_ms)


def missing_parent(events: DataFrame, parent_types=("NEW",), hot=None,
                   detected_ms=None) -> DataFrame:
    """ROUTE and REPLACE events whose parent node no event of `parent_types` created."""
    known = (events.where(F.col("event_type").isin(*parent_types))
             .select(ORDER, F.col("firm_order_id").alias("parent_firm_order_id")).distinct())
    return _unknown(
        events.where(F.col("event_type").isin("ROUTE", "REPLACE")), "parent_firm_order_id",
        known, Rule("MISSING_PARENT", "ERROR", "Parent order is unknown", F.lit(True),
                    "event_id", ("parent_firm_order_id",)), hot, detected_ms)


def orphaned_execution(events: DataFrame, hot=None, detected_ms=None) -> DataFrame:
    """FILL events on a route no ROUTE event created."""
    known = (events.where((F.col("event_type") == "ROUTE") & has_value("route_id"))
             .select(ORDER, "route_id").distinct())
    return _unknown(
        events.where("event_type = 'FILL'"), "route_id", known,
        Rule("ORPHANED_EXECUTION", "ERROR", "Route of the execution is unknown", F.lit(True),
             "event_id", ("route_id",)), hot, detected_ms)


def route_overallocation(events: DataFrame, detected_ms=None) -> DataFrame:
    """Orders that sent more to venues than was ordered."""
    per_order = (
        events.where(F.col("event_type").isin("NEW", "ROUTE")).groupBy(ORDER)
        .agg(F.max(on_type("NEW", F.col("firm_order_id"))).alias("firm_order_id"),
             F.max("symbol").alias("symbol"), F.min("ts_event").alias("ts_event"),
             F.max(on_type("NEW", F.col("qty").cast("long"))).alias("total_qty"),
             F.sum(on_type("ROUTE", F.col("qty").cast("long"))).alias("routed_qty"))
        .withColumn("day", trade_date()))
    return apply_rules(per_order, [Rule(
        "ROUTE_OVERALLOCATION", "ERROR", "Routed quantity exceeds total quantity",
        F.col("routed_qty") > F.col("total_qty"), ORDER, ("total_qty", "routed_qty"))],
        None, detected_ms)


def allocation_check(events: DataFrame, detected_ms=None) -> DataFrame:
    """Executions whose allocations to sub-accounts do not add up to the executed quantity.

    An execution without any allocation is not allocated yet, which is no violation; an
    allocation of an unknown execution is.
    """
    qty = F.col("qty").cast("long")
    per_exec = (
        events.where(F.col("event_type").isin("FILL", "ALLOCATE") & has_value("exec_id"))
        .groupBy(ORDER, "exec_id")
        .agg(F.max("firm_order_id").alias("firm_order_id"), F.max("symbol").alias("symbol"),
             F.min("ts_event").alias("ts_event"),
             F.coalesce(F.sum(on_type("FILL", qty)), F.lit(0)).alias("executed_qty"),
             F.sum(on_type("ALLOCATE", qty)).alias("allocated_qty"))
        .withColumn("day", trade_date()))
    return apply_rules(per_exec, [Rule(
        "ALLOCATION_MISMATCH", "ERROR", "Allocations do not add up to the execution",
        F.col("allocated_qty") != F.col("executed_qty"), "exec_id",
        ("executed_qty", "allocated_qty"))], None, detected_ms)


def all_exceptions(events: DataFrame, snapshots: DataFrame, as_of_ms,
                   detected_ms=None) -> DataFrame:
    """Every rule that needs no iteration, in one frame; `linkage.circular_exceptions` adds the
    cycles. `events` must be unique. Building the plan starts no job."""
    parts = [
        snapshot_exceptions(snapshots, None, detected_ms),
        event_exceptions(events, as_of_ms, None, detected_ms),
        order_exceptions(events, None, None, detected_ms),
        route_exceptions(events, None, detected_ms),
        missing_parent(events, detected_ms=detected_ms),
        orphaned_execution(events, detected_ms=detected_ms),
        route_overallocation(events, detected_ms),
        allocation_check(events, detected_ms),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def split_by_severity(exceptions: DataFrame):
    """(rows for the exception table, rows for the log only)."""
    to_table = F.col("severity").isin("ERROR", "WARNING")
    return exceptions.where(to_table), exceptions.where(~to_table)
