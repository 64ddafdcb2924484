"""Order lifecycles: day snapshots, whole-life views and replay."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import has_value, on_type, signed_qty, status, trade_date
from orderloom.operators.skew import join_facts, running

ORDER = "customer_order_id"
PART_ROWS = 10_000


def _latest():
    """Orders events by time; among equal times the larger type name wins."""
    return F.struct("ts_event", "event_type")


def _state_columns():
    """Aggregates that need constant memory per order, so a hot order is combined map-side.

    Names and order are those of the published snapshot (fixed values).
    """
    return [
        F.max(_latest()).alias("last_event"),
        F.min("ts_event").alias("ts_first_event"),
        F.max("ts_event").alias("ts_last_event"),
        F.max("firm_order_id").alias("root_firm_order_id"),
        F.max("account_id").alias("account_id"),
        F.max("symbol").alias("symbol"),
        F.max("side").alias("side"),
        F.max(on_type("NEW", F.col("qty"))).alias("total_qty"),
        F.sum(signed_qty()).alias("filled_qty"),
        F.avg(on_type("FILL", F.col("exec_price"))).alias("avg_exec_price"),
        F.count(on_type("ROUTE")).alias("route_count"),
        F.count(on_type("FILL")).alias("fill_count"),
        F.max(F.when(F.col("event_type") == "CANCEL", 1).otherwise(0)).alias("is_canceled"),
        F.max("is_late").alias("has_late_events"),
    ]


def _with_status(aggregated: DataFrame, snapshot_ms=None) -> DataFrame:
    now = (F.unix_timestamp(F.current_timestamp()) * 1000 if snapshot_ms is None
           else F.lit(snapshot_ms).cast("long"))
    return aggregated.withColumns({
        "status": status(F.col("is_canceled") == 1, F.col("filled_qty"), F.col("total_qty"),
                         F.col("route_count")),
        "is_provisional": F.col("has_late_events"),
        "ts_snapshot": now,
    })


def lifecycle_snapshot(events: DataFrame, snapshot_ms=None) -> DataFrame:
    """One row per order and UTC trading day. Batch and streaming.

    A stream groups by a time window, whose end lets the watermark evict the state. In
    batch the same day is a plain number, led by a hash of the order: text aggregates
    sort, and this key sorts by its first eight bytes.
    """
    if events.isStreaming:
        keys = [F.window("event_time", "1 day").alias("_day"), ORDER]
        day = F.col("_day.start").cast("date")
    else:
        keys = [F.xxhash64(ORDER).alias("_hash"),
                F.unix_date(F.col("event_time").cast("date")).alias("_day"), ORDER]
        day = F.date_from_unix_date("_day")
    out = _with_status(events.groupBy(*keys).agg(*_state_columns()), snapshot_ms)
    out = out.withColumn("trade_date", day.cast("string"))
    return out.select(
        *[c for c in out.columns if c not in ("_hash", "_day", "trade_date", "ts_snapshot")],
        "trade_date", "ts_snapshot")


def finalized_stream(events: DataFrame, snapshot_ms=None) -> DataFrame:
    """Streaming, append mode: a day's snapshots appear once the watermark closed the day."""
    return (lifecycle_snapshot(events, snapshot_ms)
            .withColumn("is_finalized", F.lit(True)))


def lifecycle_as_of(events: DataFrame, as_of_ms, snapshot_ms=None) -> DataFrame:
    """The snapshots as they stood at one moment of event time."""
    return lifecycle_snapshot(events.where(F.col("ts_event") <= F.lit(as_of_ms)), snapshot_ms)


def lifecycle_multi_day(events: DataFrame, snapshot_ms=None) -> DataFrame:
    """One row per order over all its trading days."""
    return _with_dates(_with_status(events.groupBy(ORDER).agg(*_state_columns()), snapshot_ms))


def lifecycle_sessions(events: DataFrame, quiet="2 days", snapshot_ms=None) -> DataFrame:
    """One row per order and stretch of its life without a pause of `quiet`.

    A session window per order: as a stream (append mode) a row appears when the watermark
    passes its last event by `quiet`, and its state is then gone. An event after that opens
    a new session; `merge_sessions` joins the sessions of an order into its whole life.
    `session.MERGE_SESSIONS` combines a busy order before the shuffle.
    """
    price = on_type("FILL", F.col("exec_price"))
    out = events.groupBy(F.session_window("event_time", quiet).alias("s"), ORDER).agg(
        *_state_columns(), F.sum(price).alias("exec_price_sum"),
        F.count(price).alias("exec_price_count"))
    return _with_dates(_with_status(out, snapshot_ms)).drop("s")


def merge_sessions(sessions: DataFrame) -> DataFrame:
    """One row per order from all its sessions, as one aggregate over all its events gives it.

    An order that rests longer than the pause that closes a session keeps what it was placed
    with and what was filled before.
    """
    largest = ("last_event", "ts_last_event", "root_firm_order_id", "account_id", "symbol",
               "side", "total_qty", "is_canceled", "has_late_events")
    out = sessions.groupBy(ORDER).agg(
        *[F.max(c).alias(c) for c in largest], F.min("ts_first_event").alias("ts_first_event"),
        *[F.sum(c).alias(c) for c in ("filled_qty", "route_count", "fill_count",
                                      "exec_price_sum", "exec_price_count")],
        F.max("ts_snapshot").alias("_snapshot"))
    merged = _with_status(out.withColumn(
        "avg_exec_price", F.col("exec_price_sum") / F.nullif("exec_price_count", F.lit(0))))
    return _with_dates(merged.withColumn("ts_snapshot", F.col("_snapshot"))).drop(
        "_snapshot", "exec_price_sum", "exec_price_count")


def _with_dates(snapshots: DataFrame) -> DataFrame:
    return (snapshots.withColumn("first_trade_date", trade_date("ts_first_event"))
            .withColumn("last_trade_date", trade_date("ts_last_event"))
            .withColumn("spans_days", F.col("first_trade_date") != F.col("last_trade_date")))


def lifecycle_detail(events: DataFrame, part_rows=PART_ROWS) -> DataFrame:
    """Whole-life view per order: root from NEW, VWAP, routes and executions in time order.

    The routes and executions of an order are numbered by time and come in parts of `part_rows`:
    an order has one row for each part (`part_no` from 0, `parts` in all, at least one) with its
    scalars repeated, so no array grows with the order and none is cut. VWAP counts fills that
    have a price.
    """
    # only these decide the documented state; the later of them wins over OPEN
    turning = F.col("event_type").isin("CANCEL", "REPLACE", "REJECT")
    fill_qty = on_type("FILL", F.col("qty").cast("long"))
    priced = F.when(F.col("exec_price").isNotNull(), fill_qty)
    reject_reason = (F.coalesce("reject_reason", "reason") if "reject_reason" in events.columns
                     else F.col("reason"))
    is_route = (F.col("event_type") == "ROUTE") & has_value("route_id")
    facts = events.groupBy(ORDER).agg(
        F.min(on_type("NEW", F.struct("ts_event", "event_id", "firm_order_id", "qty")))
        .alias("new"),
        F.min(F.struct("ts_event", "event_id", "account_id", "symbol", "side")).alias("head"),
        F.max(F.when(turning, _latest())).alias("turn"),
        F.max(on_type("REJECT", F.struct("ts_event", "event_id",
                                         reject_reason.alias("reject_reason"))))
        .alias("reject"),
        F.coalesce(F.sum(fill_qty), F.lit(0)).alias("filled_qty"),
        F.sum(priced).alias("priced_qty"),
        F.sum(on_type("FILL", F.col("qty") * F.col("exec_price"))).alias("value"),
        F.count(F.when(is_route, 1)).alias("route_count"),
        F.count(on_type("FILL")).alias("execution_count"),
        F.coalesce(F.sum(on_type("ALLOCATE", F.col("qty").cast("long"))), F.lit(0))
        .alias("allocated_qty"),
        F.min("ts_event").alias("ts_first_event"),
        F.max("ts_event").alias("ts_last_event"),
        F.max("is_late").alias("is_provisional"))
    total = F.col("new.qty")
    listed = F.col("route_count") + F.col("execution_count")
    scalars = facts.select(
        ORDER, F.col("new.firm_order_id").alias("root_firm_order_id"),
        "head.account_id", "head.symbol", "head.side",
        total.alias("total_qty"), "filled_qty",
        F.when(F.col("priced_qty") > 0, F.col("value") / F.col("priced_qty")).alias("vwap"),
        F.when(F.col("filled_qty") >= total, "FILLED")
        .when(F.col("filled_qty") > 0, "PARTIALLY_FILLED")
        .when(F.col("turn.event_type") == "CANCEL", "CANCELED")
        .when(F.col("turn.event_type") == "REPLACE", "REPLACED")
        .when(F.col("turn.event_type") == "REJECT", "REJECTED")
        .otherwise("OPEN").alias("status"),
        F.col("reject.reject_reason").alias("reject_reason"),
        "route_count", "execution_count", "allocated_qty", "ts_first_event", "ts_last_event",
        "is_provisional",
        F.greatest(F.lit(1).cast("long"), F.ceil(listed / part_rows)).alias("parts"))

    rows = events.where(is_route | (F.col("event_type") == "FILL")).select(
        ORDER, "event_id", "event_type", "ts_event", "route_id", "exec_id", "qty",
        F.col("exec_price").alias("price"), F.lit(1).cast("long").alias("_one"))
    numbered = running(rows, ORDER, ["ts_event", "event_id"], {"_seq": ("sum", "_one")})
    lists = (
        numbered.groupBy(ORDER, F.floor((F.col("_seq") - 1) / part_rows).alias("part_no")).agg(
            F.array_sort(F.collect_list(on_type(
                "ROUTE", F.struct("ts_event", "route_id", "event_id")))).alias("routes"),
            F.array_sort(F.collect_list(on_type(
                "FILL", F.struct("ts_event", "exec_id", "qty", "price", "event_id"))))
            .alias("fills"))
        .select(
            ORDER, "part_no", F.col("routes.route_id").alias("active_routes"),
            F.transform("fills", lambda f: F.struct(
                f["exec_id"].alias("exec_id"), f["qty"].alias("qty"),
                f["price"].alias("price"), f["ts_event"].alias("ts_event")))
            .alias("executions")))
    return (scalars.join(lists, ORDER, "left")
            .withColumn("part_no", F.coalesce("part_no", F.lit(0).cast("long")))
            .withColumn("active_routes", F.coalesce(
                "active_routes", F.array().cast("array<string>")))
            .withColumn("executions", F.coalesce("executions", F.array().cast(
                "array<struct<exec_id:string,qty:int,price:double,ts_event:bigint>>"))))


def order_executions(events: DataFrame) -> DataFrame:
    """The executions of every order, one row each."""
    return events.where("event_type = 'FILL'").select(
        ORDER, "exec_id", "qty", F.col("exec_price").alias("price"), "ts_event")


def order_routes(events: DataFrame) -> DataFrame:
    """The routes of every order, one row each."""
    return events.where((F.col("event_type") == "ROUTE") & has_value("route_id")).select(
        ORDER, "route_id", "firm_order_id", "venue", "qty", "ts_event")


def first_execution(events: DataFrame) -> DataFrame:
    """When each order was first executed."""
    return (events.where("event_type = 'FILL'").groupBy(ORDER)
            .agg(F.min("ts_event").alias("ts_first_execution")))


def filled_before_cancel(events: DataFrame, hot=None) -> DataFrame:
    """Quantity filled strictly before an order's first cancel, for orders with a cancel."""
    cancels = (events.where("event_type = 'CANCEL'").groupBy(ORDER)
               .agg(F.min("ts_event").alias("ts_cancel")))
    fills = events.where("event_type = 'FILL'").select(
        ORDER, "event_id", "ts_event", F.col("qty").cast("long").alias("qty"))
    earlier = (join_facts(fills, cancels, [ORDER], hot=hot)
               .where("ts_event < ts_cancel")
               .groupBy(ORDER).agg(F.sum("qty").alias("qty")))
    return cancels.join(earlier, ORDER, "left").select(
        ORDER, "ts_cancel", F.coalesce("qty", F.lit(0)).alias("filled_before_cancel"))


def lifecycle_replay(events: DataFrame) -> DataFrame:
    """Filled quantity and status of the order right after each of its events."""
    marked = events.select(
        ORDER, "event_id", "event_type", "ts_event",
        signed_qty().alias("_delta"), on_type("NEW", F.col("qty")).alias("_total"),
        F.when(F.col("event_type") == "CANCEL", 1).otherwise(0).alias("_cancel"),
        F.when(F.col("event_type") == "ROUTE", 1).otherwise(0).cast("long").alias("_route"))
    out = running(
        marked, ORDER, ["ts_event", "event_type", "event_id"],
        {"filled_qty": ("sum", "_delta"), "total_qty": ("max", "_total"),
         "_canceled": ("max", "_cancel"), "_routes": ("sum", "_route")})
    return out.withColumn(
        "status", status(F.col("_canceled") == 1, F.col("filled_qty"), F.col("total_qty"),
                         F.col("_routes"))).select(
        ORDER, "event_id", "event_type", "ts_event", "total_qty", "filled_qty", "status")


def order_history(events: DataFrame, order_id=None) -> DataFrame:
    """All events of every order, numbered by time; or those of one order, sorted."""
    columns = [ORDER, "event_id", "event_type", "ts_event", "firm_order_id",
               "parent_firm_order_id", "route_id", "exec_id", "qty"]
    by = ["ts_event", "event_type", "event_id"]
    if order_id is not None:
        return events.where(F.col(ORDER) == order_id).select(*columns).orderBy(*by)
    return running(
        events.select(*columns, F.lit(1).cast("long").alias("_one")), ORDER, by,
        {"seq": ("sum", "_one")}).drop("_one")
