"""Counts, rates, lookups and other reports over events, snapshots and exceptions."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.columns import late_flag
from orderloom.operators.skew import join_facts, running

ORDER = "customer_order_id"


def count_by(df: DataFrame, *columns) -> DataFrame:
    """Rows per group; with a streaming input for complete mode."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def events_by_type(events: DataFrame) -> DataFrame:
    return count_by(events, "event_type")


def exceptions_by_type(exceptions: DataFrame) -> DataFrame:
    return count_by(exceptions, "exception_type", "severity")


def status_distribution(snapshots: DataFrame) -> DataFrame:
    return count_by(snapshots, "status")


def event_rate(events: DataFrame, width="1 minute") -> DataFrame:
    """Events per type and tumbling event-time window."""
    return count_by(events, F.window("event_time", width).alias("w"), "event_type").select(
        F.unix_millis("w.start").alias("window_start"), "event_type", "n")


def duplicate_ids(events: DataFrame) -> DataFrame:
    """Event ids that occur more than once in the raw log."""
    return events.groupBy("event_id").agg(F.count("*").alias("copies")).where("copies > 1")


def idempotency_report(events: DataFrame) -> DataFrame:
    """Resent events: copies per id, distinct arrival times, and the rows dedup removes."""
    per_copy = events.groupBy("event_id", "event_time", "ts_ingest").agg(
        F.count("*").alias("rows"))
    per_key = per_copy.groupBy("event_id", "event_time").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("times"))
    return (per_key.groupBy("event_id")
            .agg(F.sum("rows").alias("copies"), F.sum("times").alias("ingest_times"),
                 F.sum(F.col("rows") - 1).alias("dropped_by_dedup"))
            .where("copies > 1"))


def late_rate_by_delay(events: DataFrame, delays=("10 seconds", "30 seconds", "60 seconds",
                                                  "120 seconds")) -> DataFrame:
    """Late events under several watermark delays, counted in one pass."""
    counts = events.agg(
        F.count("*").alias("events"),
        *[F.count(F.when(late_flag(d), 1)).alias(f"late{i}") for i, d in enumerate(delays)])
    rows = F.array(*[F.struct(F.lit(d).alias("delay"), F.col(f"late{i}").alias("late"))
                     for i, d in enumerate(delays)])
    return (counts.select("events", F.explode(rows).alias("r"))
            .select("r.delay", "events", "r.late", (F.col("r.late") / F.col("events"))
                    .alias("late_rate")))


def exception_rate(exceptions: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Exceptions per lifecycle, by type."""
    total = snapshots.agg(F.count("*").alias("n")).scalar()
    return count_by(exceptions, "exception_type").select(
        "exception_type", "n", total.alias("lifecycles"),
        (F.col("n") / F.col("lifecycles")).alias("rate"))


def severity_distribution(exceptions: DataFrame) -> DataFrame:
    return count_by(exceptions, "severity")


def exception_trend(exceptions: DataFrame, width="1 day") -> DataFrame:
    """Exceptions per type and event-time window."""
    when = F.timestamp_millis(F.col("ts_event").cast("long"))
    return count_by(exceptions, F.window(when, width).alias("w"), "exception_type").select(
        F.unix_millis("w.start").alias("window_start"), "exception_type", "n")


def _top(df, column, k):
    return count_by(df, column).orderBy(F.col("n").desc(), column).limit(k)


def top_exception_symbols(exceptions: DataFrame, k=10) -> DataFrame:
    return _top(exceptions, "symbol", k)


def top_exception_orders(exceptions: DataFrame, k=10) -> DataFrame:
    return _top(exceptions, ORDER, k)


def pipeline_stats(events: DataFrame, unique: DataFrame, snapshots: DataFrame,
                   exceptions: DataFrame) -> DataFrame:
    """One row: events, active lifecycles, exceptions and late events."""
    active = ~F.col("status").isin("FILLED", "CANCELED")
    return events.agg(F.count("*").alias("events_processed")).select(
        "events_processed",
        snapshots.agg(F.count(F.when(active, 1)).alias("n")).scalar()
        .alias("lifecycles_active"),
        exceptions.agg(F.count("*").alias("n")).scalar().alias("exceptions_count"),
        unique.agg(F.count(F.when(F.col("is_late"), 1)).alias("n")).scalar()
        .alias("late_events_count"))


def completion_percentiles(snapshots: DataFrame, points=(0.5, 0.95, 0.99)) -> DataFrame:
    """Exact percentiles and the mean of lifecycle duration in milliseconds.

    Durations are counted per distinct value; running counts over all tasks give the values at
    the two ranks around each percentile, so no task holds all durations.
    """
    counts = (snapshots.select((F.col("ts_last_event") - F.col("ts_first_event")).alias("ms"))
              .where("ms IS NOT NULL").groupBy("ms").agg(F.count("*").alias("n"))
              .withColumn("all", F.lit(0)))
    ranked = running(counts, "all", ["ms"], {"upto": ("sum", "n")}, spread=True)
    total = ranked.agg(F.max("upto").alias("total")).scalar()
    ranked = ranked.withColumn("total", total)

    def at(rank):
        return F.min(F.when(F.col("upto") > rank, F.col("ms")))

    picks = []
    for p in points:
        rank = (F.col("total") - 1) * p
        picks += [at(F.floor(rank)).alias(f"low{p}"), at(F.ceil(rank)).alias(f"high{p}")]
    found = ranked.agg(
        F.sum("n").alias("lifecycles"),
        (F.sum(F.col("ms") * F.col("n")) / F.sum("n")).alias("mean_ms"), *picks)
    return found.select("lifecycles", "mean_ms", *[
        (F.col(f"`low{p}`") + (F.col(f"`high{p}`") - F.col(f"`low{p}`"))
         * (((F.col("lifecycles") - 1) * p) % 1)).alias(f"p{int(p * 100)}_ms") for p in points])


def mean_latency(snapshots: DataFrame) -> DataFrame:
    """Mean time from an order's first event to its snapshot, in milliseconds."""
    return snapshots.agg(F.avg(F.col("ts_snapshot") - F.col("ts_first_event"))
                         .alias("mean_latency_ms"))


def overfilled(snapshots: DataFrame) -> DataFrame:
    return snapshots.where("filled_qty > total_qty").select(ORDER, "total_qty", "filled_qty")


def slow_lifecycles(snapshots: DataFrame, longer_than_ms=60_000) -> DataFrame:
    """Lifecycles that took longer than the threshold, longest first."""
    took = F.col("ts_last_event") - F.col("ts_first_event")
    return (snapshots.where(took > longer_than_ms)
            .select(ORDER, "trade_date", (took / 1000).alias("duration_seconds"))
            .orderBy(F.col("duration_seconds").desc(), ORDER, "trade_date"))


def _since(snapshots: DataFrame, first) -> DataFrame:
    """Rows from a date (text column) on; prunes a table by date or by month."""
    if "trade_month" in snapshots.columns:
        snapshots = snapshots.where(F.col("trade_month") >= F.substring(first, 1, 7))
    return snapshots.where(F.col("trade_date") >= first)


def lifecycle_lookup(snapshots: DataFrame, order_id=None, symbol=None, trade_date=None,
                     status=None) -> DataFrame:
    """Snapshots by order id, symbol, date or status, in any combination. A date prunes a table
    by date or by month, a symbol one by symbol."""
    given = {ORDER: order_id, "symbol": symbol, "trade_date": trade_date, "status": status}
    if trade_date is not None and "trade_month" in snapshots.columns:
        given["trade_month"] = trade_date[:7]
    for name, value in given.items():
        if value is not None:
            snapshots = snapshots.where(F.col(name) == value)
    return snapshots


def lifecycle_page(snapshots: DataFrame, size, after=None, **lookup) -> DataFrame:
    """One page of a lookup in (order, date) order; `after` is the last key of the page before."""
    found = lifecycle_lookup(snapshots, **lookup)
    if after is not None:
        order_id, date = after
        found = found.where((F.col(ORDER) > order_id)
                            | ((F.col(ORDER) == order_id) & (F.col("trade_date") > date)))
    return found.orderBy(ORDER, "trade_date").limit(size)


def latest_snapshots(snapshots: DataFrame, as_of_ms=None, keep_days=30) -> DataFrame:
    """The newest snapshot of each order, dropping those expired at `as_of_ms`.

    An order whose newest day is too old is dropped anyway, so older days are not read.
    """
    first_ms = None if as_of_ms is None else as_of_ms - keep_days * 86_400_000
    if first_ms is not None:
        snapshots = _since(snapshots, _day_of(first_ms))
    newest = Window.partitionBy(ORDER).orderBy(
        F.col("trade_date").desc(), F.col("ts_snapshot").desc(), F.col("ts_last_event").desc())
    out = (snapshots.withColumn("_n", F.row_number().over(newest))
           .where("_n = 1").drop("_n"))
    return out if first_ms is None else out.where(F.col("ts_last_event") >= first_ms)


def _day_of(ms):
    return F.timestamp_millis(F.lit(ms)).cast("date").cast("string")


def expire(df: DataFrame, as_of_ms, keep_days) -> DataFrame:
    """Rows still inside the retention period; `sources.tables.drop_expired` deletes the
    partitions of the others."""
    return _since(df, _day_of(as_of_ms - keep_days * 86_400_000))


def enrich_customer(snapshots: DataFrame, customers: DataFrame, hot=None) -> DataFrame:
    """Snapshots with reference data of the account holder. `customers`: one row per account.

    Also for a streaming `snapshots` side.
    """
    return join_facts(snapshots, customers, ["account_id"], "left", hot,
                      spread_by=(ORDER, "ts_first_event"))


def throughput_report(progress: DataFrame) -> DataFrame:
    """Rows, rates and batch durations per streaming query, from its progress table."""
    return (progress.where("input_rows > 0").groupBy("query")
            .agg(F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"),
                 (F.sum("input_rows") * 1000 / F.sum("batch_ms")).alias("rows_per_second"),
                 F.percentile_approx("batch_ms", F.lit(0.95)).alias("p95_batch_ms"),
                 F.percentile_approx("batch_ms", F.lit(0.99)).alias("p99_batch_ms"),
                 F.max("state_bytes").alias("max_state_bytes")))
