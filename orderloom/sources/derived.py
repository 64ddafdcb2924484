"""An order-event log derived from the `orders` and `lineitem` tables.

Every order becomes a NEW event, every (order, line number) a route with its outcome;
rules on the keys add the faults a real log has: missing parents, lost and late
messages, resends, busts, bad prices. `FIXTURES.md` section 4 lists them.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions.columns import event_time
from orderloom.operators.events import tag_late
from orderloom.schema import EVENT_FIELDS, EVENT_SCHEMA

ORDER = "customer_order_id"
DAY_MS = 86_400_000


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark, sf_dir):
    k = F.col("o_orderkey")
    return _table(spark, sf_dir, "orders").select(
        k.alias("k"), "o_custkey", "o_orderstatus", "o_orderpriority",
        (F.unix_millis(F.col("o_orderdate").cast("timestamp")) + (k % 86400) * 1000)
        .alias("t0"),
        (F.lit(100) + k % 200).cast("double").alias("lp"))


def _order_id():
    return F.concat(F.lit("CO-"), F.col("k").cast("string"))


def _lines(spark, sf_dir, tasks=None, with_id=False):
    """One row per (order, line number). Flags travel as numbers, so that the aggregation can hash
    instead of sort.

    With a number of `tasks` the rows are dealt by order once, which then also serves joins and
    totals by order; `with_id` by the order's id, which is then a column. The number is kept as
    given: a line becomes many wide messages after the shuffle, whose own size says little about
    them.
    """
    lines = _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "l_quantity",
        F.ascii("l_returnflag").alias("rf"), F.ascii("l_linestatus").alias("ls"))
    if tasks is not None:
        lines = lines.repartition(tasks, _order_id() if with_id else "k")
    return ((lines.withColumn(ORDER, _order_id()) if with_id else lines)
            .groupBy(*[ORDER] * with_id, "k", "n")
            .agg(F.sum("l_quantity").cast("int").alias("q"), F.min("rf").alias("rf"),
                 F.max("ls").alias("ls"))
            .withColumns({"rf": F.char("rf"), "ls": F.char("ls")}))


# Kinds of derived messages: number within a line's messages -> (event type, id prefix).
KINDS = {
    0: ("NEW", "NEW"), 1: ("ROUTE", "RTE"), 2: ("ACK", "ACK"), 3: ("FILL", "FIL"),
    4: ("FILL", "FIL"), 5: ("BUST", "BST"), 6: ("BUST", "BS2"), 7: ("REPLACE", "RPL"),
    8: ("CANCEL", "CXL"), 9: ("REJECT", "REJ"), 10: ("ALLOCATE", "AL1"),
    11: ("ALLOCATE", "AL2"),
}


def _by_kind(values, default=None):
    """A column that depends on the kind of the message."""
    out = F
    for kind, value in values.items():
        out = out.when(F.col("kind") == kind, value)
    return out if default is None else out.otherwise(default)


def _spread(rows: DataFrame, present) -> DataFrame:
    """One row per message: `present` maps a kind to the condition for it."""
    kinds = F.array(*[F.when(cond, F.lit(kind)) for kind, cond in present.items()])
    return rows.withColumn("kind", F.explode(kinds)).where("kind IS NOT NULL")


def _messages(rows: DataFrame, present, ts, ingest, **fields) -> DataFrame:
    kinds = {kind: KINDS[kind] for kind in present}
    event_ts = _by_kind(ts)
    values = {
        "event_id": F.concat_ws("-", _by_kind({i: F.lit(p) for i, (_, p) in kinds.items()}),
                                F.col("k").cast("string"), F.col("n").cast("string")),
        "event_type": _by_kind({i: F.lit(t) for i, (t, _) in kinds.items()}),
        "ts_event": event_ts,
        "ts_ingest": _by_kind(ingest, event_ts) if ingest else event_ts,
        "firm_id": F.lit("DEMO_FIRM"),
        "account_id": F.concat(F.lit("A"), F.col("o_custkey").cast("string")),
        ORDER: _order_id(),
        "symbol": F.concat(F.lit("SYM"), (F.col("k") % 50).cast("string")),
        "side": F.when(F.col("k") % 2 == 0, "BUY").otherwise("SELL"),
        **fields,
    }
    return _spread(rows, present).select(
        "k", *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
               for f in EVENT_SCHEMA.fields],
        (F.col("k") * 100 + F.coalesce("n", F.lit(0)) * 10 + F.col("kind"))
        .cast("long").alias("offset"))


def _id(prefix):
    return F.concat_ws("-", F.lit(prefix), F.col("k").cast("string"), F.col("n").cast("string"))


def _is_filled():
    return (F.col("ls") == "F") | (F.col("rf") == "R")


def _price():
    k, n, lp = F.col("k"), F.col("n"), F.col("lp")
    return (F.when((k + n) % 211 == 0, F.lit(0.0)).when((k + n) % 31 == 0, lp * 1.25)
            .otherwise(lp + (n - 4) * 0.125))


def _line_events(rows: DataFrame) -> DataFrame:
    k, n, q, lp = F.col("k"), F.col("n"), F.col("q"), F.col("lp")
    at = F.col("t0") + n * 100
    root = F.concat(F.lit("FO-"), k.cast("string"))
    busted = (F.col("rf") == "R") & (F.col("ls") == "O")
    fill_ts = F.when((k + n) % 29 == 0, at - 500).otherwise(at + 100)
    executed = F.col("kind") >= 3
    return _messages(
        rows,
        {1: (k + n) % 43 != 0, 2: (k + n) % 23 != 0, 3: _is_filled(),
         4: _is_filled() & (q % 13 == 0), 5: busted, 6: busted & (k % 7 == 0)},
        ts={1: at, 2: at + 50, 3: fill_ts, 4: fill_ts, 5: at + 2_000, 6: at + 3_000},
        ingest={2: F.when((k + n) % 11 == 0, at + 150_050).otherwise(at + 50),
                3: at + 100, 4: at + 5_100},
        firm_order_id=_id("FO"), route_id=_id("R"),
        parent_firm_order_id=_by_kind({
            1: F.when((k % 19 == 0) & (n == 1), F.lit(None))
            .when((k % 41 == 0) & (n == 2), F.concat(F.lit("FO-X"), k.cast("string")))
            .otherwise(root)}),
        venue=F.concat(F.lit("V"), (n % 5).cast("string")),
        exec_id=F.when(executed, _id("X")), qty=F.when(F.col("kind") == 6, q * 9).otherwise(q),
        limit_price=_by_kind({1: lp}), exec_price=F.when(F.col("kind").isin(3, 4), _price()))


def _order_events(rows: DataFrame) -> DataFrame:
    k, t0, tq, lp = F.col("k"), F.col("t0"), F.col("tq"), F.col("lp")
    root = F.concat(F.lit("FO-"), k.cast("string"))
    ordered = F.when(k % 17 == 0, F.floor(tq / 2)).otherwise(tq)
    return _messages(
        rows.withColumn("n", F.lit(None).cast("int")),
        {0: k % 101 != 0, 7: F.col("o_orderpriority") == "1-URGENT",
         8: (F.col("o_orderstatus") == "P") & (k % 3 == 0)},
        ts={0: t0, 7: t0 + 500,
            8: F.when(k % 7 == 0, t0 + DAY_MS).otherwise(t0 + 1_000)},
        ingest=None,
        firm_order_id=_by_kind({7: F.concat(root, F.lit("-r"))}, root),
        parent_firm_order_id=_by_kind({7: root}), qty=_by_kind({0: ordered}, tq),
        limit_price=_by_kind({0: lp, 7: lp - 1}))


def _with_envelope(events: DataFrame) -> DataFrame:
    return tag_late(
        events.select(
            *EVENT_FIELDS, F.timestamp_millis("ts_ingest").alias("kafka_timestamp"),
            (F.col("k") % 6).cast("int").alias("partition"), "offset")
        .withColumn("event_time", event_time()))


def placed_lines(spark: SparkSession, sf_dir: str, tasks=None) -> DataFrame:
    """The lines with their orders, sorted by order: all that messages are derived from, so that
    whoever keeps this narrow table derives the log by reading alone. With a number of `tasks` they
    are dealt by the order's id, as a table in as many buckets is.

    `tq` is the total quantity of an order's lines and `nth` counts them from 1.
    """
    lines = _lines(spark, sf_dir, tasks, with_id=True).where("k IS NOT NULL")
    of_order = Window.partitionBy("k", ORDER)
    counted = lines.withColumns({"tq": F.sum("q").over(of_order),
                                 "nth": F.row_number().over(of_order.orderBy("n"))})
    orders = _orders(spark, sf_dir).withColumn(ORDER, _order_id())
    return counted.join(orders, ["k", ORDER]).sortWithinPartitions("k", "n")


def event_log(spark: SparkSession, sf_dir: str, tasks=None, placed=None) -> DataFrame:
    """The raw log: all messages including resends, decoded, tagged late or not. `placed` are
    `placed_lines`, if they are there already."""
    placed = placed_lines(spark, sf_dir, tasks) if placed is None else placed
    return _with_envelope(_line_events(placed).unionByName(
        _order_events(placed.where("nth = 1"))))


def extended_events(spark: SparkSession, sf_dir: str, tasks=None, placed=None) -> DataFrame:
    """REJECT and ALLOCATE events that fit the log, for the rules that need them.

    Half of the routes without ACK are rejected. Every third line's execution is
    allocated to two sub-accounts; for every 47th (order + line) one share is lost.
    """
    k, n, q = F.col("k"), F.col("n"), F.col("q")
    at, half = F.col("t0") + n * 100, F.floor(q / 2)
    allocated = _is_filled() & (n % 3 == 0)
    rejected = F.col("kind") == 9
    customer = F.col("o_custkey").cast("string")
    return _with_envelope(_messages(
        placed_lines(spark, sf_dir, tasks) if placed is None else placed,
        {9: ((k + n) % 23 == 0) & (k % 2 == 0), 10: allocated, 11: allocated},
        ts={9: at + 60, 10: at + 5_000, 11: at + 5_000}, ingest=None,
        firm_order_id=_id("FO"), route_id=F.when(rejected, _id("R")),
        exec_id=F.when(~rejected, _id("X")),
        account_id=_by_kind({10: F.concat(F.lit("S1-A"), customer),
                             11: F.concat(F.lit("S2-A"), customer)},
                            F.concat(F.lit("A"), customer)),
        qty=_by_kind({10: half,
                      11: q - half - F.when((k + n) % 47 == 0, 1).otherwise(0)}, q),
        reason=F.when(rejected, "venue rejected")))


def replaced_again(events: DataFrame) -> DataFrame:
    """A replacement of every replacement, so that orders have chains of three nodes."""
    return events.where("event_type = 'REPLACE'").withColumns({
        "event_id": F.concat(F.lit("RP2-"), F.col("event_id")),
        "ts_event": F.col("ts_event") + 500, "ts_ingest": F.col("ts_ingest") + 500,
        "parent_firm_order_id": F.col("firm_order_id"),
        "firm_order_id": F.concat("firm_order_id", F.lit("-r"))})


def after_final(events: DataFrame) -> DataFrame:
    """Corrections of executions that arrive three days after they happened: busts of every 13th
    order's fills."""
    number = F.substring("customer_order_id", 4, 20).cast("long")
    return events.where((F.col("event_type") == "FILL") & (number % 13 == 0)).withColumns({
        "event_id": F.concat(F.lit("BS3-"), F.col("event_id")), "event_type": F.lit("BUST"),
        "exec_price": F.lit(None).cast("double"),
        "ts_ingest": F.col("ts_event") + 3 * DAY_MS,
        "kafka_timestamp": F.timestamp_millis(F.col("ts_event") + 3 * DAY_MS),
        "is_late": F.lit(True)})


def messages(events: DataFrame) -> DataFrame:
    """The log as it lies in a topic: JSON payload, key and envelope."""
    return events.select(
        F.col("customer_order_id").alias("key"),
        F.to_json(F.struct(*EVENT_FIELDS)).alias("value"),
        F.col("kafka_timestamp").alias("timestamp"), "partition", "offset")


def foreign_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of another producer, which are no order events: `props` of table `events`."""
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("event_id") % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"))


def internal_records(spark: SparkSession, sf_dir: str, tasks=None):
    """A firm's own books, from the same tables: (orders, executions).

    They record the full ordered quantity, lack every 37th execution, hold some the log
    never saw (every 53rd unfilled line), and differ in price on every 59th.
    """
    k, n = F.col("k"), F.col("n")
    lines, orders = _lines(spark, sf_dir, tasks), _orders(spark, sf_dir)
    order_id = F.concat(F.lit("CO-"), k.cast("string"))
    books = lines.groupBy("k").agg(F.sum("q").alias("total_qty")).select(
        order_id.alias("customer_order_id"), "total_qty")
    filled = _is_filled()
    executions = (
        lines.join(orders.select("k", "lp"), "k")
        .where((filled & ((k + n) % 37 != 0)) | (~filled & ((k + n) % 53 == 0)))
        .select(order_id.alias("customer_order_id"),
                F.concat_ws("-", F.lit("X"), k.cast("string"), n.cast("string"))
                .alias("exec_id"),
                F.col("q").cast("long").alias("qty"),
                (_price() + F.when((k + n) % 59 == 0, 0.5).otherwise(0.0)).alias("price")))
    return books, executions


def customer_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference data per account."""
    return _table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("account_id"),
        F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"))
