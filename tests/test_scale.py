"""What keeps the work of large inputs in proportion: layout, partitions, rows moved."""

import pathlib
from types import SimpleNamespace

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import event
from orderloom.functions.columns import trade_date
from orderloom.operators import skew
from orderloom.operators.events import dedup_events
from orderloom.plans import queries, workspace
from orderloom.plans.workspace import Workspace, write_topic
from orderloom.session import (
    FIRST_PARTITIONS,
    SHUFFLE_PARTITIONS,
    TASK_BYTES,
    buckets_of,
    prepare,
    size_for,
)
from orderloom.sources import derived

ORDERS = """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
    o_orderdate timestamp, o_orderpriority string"""
LINES = """l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string,
    l_linestatus string"""


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stored_log_is_deduplicated_like_any(spark, log, tmp_path):
    rows = [event("FILL", i, event_id=f"e{i % 40}", ts_ingest=100 - i) for i in range(60)]
    rows += [event("FILL", 5, event_id="resent", ts_ingest=i) for i in (3, 1, 2)]
    rows += [event("FILL", 5, event_id="none", ts_ingest=i) for i in (3, 1)]
    rows += [event("NEW", event_id="no time", ts_ingest=i) for i in (2, 1)]
    (log(rows).withColumn("event_time", F.when(F.col("event_id") != "no time", F.col("event_time")))
     .withColumn("event_id", F.nullif("event_id", F.lit("none")))
     .write.parquet(str(tmp_path / "log")))
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert dedup_events(stored, stored=True).count() == 60 + 3
    assert same(dedup_events(stored, stored=True), dedup_events(stored))


def test_a_stored_log_stays_in_place(spark, log, tmp_path):
    """Rows without a copy keep the task they are read by."""
    log([event("NEW", i) for i in range(500)]).repartition(3).write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log")).withColumn("at", F.input_file_name())
    kept = dedup_events(stored, stored=True).select("at", F.spark_partition_id().alias("task"))
    assert kept.count() == 500
    assert max(r.n for r in kept.groupBy("task").agg(
        F.count_distinct("at").alias("n")).collect()) <= 3
    assert kept.distinct().count() == kept.select("at").distinct().count()


def test_session_follows_the_input(spark):
    small, large = size_for(prepare(spark), 1000), size_for(prepare(spark), 1000 * TASK_BYTES)
    assert small.conf.get(SHUFFLE_PARTITIONS) == str(spark.sparkContext.defaultParallelism)
    assert large.conf.get(FIRST_PARTITIONS) == "1000"
    assert large.conf.get(SHUFFLE_PARTITIONS) == "400"
    assert large.conf.get("spark.sql.files.maxPartitionBytes") == str(16 << 20)
    assert "RocksDB" in large.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get(SHUFFLE_PARTITIONS) == "4"  # the caller's stays as it was


def write_tables(spark, folder, copies=1):
    spark.range(200).selectExpr(
        "nullif(id, 199)", "id % 20", "substring('FOP', int(id % 3) + 1, 1)", "1d",
        "timestamp_seconds(id * 9000)", "if(id % 5 = 0, '1-URGENT', '3-MEDIUM')",
        f"explode(sequence(1, if(id % 9 = 0, {copies}, 1)))").drop("col").toDF(
        *[c.split()[0] for c in ORDERS.split(",")]).write.parquet(f"{folder}/orders.parquet")
    spark.range(900).selectExpr(
        "nullif(id % 210, 209)", "nullif(int(id % 4), 3)", "double(id % 50)",
        "substring('RAN', int(id % 3) + 1, 1)", "substring('OF', int(id % 2) + 1, 1)").toDF(
        *[c.split()[0] for c in LINES.split(",")]).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_log_in_so_many_tasks(spark, tmp_path):
    sf_dir = write_tables(spark, tmp_path)
    dealt = derived.event_log(spark, sf_dir, 7)
    assert same(dealt, derived.event_log(spark, sf_dir))
    dealt.write.parquet(str(tmp_path / "log"))
    files = spark.read.parquet(str(tmp_path / "log")).select(F.input_file_name()).distinct().count()
    assert files >= 7


def test_every_order_has_one_total(spark, tmp_path):
    """Repeated orders come once each; orders without lines and lines without orders do not."""
    sf_dir = write_tables(spark, tmp_path, copies=2)
    placed = derived.placed_lines(spark, sf_dir, 3)
    lines, orders = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    totals = lines.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.sum("l_quantity").cast("long").alias("tq"))
    assert same(placed.where("nth = 1").select("k", "tq"),
                orders.select(F.col("o_orderkey").alias("k")).join(totals, "k"))
    assert placed.count() == lines.select(
        F.col("l_orderkey").alias("k"), "l_linenumber").distinct().join(
        orders.select(F.col("o_orderkey").alias("k")), "k").count()


def test_unique_events_stay_in_the_log(spark, tmp_path):
    """Only events that may have a copy are written a second time."""
    w = Workspace(spark, write_tables(spark, tmp_path, copies=2))
    log, unique = w.event_log(), w.unique_events()
    assert same(unique, dedup_events(log)) and unique.count() < log.count()
    assert same(log, derived.event_log(w.spark, w.sf_dir))
    copied = log.groupBy("event_id", "event_time").count().where("count > 1").count()
    place = unique.groupBy(F.input_file_name().contains("/event_log-").alias("there")).count()
    assert {r.there: r["count"] for r in place.collect()} == {
        True: unique.count() - copied, False: copied}


def test_snapshot_table_lies_by_trading_day(spark, tmp_path):
    w = Workspace(spark, write_tables(spark, tmp_path))
    table = queries.write_snapshot_table(w)
    days = {r.trade_date for r in w.snapshots().select("trade_date").distinct().collect()}
    folders = {f.rsplit("/", 2)[1] for f in table.inputFiles()}
    assert {f.partition("=")[::2] for f in folders} == {
        ("trade_date", d or "__HIVE_DEFAULT_PARTITION__") for d in days}
    assert same(table, queries._flat_snapshot(w.snapshots()))


def test_running_totals_with_and_without_hot_keys(spark, monkeypatch):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 50 > 0, F.concat(
            F.lit("k"), (F.col("id") % 700).cast("string"))).alias("k"), "id",
        F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("v"))
    totals = {"s": ("sum", "v"), "m": ("max", "v")}
    plain = skew.running(rows, "k", ["id"], totals)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan
    assert same(plain, skew.running(rows, "k", ["id"], totals, spread=True))
    monkeypatch.setattr(skew, "RUNNING_MIN_ROWS", 500)
    assert same(plain, skew.running(rows, "k", ["id"], totals))


def test_tasks_share_a_file_of_the_topic(spark, tmp_path):
    """A stream that takes one file at a time must not read it in one task."""
    rows = spark.range(0, 60_000, 1, 3).selectExpr(
        "string(id) AS key", "sha2(string(id), 512) AS value", "now() AS timestamp",
        "0 AS partition", "id AS offset")
    write_topic(rows, str(tmp_path / "topic"))
    groups = [pq.ParquetFile(f).num_row_groups for f in (tmp_path / "topic").glob("*.parquet")]
    assert len(groups) == 3 and min(groups) > 1


def test_topic_alone_writes_no_log(spark, tmp_path):
    """The messages are those of the log, which nobody has asked for; no dictionary holds them."""
    w = Workspace(spark, write_tables(spark, tmp_path, copies=2))
    path = w.topic_path().removeprefix("file:")
    assert w._key("event_log") not in workspace._written
    assert same(w.topic(), derived.messages(w.event_log()))
    assert same(w.messages(), w.topic())
    column = next(c for f in pathlib.Path(path).glob("*.parquet")
                  for c in pq.ParquetFile(f).metadata.row_group(0).to_dict()["columns"]
                  if c["path_in_schema"] == "value")
    assert not any("DICTIONARY" in e for e in column["encodings"])


def test_stores_follow_the_input(spark):
    """Spark's default number of partitions is no choice of the caller, and each store has files in
    every micro-batch. Tables in buckets keep their number."""
    cores = spark.sparkContext.defaultParallelism
    for given in (None, 60):
        session = spark.newSession()
        session.conf.unset(SHUFFLE_PARTITIONS)
        if given:
            session.conf.set(SHUFFLE_PARTITIONS, str(given))
        assert size_for(session, 1000).conf.get(SHUFFLE_PARTITIONS) == str(max(given or 0, cores))
        assert size_for(session, 400 * TASK_BYTES).conf.get(SHUFFLE_PARTITIONS) == "160"
        assert buckets_of(session) == 400


def test_links_move_only_events_that_may_repeat(spark, tmp_path, monkeypatch):
    w, given = Workspace(spark, write_tables(spark, tmp_path, copies=2)), []
    whole = queries.ev.dedup_events
    monkeypatch.setattr(queries.ev, "dedup_events", lambda events, stored=False: given.append(
        stored) or whole(events, stored))
    links = queries.linkages(w)
    assert given[0]
    assert same(links, queries.lk.linkages(whole(w.event_log())))


def test_growing_topic_comes_from_the_log(spark, tmp_path):
    """Every message is written once, in few files."""
    w, seen = Workspace(spark, write_tables(spark, tmp_path)), []
    ended = SimpleNamespace(awaitTermination=lambda: None)
    queries._as_it_arrives(w, lambda path: seen.append((path, len(
        spark.read.parquet(path).inputFiles()))) or ended)
    assert w._key("topic") not in workspace._written
    assert len(seen) == 3 and len({path for path, _ in seen}) == 1
    assert seen[-1][1] <= 3 * workspace.TOPIC_FILES
    timed = derived.messages(w.event_log()).where("timestamp IS NOT NULL")
    assert same(spark.read.parquet(seen[-1][0]), timed) and not timed.isEmpty()


def test_corrections_of_the_stream_read_the_log_where_it_lies(spark, tmp_path, monkeypatch):
    w, used = Workspace(spark, write_tables(spark, tmp_path)), []
    monkeypatch.setattr(queries, "_as_it_arrives", lambda w, run: run("none"))
    monkeypatch.setattr(queries, "read_event_stream", lambda *args: w.decoded())
    monkeypatch.setattr(queries.corrections, "start_corrections",
                        lambda late, log, *args: used.append(log()))
    queries._corrected(w)
    assert w._key("monthly_log") not in workspace._written
    days = used[0].select("customer_order_id", trade_date().alias("trade_date")).limit(5)
    touched = used[0].withColumn("trade_date", trade_date()).join(
        days.hint("shuffle_hash"), ["customer_order_id", "trade_date"], "left_semi")
    assert "Bucketed: true" in touched._jdf.queryExecution().executedPlan().toString()


def test_state_is_kept_compact(spark):
    assert size_for(prepare(spark), 1000).conf.get(
        "spark.sql.streaming.stateStore.compression.codec") == "zstd"
