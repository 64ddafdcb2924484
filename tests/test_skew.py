"""One key with a third or more of all rows: same results, work spread out."""

from pyspark.sql import functions as F

from orderloom.operators import skew
from orderloom.operators.events import dedup_events
from orderloom.operators.lifecycle import lifecycle_detail
from orderloom.operators.linkage import execution_trace
from orderloom.operators.quality import missing_parent, order_exceptions

N = 30_000


def rows(spark):
    """Half of the rows belong to HOT, the rest to a thousand keys; some keys are NULL."""
    i = F.col("id")
    key = (F.when(i % 2 == 0, "HOT").when(i % 101 == 0, F.lit(None))
           .otherwise(F.concat(F.lit("k"), (i % 997).cast("string"))))
    return spark.range(N).select(
        key.alias("customer_order_id"), i.cast("string").alias("event_id"),
        i.alias("ts_event"), (i % 3).cast("string").alias("part"))


def hashes(spark, *values):
    literals = [F.lit(v) for v in values]
    return [spark.range(1).select(F.xxhash64(*literals)).first()[0]]


def test_hot_keys(spark):
    hot = hashes(spark, "HOT")
    assert skew.hot_keys(rows(spark), ["customer_order_id"], min_rows=1) == hot
    assert skew.hot_keys(rows(spark), ["customer_order_id"]) == []  # small: one task will do
    pairs = skew.hot_keys(rows(spark), ["customer_order_id", "part"], min_rows=1)
    assert pairs == sorted(h for part in "012" for h in hashes(spark, "HOT", part))


def test_salted_joins_equal_plain_joins(spark):
    facts = rows(spark).select("customer_order_id").distinct().where(
        "customer_order_id <> 'k5'").withColumn("v", F.length("customer_order_id"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = skew.join_facts(rows(spark), facts, ["customer_order_id"], how, hot=[])
        salted = skew.join_facts(rows(spark), facts, ["customer_order_id"], how,
                                 hot=hashes(spark, "HOT"))
        assert plain.columns == salted.columns
        assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def test_salting_spreads_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.createDataFrame([("HOT", 1)], "customer_order_id string, v int")

        def largest(hot):
            joined = skew.join_facts(rows(spark), facts, ["customer_order_id"], hot=hot)
            return (joined.groupBy(F.spark_partition_id()).count()
                    .agg(F.max("count")).first()[0])
        assert largest([]) == N // 2
        assert largest(hashes(spark, "HOT")) < N // 2 * 0.4  # four shuffle partitions
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_running_totals_over_chunks(spark):
    found = skew.running(
        rows(spark).withColumn("one", F.lit(1)), "customer_order_id", ["ts_event", "event_id"],
        {"seq": ("sum", "one"), "top": ("max", "ts_event")})
    lost = found.where("customer_order_id IS NULL")  # a key like any other
    assert lost.agg(F.max("seq")).first()[0] == lost.count() > 0
    hot = found.where("customer_order_id = 'HOT'")
    assert hot.where("seq <> ts_event / 2 + 1 OR top <> ts_event").isEmpty()
    assert hot.count() == N // 2


def hot_log(spark, log):
    """Order HOT: one NEW, then thousands of routes and fills; all else is one small order."""
    from conftest import BASE_MS, event
    few = log([event("NEW", customer_order_id="HOT", limit_price=10.0),
               event("NEW", customer_order_id="COLD", limit_price=10.0),
               event("ROUTE", 5, customer_order_id="COLD", route_id="R", firm_order_id="F2",
                     parent_firm_order_id="F1"),
               event("FILL", -1, customer_order_id="COLD", route_id="R", exec_price=99.0)])
    i = F.col("id")
    many = spark.range(3_000).select(
        F.concat(F.lit("e"), i.cast("string")).alias("event_id"),
        F.when(i % 2 == 0, "ROUTE").otherwise("FILL").alias("event_type"),
        (i - 500 + BASE_MS).alias("ts_event"), F.lit("HOT").alias("customer_order_id"),
        F.lit("F2").alias("firm_order_id"),
        F.when(i % 7 == 0, "nobody").otherwise("F1").alias("parent_firm_order_id"),
        F.concat(F.lit("R"), F.floor(i / 2).cast("string")).alias("route_id"),
        F.concat(F.lit("X"), i.cast("string")).alias("exec_id"),
        F.lit("XYZ").alias("symbol"), F.lit(1).alias("qty"), F.lit(20.0).alias("exec_price"))
    return few.unionByName(many, allowMissingColumns=True)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_operators_with_a_hot_order(spark, log):
    events = hot_log(spark, log).cache()
    hot = hashes(spark, "HOT")
    assert same(order_exceptions(events, hot=[]), order_exceptions(events, hot=hot))
    assert order_exceptions(events, ["FILL_BEFORE_NEW"], hot=hot).count() == 251
    pair = sorted(hashes(spark, "HOT", "F1") + hashes(spark, "HOT", "nobody"))
    assert skew.hot_keys(events.where("event_type = 'ROUTE'"),
                         ["customer_order_id", "parent_firm_order_id"], min_rows=1) == pair
    assert same(missing_parent(events, hot=[]), missing_parent(events, hot=pair))
    assert missing_parent(events, hot=pair).count() == 215
    assert same(execution_trace(events, hot=[]),
                execution_trace(events, hot=hashes(spark, "HOT", "R1")))
    parts = lifecycle_detail(events, 10).where("customer_order_id = 'HOT'")
    assert parts.select(F.size("active_routes") + F.size("executions")).distinct().collect() == [
        (10,)]
    assert parts.count() == 300


def test_one_order_in_one_second_is_spread(spark):
    """Many events of one order with the same time: no task sorts them all."""
    events = spark.range(200_000).select(
        F.lit("O1").alias("customer_order_id"), F.col("id").cast("string").alias("event_id"),
        F.lit(7).alias("ts_event"), F.lit(1).alias("one"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = skew.running(events, "customer_order_id", ["ts_event", "event_id"],
                             {"seq": ("sum", "one")})
        per_task = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in per_task) < 150_000
    assert found.agg(F.count_distinct("seq"), F.max("seq")).first() == (200_000, 200_000)


def test_planning_starts_no_job(spark, log):
    from orderloom.operators.lifecycle import lifecycle_snapshot
    from orderloom.operators.quality import all_exceptions
    events = hot_log(spark, log)
    spark.sparkContext.setJobGroup("planning", "")
    all_exceptions(events, lifecycle_snapshot(events, 0), 0)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") == []



def test_hot_event_is_deduplicated_map_side(spark, log):
    from conftest import event
    copies = log([event("FILL", event_id="same")]).crossJoin(spark.range(20_000)).drop("id")
    assert dedup_events(copies.repartition(8)).count() == 1
