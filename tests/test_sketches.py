import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import sketches as sk

SCHEMA = "trade_date string, ts_first_event long, ts_last_event long"


def _snapshots(spark, days):
    return spark.createDataFrame(
        [(day, 1000, None if ms is None else 1000 + ms) for day, took in days.items()
         for ms in took], SCHEMA)


def test_few_values_are_answered_exactly(spark):
    rows = _snapshots(spark, {"d1": range(1, 51), "d2": [*range(51, 101), None], "d3": [None]})
    days = sk.day_sketches(rows)
    assert {r.trade_date: (r.lifecycles, r.sum_ms) for r in days.collect()} == {
        "d1": (50, 1275), "d2": (50, 3775)}
    row = sk.sketched_percentiles(sk.merge_sketches(days)).first()
    assert tuple(row) == (100, 50.5, 50, 95, 99)
    one = sk.merge_sketches(days.where("trade_date = 'd2'"))
    assert sk.sketched_percentiles(one, [0.5]).first().p50_ms == 75


def test_nothing_to_merge(spark):
    days = sk.day_sketches(_snapshots(spark, {"d1": [None]}))
    assert days.collect() == []
    row = sk.sketched_percentiles(sk.merge_sketches(days)).first()
    assert tuple(row) == (0, None, None, None, None)


@pytest.mark.parametrize("draw", [
    lambda r: r.randint(0, 10**9), lambda r: int(r.lognormvariate(8, 3)),
    lambda r: r.choice([0, 0, 0, 7, 10**12])])
def test_ranks_stay_within_the_bound(spark, draw):
    rng = random.Random(5)
    rows = _snapshots(spark, {f"d{d:02}": [draw(rng) for _ in range(1500)] for d in range(20)})
    rows = rows.withColumn("part", F.substring("trade_date", 2, 1)).repartition(6)
    days = sk.day_sketches(rows).withColumn("part", F.substring("trade_date", 2, 1))
    found = sk.sketched_percentiles(sk.merge_sketches(days, "part"))
    errors = sk.rank_errors(rows, found, "part").collect()
    assert [r.lifecycles for r in found.collect()] == [15_000, 15_000]
    assert len(errors) == 2 and all(e <= sk.rank_bound() for r in errors for e in tuple(r)[1:])


def test_wrong_answers_show_as_errors(spark):
    rows = _snapshots(spark, {"d": range(1000)}).withColumn("part", F.lit("a"))
    found = spark.createDataFrame([("a", 600, 949, 5)], "part string, p50_ms long, "
                                  "p95_ms long, p99_ms long")
    row = sk.rank_errors(rows, found, "part").first()
    assert (round(row.p50_ms, 6), row.p95_ms, round(row.p99_ms, 6)) == (0.1, 0.0, 0.984)


def test_sketches_have_a_bounded_size(spark):
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise("cold").alias("trade_date"),
        F.lit(0).alias("ts_first_event"), F.xxhash64("id").bitwiseAND(2**40 - 1)
        .alias("ts_last_event"))
    sizes = sk.day_sketches(rows).select(F.octet_length("sketch").alias("size")).collect()
    assert len(sizes) == 2 and all(r.size < 16_000 for r in sizes)
