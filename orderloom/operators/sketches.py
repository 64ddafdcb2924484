"""Percentiles of any range of days from stored sketches, without reading snapshots.

A day's durations go into one KLL sketch of bounded size, built by the aggregate that Spark has for
it, with partial sketches before the shuffle. Sketches of days merge into that of a range; counts
and means stay exact.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches: about 8 KB for two million values.
K = 400
POINTS = (0.5, 0.95, 0.99)


def rank_bound(k: int = K) -> float:
    """By how much the rank of an answered percentile may miss: twice the published bound, which
    holds for 99 of 100 sketches of size parameter `k`."""
    return 2 * 2.296 / k**0.9723


def _duration() -> Column:
    return F.col("ts_last_event") - F.col("ts_first_event")


def day_sketches(snapshots: DataFrame, k: int = K, day="trade_date") -> DataFrame:
    """One row per day with finished durations: `day`, lifecycles, sum_ms and sketch (binary).

    Days without a duration have no row. A corrected day is sketched anew from its snapshots and
    replaces its row; sketches cannot forget values.
    """
    return (snapshots.select(day, _duration().alias("ms")).where("ms IS NOT NULL").groupBy(day)
            .agg(F.count("*").alias("lifecycles"), F.sum("ms").alias("sum_ms"),
                 F.kll_sketch_agg_bigint("ms", F.lit(k)).alias("sketch")))


def merge_sketches(sketches: DataFrame, *by) -> DataFrame:
    """Sketch rows merged per `by`, columns or expressions with a name; all into one row without
    any, which has lifecycles 0 and no sketch if there is nothing to merge."""
    found = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("lifecycles"), F.lit(0)).alias("lifecycles"),
        F.sum("sum_ms").alias("sum_ms"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return found.withColumn("sketch", F.when(F.col("lifecycles") > 0, F.col("sketch")))


def sketched_percentiles(merged: DataFrame, points=POINTS) -> DataFrame:
    """`merged` with mean_ms (exact) and one column per point (p50_ms: a duration that occurs,
    whose rank misses the point by `rank_bound` at most) in place of the sketch; null without
    durations."""
    columns = [c for c in merged.columns if c not in ("sum_ms", "sketch")]
    known = F.col("lifecycles") > 0
    return merged.select(
        *columns, (F.col("sum_ms") / F.col("lifecycles")).alias("mean_ms"),
        *[F.when(known, F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))))
          .alias(_name(p)) for p in points])


def _name(point) -> str:
    return f"p{int(point * 100)}_ms"


def rank_errors(snapshots: DataFrame, found: DataFrame, by, points=POINTS) -> DataFrame:
    """How far the ranks of sketched percentiles miss: `by`, and per point the distance from it to
    the share of durations below the answer, or up to it, whichever is nearer; 0 between the two.

    `found` has one row per value of column `by`, which `snapshots` has too.
    """
    rows = (snapshots.select(by, _duration().alias("ms")).where("ms IS NOT NULL")
            .groupBy(by, "ms").agg(F.count("*").alias("n")).join(found, by))
    total = F.sum("n")

    def error(p):
        answer = F.col(_name(p))
        below = F.sum(F.when(F.col("ms") < answer, F.col("n")).otherwise(0)) / total
        upto = F.sum(F.when(F.col("ms") <= answer, F.col("n")).otherwise(0)) / total
        return F.greatest(F.lit(0.0), below - p, p - upto)

    return rows.groupBy(by).agg(*[error(p).alias(_name(p)) for p in points])
