"""Joins and running totals that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.session import cut_lineage

HOT_SHARE = 0.01          # a key with this share of the rows is hot ...
HOT_MIN_ROWS = 1_000_000  # ... unless one task handles it easily anyway
SALTS = 64
# a key of running totals is hot with this share of the rows, if one task does not sort it easily
RUNNING_SHARE = 0.002
RUNNING_MIN_ROWS = 50_000


def hot_keys(rows: DataFrame, keys, share=HOT_SHARE, min_rows=HOT_MIN_ROWS):
    """Hashes of the keys that hold at least `share` of the rows: at most 1/share numbers.

    One pass over the key columns with a fixed-size sketch per task, whose error is below
    half the share. The answer only steers the layout of a join: neither a key it misses
    nor two keys with one hash change a result.
    """
    limit = int(1 / share)
    found = (
        rows.select(F.xxhash64(*keys).alias("k"))
        .agg(F.expr(f"approx_top_k(k, {limit}, {limit * 10})").alias("top"),
             F.count("*").alias("n"))
        .select("n", F.explode("top").alias("t"))
        .where((F.col("t.count") >= F.col("n") * share) & (F.col("t.count") >= min_rows))
        .select("t.item"))
    return sorted(r.item for r in found.collect())


def join_facts(rows: DataFrame, facts: DataFrame, keys, how="inner", hot=None,
               spread_by=("event_id", "ts_event"), salts=SALTS) -> DataFrame:
    """Equi-join skewed `rows` to `facts` that hold each key at most once, with one type on
    both sides.

    `hot` are hashes of keys, as `hot_keys` finds them. Their rows are spread over `salts` tasks
    by `spread_by`, and the single fact of such a key is copied to each of them (at most
    1/share x salts extra rows). Without hot keys this is a plain join, which adaptive execution
    splits where it can. The operators start no job for it: whoever knows the data passes `hot`.
    """
    if not hot:
        return rows.join(facts, list(keys), how)
    is_hot = F.xxhash64(*keys).isin(hot)
    salted = rows.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
        .otherwise(0))
    copies = facts.withColumn(
        "_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1)))
                           .otherwise(F.array(F.lit(0)))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def running(rows: DataFrame, key, order_by, totals, spread=False) -> DataFrame:
    """Running aggregates per `key` along `order_by` without sorting a whole hot key in one task.

    Hot keys, if there are any, and all keys with `spread` (for rows of few keys) take the way of
    `_running_spread`, the others a window per key, which moves each row once. NULL is a key like
    any other. `order_by` should be unique within a key. `totals` maps an output name to
    `(aggregate name, input column)` with aggregate `sum` or `max`.
    """
    if spread:
        return _running_spread(rows, key, order_by, totals)
    hot = hot_keys(rows, [key], RUNNING_SHARE, RUNNING_MIN_ROWS)
    if hot:
        is_hot = F.xxhash64(key).isin(hot)
        return _running_by_key(rows.where(~is_hot), key, order_by, totals).unionByName(
            _running_spread(rows.where(is_hot), key, order_by, totals))
    return _running_by_key(rows, key, order_by, totals)


def _running_by_key(rows, key, order_by, totals):
    along = Window.partitionBy(key).orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, 0)
    sums = {name: F.sum(F.coalesce(F.col(col), F.lit(0))) if agg == "sum" else F.max(col)
            for name, (agg, col) in totals.items()}
    return rows.select(*rows.columns, *[total.over(along).alias(name)
                                        for name, total in sums.items()])


def _running_spread(rows, key, order_by, totals):
    """`running` for keys of any size.

    The rows are sorted over all tasks by (key, order) and written to the shared folder with the
    number of their task, so a key of any size, even one whose rows share a time, is spread
    evenly. Each task totals its part of a key; what earlier tasks hold of the key is added to
    the running values inside the task.
    """
    dealt = cut_lineage(rows.repartitionByRange(key, *order_by)
                        .withColumn("_task", F.spark_partition_id()), "running")
    per_task = dealt.groupBy(F.col(key).alias("_key"), F.col("_task").alias("_of")).agg(
        *[getattr(F, agg)(col).alias(f"_t_{name}") for name, (agg, col) in totals.items()])
    before = Window.partitionBy("_key").orderBy("_of").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = per_task.select(
        "_key", "_of",
        *[getattr(F, agg)(f"_t_{name}").over(before).alias(f"_o_{name}")
          for name, (agg, _) in totals.items()])
    inside = Window.partitionBy("_task", key).orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, 0)
    merge = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
             "max": F.greatest}
    here = dealt.withColumns({
        f"_i_{name}": getattr(F, agg)(col).over(inside) for name, (agg, col) in totals.items()})
    joined = here.join(
        offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_task") == F.col("_of")))
    return joined.select(*rows.columns, *[
        merge[agg](F.col(f"_o_{name}"), F.col(f"_i_{name}")).alias(name)
        for name, (agg, _) in totals.items()])
