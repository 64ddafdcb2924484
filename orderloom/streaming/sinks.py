"""Streaming sinks. Each query has its own checkpoint; each batch replaces its own output."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.operators.events import encode_json
from orderloom.operators.quality import snapshot_exceptions
from orderloom.session import MESSAGES, cut_lineage
from orderloom.sources.tables import read_if_there, read_snapshot_table, write_snapshot_table

ORDER = "customer_order_id"


def checkpoint_path(root: str, query: str) -> str:
    return f"{root.rstrip('/')}/checkpoints/{query}"


def _start(writer, trigger):
    """`trigger`: keyword arguments of `DataStreamWriter.trigger`, none for back-to-back."""
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_query(writer, root: str, name: str, mode="append", trigger=None):
    """Starts a writer with a checkpoint of its own below `root`."""
    return _start(writer.option("checkpointLocation", checkpoint_path(root, name))
                  .outputMode(mode), trigger)


def write_append(df: DataFrame, name: str, root: str, fmt="parquet", trigger=None, key=ORDER,
                 **options):
    """Append rows as JSON messages keyed by order: to files, or to a broker topic."""
    if fmt != "kafka":
        options = {"path": f"{root.rstrip('/')}/{name}", **MESSAGES, **options}
    return _start(
        encode_json(df, key).writeStream.queryName(name).format(fmt).options(**options)
        .option("checkpointLocation", checkpoint_path(root, name)).outputMode("append"),
        trigger)


def batch_path(path, batch_id):
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def merge_exceptions(snapshots: DataFrame, path: str) -> None:
    """Keeps a table of exceptions by id, each OPEN or RESOLVED, up to date with a batch of changed
    snapshots.

    What the rules find in the batch is open. What the table holds open for an order-day of the
    batch and they no longer find, is resolved; if it comes back, it is open again. Only the days
    that the batch names are read and written. A repeated batch leaves the same table.
    """
    spark, key = snapshots.sparkSession, [ORDER, "trade_date"]
    staged = cut_lineage(snapshots, "exceptions")
    days = [r[0] for r in staged.select("trade_date").distinct().collect()]
    if not days:
        return
    found = snapshot_exceptions(staged, keep=("day",)).withColumnRenamed(
        "day", "trade_date").withColumn("state", F.lit("OPEN"))
    if read_if_there(spark, path) is not None:
        old = read_snapshot_table(spark, path).where(F.col("trade_date").isin(days)).select(
            *found.columns)
        gone = old.join(found.select("exception_id"), "exception_id", "left_anti")
        touched = staged.select(*key, F.lit(True).alias("touched"))
        found = found.unionByName(gone.join(touched, key, "left").withColumn(
            "state", F.when(F.col("touched"), "RESOLVED").otherwise(F.col("state")))
            .drop("touched"))
    write_snapshot_table(cut_lineage(found, "exceptions"), path, ("trade_date",))


def read_exceptions(spark: SparkSession, path: str, state="OPEN") -> DataFrame:
    """The exceptions in that state, in the table that `merge_exceptions` keeps."""
    return read_snapshot_table(spark, path).where(F.col("state") == state)


def snapshot_batch_writer(root: str, checks, name="lifecycle", publish=None, exceptions_table=None):
    """What `write_snapshots` does with each batch: `(frame, batch id) -> None`."""
    lifecycles, exceptions = f"{root.rstrip('/')}/{name}", f"{root.rstrip('/')}/exceptions"

    def write_batch(batch: DataFrame, batch_id: int):
        here = batch_path(lifecycles, batch_id)
        batch.write.mode("overwrite").parquet(here)
        written = batch.sparkSession.read.schema(batch.schema).parquet(here)
        found = checks(written)
        found.write.mode("overwrite").parquet(batch_path(exceptions, batch_id))
        if publish is not None:
            publish(written, name)
            publish(found, "exceptions")
        if exceptions_table is not None:
            merge_exceptions(written, exceptions_table)

    return write_batch


def merge_newest(batch: DataFrame, path: str, partition_by=("trade_date", "symbol"),
                 key=(ORDER, "trade_date")) -> None:
    """Puts the rows of a batch into a partitioned table, in place of those with their key.

    Only the days that the batch names are read and written, from a staged copy. A repeated
    batch leaves the same table.
    """
    spark = batch.sparkSession
    staged = cut_lineage(batch, "merge")
    first = partition_by[0]
    days = [r[0] for r in staged.select(first).distinct().collect()]
    if not days:
        return
    if read_if_there(spark, path) is None:  # the first batch makes the table
        old = staged.where("false")
    else:
        old = read_snapshot_table(spark, path).where(F.col(first).isin(days))
    kept = old.join(staged.select(*key), list(key), "left_anti")
    write_snapshot_table(cut_lineage(kept.unionByName(staged), "merge"), path, partition_by)


def to_table(path: str, partition_by=("trade_date", "symbol")):
    """A `publish` callback that keeps a partitioned table of the newest snapshots."""
    def publish(df: DataFrame, kind: str):
        if kind != "exceptions":
            merge_newest(df, path, partition_by)
    return publish


def write_snapshots(snapshots: DataFrame, root: str, checks, trigger=None, name="lifecycle",
                    publish=None, exceptions_table=None):
    """Update mode: each batch writes the changed snapshots and the exceptions in them.

    The exceptions are found in the files just written, so the stateful plan runs once
    and nothing needs to stay cached. A repeated batch overwrites its own folders.
    `checks` maps snapshots to exceptions; `publish(df, kind)`, if given, also receives
    both frames, for instance to send them to a broker. `exceptions_table` is the path of a table
    by exception id, which tells open ones from resolved ones (`merge_exceptions`).
    """
    return _start(
        snapshots.writeStream.queryName(name)
        .foreachBatch(snapshot_batch_writer(root, checks, name, publish, exceptions_table))
        .option("checkpointLocation", checkpoint_path(root, name)).outputMode("update"),
        trigger)


def to_broker(options: dict, topics: dict):
    """A `publish` callback that sends keyed JSON messages to broker topics."""
    def publish(df: DataFrame, kind: str):
        (encode_json(df, ORDER).write.format("kafka").options(**options)
         .option("topic", topics[kind]).save())
    return publish


def write_batches(df: DataFrame, name: str, root: str, mode="append", trigger=None):
    """Rows as they are, one folder per batch; also for modes a file sink refuses."""
    path = f"{root.rstrip('/')}/{name}"
    return _start(
        df.writeStream.queryName(name)
        .foreachBatch(lambda batch, i: batch.write.mode("overwrite")
                      .parquet(batch_path(path, i)))
        .option("checkpointLocation", checkpoint_path(root, name)).outputMode(mode), trigger)


def write_console(df: DataFrame, name="console", trigger=None):
    """Changed rows on the console, for debugging."""
    return _start(df.writeStream.queryName(name).format("console").outputMode("update")
                  .option("truncate", "false"), trigger)


def read_newest(spark: SparkSession, path: str, key) -> DataFrame:
    """The newest version of each key among the batches written below `path`."""
    newest = Window.partitionBy(*key).orderBy(F.col("batch_id").desc())
    return (spark.read.parquet(path).withColumn("_n", F.row_number().over(newest))
            .where("_n = 1").drop("_n", "batch_id"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")
