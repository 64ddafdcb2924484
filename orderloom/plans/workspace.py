"""The tables of one data set: the derived event log and what the pipeline keeps of it.

Each is written once per session to the shared folder and then read like any table, so
queries prune columns, push filters down and start from real sizes.
"""

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.columns import trade_date
from orderloom.operators.events import (
    MAY_REPEAT,
    decode_events,
    dedup_events,
    mark_repeats,
    repeated_bits,
    tag_late,
)
from orderloom.operators.lifecycle import lifecycle_snapshot
from orderloom.operators.quality import all_exceptions
from orderloom.session import (
    DELTA,
    MESSAGES,
    folder_exists,
    prepare,
    size_for,
    tasks_for,
    work_folder,
    write_buckets,
)
from orderloom.sources import derived
from orderloom.sources.event_log import read_messages
from orderloom.sources.tables import (
    read_snapshot_table,
    with_month,
    write_lookup_index,
    write_snapshot_table,
)

SNAPSHOT_MS = 1_000_000_000_000   # fixed snapshot and audit time, so results repeat
AS_OF_MS = 946_684_800_000        # 2000-01-01, the "now" of checks and retention
INDEX_SLOTS = 64
#: Files of the topic: a stream that takes one file at a time has so many micro-batches at most.
#: Small row groups let all tasks share in a file: JSON takes ten times its bytes once it is read.
TOPIC_FILES = 24
TOPIC_BLOCK = 1 << 20
TOPIC_OPTIONS = MESSAGES | {"parquet.block.size": TOPIC_BLOCK}

#: The parts of the log's table: events without a copy, those that may have one, and the first of
#: each of these.
PART, SINGLE, RESENT, FIRST = "part", 0, 1, 2
ORDER = "customer_order_id"

_written = {}


def write_topic(messages: DataFrame, path: str) -> None:
    """Adds messages to a stored topic, in files that a stream takes in one micro-batch."""
    messages.coalesce(TOPIC_FILES).write.mode("append").options(**TOPIC_OPTIONS).parquet(path)


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.input_bytes = sum(self._version[1::2])
        size_for(self.spark, self.input_bytes)

    @functools.cached_property
    def _version(self):
        """Changes when a source file does."""
        found = []
        for name in ("orders", "lineitem"):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/{name}.parquet")
            store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            found += [store.getFileStatus(path).getModificationTime(),
                      store.getContentSummary(path).getLength()]
        return tuple(found)

    def _key(self, name):
        return self.spark.conf.get("spark.app.id"), self.sf_dir, self._version, name

    def _table(self, name, build, partition_by=(), bucketed=True, **options) -> DataFrame:
        """The table `name`, from `build()` at the first call; in buckets by order unless it has no
        orders."""
        key = self._key(name)
        if key in _written:
            path, table = _written[key]
            if folder_exists(self.spark, path):  # or someone emptied the folder
                return self._read(path, table)
        path, built = work_folder(self.spark, name), build()
        if bucketed:
            table = write_buckets(built, path, self._tasks(), ORDER, partition_by, **options)
        else:
            built.write.options(**options).partitionBy(*partition_by).parquet(path)
            table = built.schema
        _written[key] = path, table
        return self._read(path, table)

    def _read(self, path, table) -> DataFrame:
        return (self.spark.table(table) if isinstance(table, str)
                else self.spark.read.schema(table).parquet(path))

    def _tasks(self):
        return tasks_for(self.spark, self.input_bytes)

    def placed_lines(self) -> DataFrame:
        """What the log is derived from: every input row is moved once, into a narrow table."""
        return self._table("placed_lines", lambda: derived.placed_lines(
            self.spark, self.sf_dir, self._tasks()), **DELTA)

    def _derived_log(self) -> DataFrame:
        return derived.event_log(self.spark, self.sf_dir, placed=self.placed_lines())

    def _log_parts(self) -> DataFrame:
        """The raw log in two parts: events that may have a copy, and all others. As the part is
        known before the log is written, nothing of it needs to be written again without copies."""
        def build():
            bits = self._table("repeated_bits", lambda: repeated_bits(self._derived_log()),
                               bucketed=False)
            marked = mark_repeats(self._derived_log(), bits)
            return marked.withColumn(PART, F.when(F.col(MAY_REPEAT), RESENT).otherwise(SINGLE)
                                     ).drop(MAY_REPEAT)

        return self._table("event_log", build, partition_by=(PART,), **DELTA)

    def event_log(self) -> DataFrame:
        """Raw: every message, resends included."""
        return self._log_parts().where(F.col(PART).isin(SINGLE, RESENT)).drop(PART)

    def unique_events(self) -> DataFrame:
        """The log without resends: its events without a copy where they lie, and the first of each
        of the others, which become a third part of the log's table, so that all are one scan."""
        log = self._log_parts()
        _, table = _written[self._key("event_log")]
        key = self._key(f"first of {table}")
        if key not in _written or not folder_exists(self.spark, _written[key][0]):
            path = work_folder(self.spark, "resent")
            first = dedup_events(log.where(F.col(PART) == RESENT).drop(PART))
            write_buckets(first.repartition(self._tasks(), ORDER), path, self._tasks(), ORDER,
                          **DELTA)
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PART} = {FIRST})")
            self.spark.sql(f"ALTER TABLE {table} ADD PARTITION ({PART} = {FIRST}) "
                           f"LOCATION '{path}'")
            _written[key] = path, None
        return self.spark.table(table).where(F.col(PART).isin(SINGLE, FIRST)).drop(PART)

    def extended_events(self) -> DataFrame:
        """The unique events plus rejections and allocations."""
        return self.unique_events().unionByName(derived.extended_events(
            self.spark, self.sf_dir, placed=self.placed_lines()))

    def messages(self) -> DataFrame:
        """The log as JSON messages, not stored. Without a table of the log they are derived like it:
        who needs nothing but messages writes them alone."""
        return derived.messages(self.event_log() if self._key("event_log") in _written
                                else self._derived_log())

    def topic_path(self) -> str:
        """Folder of the log as JSON messages."""
        self._table("topic", lambda: self.messages().coalesce(TOPIC_FILES),
                    bucketed=False, **TOPIC_OPTIONS)
        return _written[self._key("topic")][0]

    def topic(self) -> DataFrame:
        return read_messages(self.spark, self.topic_path())

    def decoded(self) -> DataFrame:
        return tag_late(decode_events(self.topic()))

    def snapshots(self) -> DataFrame:
        return self._table(
            "snapshots", lambda: lifecycle_snapshot(self.unique_events(), SNAPSHOT_MS))

    def published(self) -> DataFrame:
        """Snapshots as a job publishes them whose state operators dropped the late events."""
        return self._table("published", lambda: lifecycle_snapshot(
            self.unique_events().where("NOT is_late"), SNAPSHOT_MS))

    def _monthly(self, name, rows) -> DataFrame:
        """A table by month, as this log spans seven years."""
        key = self._key(name)
        if key not in _written:
            path, dated = work_folder(self.spark, name), with_month(rows())
            write_snapshot_table(dated, path, ("trade_month",))
            _written[key] = path, dated.schema
        path, schema = _written[key]
        return read_snapshot_table(self.spark, path, schema)

    def snapshot_table(self) -> DataFrame:
        return self._monthly("snapshot_table", self.snapshots)

    def order_index(self) -> str:
        """Folder of the index from orders to the months of the snapshot table that hold them."""
        key = self._key("order_index")
        if key not in _written:
            path = work_folder(self.spark, "order_index")
            write_lookup_index(self.snapshot_table(), path, ["trade_month"], slots=INDEX_SLOTS)
            _written[key] = path, None
        return _written[key][0]

    def monthly_log(self) -> DataFrame:
        """The raw log with trade_date, by month."""
        return self._monthly("monthly_log", lambda: self.event_log().withColumn(
            "trade_date", trade_date()))

    def exceptions(self) -> DataFrame:
        return self._table("exceptions", lambda: all_exceptions(
            self.unique_events(), self.snapshots(), AS_OF_MS), bucketed=False)

    def internal_records(self):
        return derived.internal_records(
            self.spark, self.sf_dir, self._tasks())

    def fresh_folder(self, name) -> str:
        return work_folder(self.spark, name)
