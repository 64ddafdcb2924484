"""Session settings and the shared work folder."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# The JVM never compiles methods above 8000 bytes of bytecode: better no whole-stage method
# than an interpreted one. Halves the time of wide projections.
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
# Hash instead of sort for a join whose build side was measured to be this small per task.
HASH_JOIN_LIMIT = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"

# Combine the sessions of a key within each input partition before the shuffle.
MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"

# What a session needs so that state lives in files and not in the executors' heaps.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # saves one lookup per state update; the row count of the state is then not reported
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # ids repeat much of one another: changes and snapshots of the state take fewer bytes
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # one bound for all stores of an executor, however many partitions the state has
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}

# What the tables in the work folder are written with.
COMPACT = {"spark.sql.parquet.compression.codec": "zstd",
           "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
#: Delta encodings, for tables whose neighbouring rows have similar ids and times.
DELTA = {"parquet.writer.version": "PARQUET_2_0"}
#: For JSON messages, no two of which are alike: a dictionary is time lost, and a higher level of the
#: codec makes them hardly smaller.
MESSAGES = {"parquet.enable.dictionary#value": "false", "parquet.compression.codec.zstd.level": "1"}
# Tables in buckets of an order id: whatever goes by order reads them bucket by bucket and moves no
# row, also where the key is the order id and more.
BUCKETS = {"spark.sql.sources.bucketing.enabled": "true",
           "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
           "spark.sql.requireAllClusterKeysForCoPartition": "false"}
#: Files of different partitions and buckets that a task writes side by side.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
#: Bytes of Parquet input per task of a shuffle. A row of the tables becomes several wide events.
TASK_BYTES = 2 << 20
#: A stream's state has one store per partition and operator, each with files of its own in every
#: micro-batch, so their number is bounded, and small inputs have fewer.
STATE_PARTITIONS = 400
STATE_BYTES = 5 << 20
#: Upper bounds on what one task reads of files and of coalesced shuffles, as both are compressed
#: several times and are sorted in memory.
TASK_READS = {"spark.sql.files.maxPartitionBytes": 16 << 20,
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}

_own_root = {}


def session_conf(shuffle_partitions=None, checkpoint_dir=None, **extra):
    """Settings for a new session, as a dict for `SparkSession.Builder.config`.

    Batch work leaves the partition count to adaptive execution; a streaming job
    fixes it at its first start, so there it is a parameter.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        HUGE_METHOD: "8000",
        HASH_JOIN_LIMIT: "64m",
        MERGE_SESSIONS: "true",
        **STATE,
        **BUCKETS,
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    conf.update(extra)
    return conf


def build_session(name="orderloom", master=None, **options) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in session_conf(**options).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """A session of the same application with the settings the operators need.

    The caller's session stays as it is; the new one starts with its settings. Trading days are
    UTC days: the day window is aligned to UTC, so dates must be too.
    """
    session = spark.newSession()
    known = session.conf.getAll
    for key, value in spark.conf.getAll.items():
        if known.get(key) != value and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key in ("spark.sql.session.timeZone", HUGE_METHOD, HASH_JOIN_LIMIT, MERGE_SESSIONS, *BUCKETS):
        session.conf.set(key, session_conf()[key])
    return session


def size_for(session: SparkSession, input_bytes: int) -> SparkSession:
    """Settings of a session of our own for an input of so many bytes, so that what one task sorts
    or keeps stays as small as it is on a small input, and does not spill.

    Adaptive execution still joins partitions that turn out small; streams, which it does not plan,
    take the number of their stores. The caller's numbers are only ever raised, its sizes lowered;
    Spark's default is no number of the caller.
    """
    conf, tasks = session.conf, tasks_for(session, input_bytes)
    given = int(conf.get(SHUFFLE_PARTITIONS))
    stores = min(tasks_for(session, input_bytes, STATE_BYTES), STATE_PARTITIONS)
    conf.set(FIRST_PARTITIONS, str(max(tasks, given)))
    conf.set(SHUFFLE_PARTITIONS, str(
        max(given, stores) if SHUFFLE_PARTITIONS in conf.getAll else stores))
    for key, limit in TASK_READS.items():
        conf.set(key, str(min(limit, _bytes(session, conf.get(key)))))
    for key, value in (COMPACT | STATE).items():
        conf.set(key, value)
    return session


def tasks_for(spark: SparkSession, input_bytes: int, each=TASK_BYTES) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-input_bytes // each))


def buckets_of(spark: SparkSession) -> int:
    """Buckets of the tables that a query writes on its way."""
    stores = int(spark.conf.get(SHUFFLE_PARTITIONS))
    tasks = spark.conf.get(FIRST_PARTITIONS, None)
    return max(stores, min(int(tasks), STATE_PARTITIONS)) if tasks else stores


def _bytes(spark: SparkSession, text: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def _work_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.conf.get("spark.app.id")
        if app not in _own_root:  # one machine is all there is
            _own_root[app] = tempfile.mkdtemp(prefix="orderloom-")
        root = _own_root[app]
    return f"{root.rstrip('/')}/orderloom/{spark.conf.get('spark.app.id')}"


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share (`spark.checkpoint.dir`)."""
    return f"{_work_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean_work(spark: SparkSession) -> None:
    """Deletes what this application left in the work folder: rounds, tables, stream output.
    Frames that still read from it are lost, so this is the last thing a job does."""
    delete_folder(spark, _work_root(spark))


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_buckets(df: DataFrame, path: str, buckets: int, by: str, partition_by=(),
                  **options) -> str:
    """Writes `df` to a folder in buckets by hash of a column, and returns the table's name.

    Rows that are dealt by that column over so many tasks give one file a bucket (and partition),
    and keep their order: both files of a task are open at once, which needs no sort. The table is
    known to the application only; its folder stays if it is dropped.
    """
    table = "t_" + re.sub(r"\W", "_", path.rstrip("/").rsplit("/", 1)[1])
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(OPEN_FILES)
    conf.set(OPEN_FILES, "2")
    try:
        (df.write.format("parquet").options(**options).option("path", path)
         .partitionBy(*partition_by).bucketBy(buckets, by).saveAsTable(table))
    finally:
        conf.set(OPEN_FILES, before)
    return table


def cut_lineage(df: DataFrame, name: str, buckets=None, by=None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Unlike `checkpoint()` this computes the input once, keeps it columnar, and gives
    the next plan real sizes to choose its joins from. With a number of `buckets` the rows, dealt
    `by` a column, stay so for the plans that read them.
    """
    path = work_folder(df.sparkSession, name)
    if buckets:
        return df.sparkSession.table(write_buckets(df, path, buckets, by))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
