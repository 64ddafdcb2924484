"""Snapshot tables on shared storage."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from orderloom.session import delete_folder

ORDER = "customer_order_id"
#: Bytes of a row group: what a lookup reads at least of a table's file, and of an index file.
TABLE_BLOCK = 16 << 20
INDEX_BLOCK = 1 << 20


def with_month(snapshots: DataFrame) -> DataFrame:
    """With `trade_month`, to partition logs of many years by."""
    return snapshots.withColumn("trade_month", F.substring("trade_date", 1, 7))


def write_snapshot_table(snapshots: DataFrame, path: str,
                         partition_by=("trade_date", "symbol")) -> None:
    """Write snapshots by partition; existing partitions among them are replaced.

    The rebalance hint gathers each partition value in few files and splits a value
    that holds too many rows for one task. Files are sorted by order in small row groups, so a
    filter on an order skips most of a file.
    """
    order = [ORDER] if ORDER in snapshots.columns else []
    (snapshots.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *order)
     .write.option("parquet.block.size", TABLE_BLOCK)
     .mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def _slot(key, slots):
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def write_lookup_index(snapshots: DataFrame, path: str, columns, key="customer_order_id",
                       slots=1024) -> None:
    """An index of the partitions of a snapshot table that hold a key: its rows (`key` and the
    partition `columns`, each once) lie in folders by hash of the key, sorted by key within a file.

    A key's rows are as many as the partitions that hold it. Null keys are not indexed. `slots`
    is part of the layout: `find` must be given the same number.
    """
    rows = snapshots.where(F.col(key).isNotNull()).select(key, *columns).distinct()
    (rows.withColumn("slot", _slot(F.col(key), slots)).hint("rebalance", "slot")
     .sortWithinPartitions("slot", key)
     .write.mode("overwrite").option("parquet.block.size", INDEX_BLOCK)
     .partitionBy("slot").parquet(path))


def find(snapshots: DataFrame, index_path: str, value, columns, key="customer_order_id",
         slots=1024) -> DataFrame:
    """The rows of a snapshot table with that key, from the partitions that its index names.

    The folder of one slot is read, where sorted row groups leave few rows; the table is then read
    in the named partitions only. A table whose files are sorted by the key (`write_snapshot_table`
    does that) gives up a few pages of each. The result is that of a filter on the key alone, if
    the index was written after the table's last change.
    """
    spark = snapshots.sparkSession
    schema = T.StructType([snapshots.schema[c] for c in (key, *columns)])
    slot = spark.range(1).select(_slot(F.lit(value), slots)).first()[0]
    rows = read_if_there(spark, f"{index_path.rstrip('/')}/slot={slot}", schema)
    if rows is None:
        return snapshots.where("false")
    parts = F.lit(False)
    for row in rows.where(F.col(key) == value).select(*columns).distinct().collect():
        here = F.lit(True)
        for column in columns:
            here = here & F.col(column).eqNullSafe(row[column])
        parts = parts | here
    return snapshots.where(parts & (F.col(key) == value))


def read_if_there(spark: SparkSession, path: str, schema=None):
    """The Parquet table in `path`, or None if nothing has been written there yet; any other
    failure is raised."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_snapshot_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table with its dates as text, as written; Spark would infer dates from folder names.
    With its `schema` no file is opened to find it out."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name in ("trade_date", "trade_month")
              else f for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def drop_expired(spark: SparkSession, path: str, first_kept: str, column="trade_date") -> list:
    """Deletes the partitions of a table before `first_kept`, and returns their values.

    Only folder names are read: `column` must be the first partition column. Rows of a month
    that is kept in part stay; `reports.expire` hides them.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(folder) if s.isDirectory()]
    old = sorted(n.split("=", 1)[1] for n in names
                 if n.startswith(f"{column}=") and n.split("=", 1)[1] < first_kept)
    for value in old:
        delete_folder(spark, f"{path.rstrip('/')}/{column}={value}")
    return old
