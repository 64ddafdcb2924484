"""What the operators share: held-out rows, and Arrow batches of bounded text."""

import os
import pathlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of text that one call of a text function gets; a longer text is a call of its own.
PART_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str, modulus: int) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text is divisible by `modulus`.
    A row without id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == 0, F.lit(True))


def smallest_hashes(df: DataFrame, count: int, name="hash") -> DataFrame:
    """The rows of `df` whose hash in column `name` (a long) is among about the 2 `count` smallest
    different ones: what a sample of `count` is taken from, without sending more from each task."""
    share = df.select((2.0 * count / F.greatest(F.approx_count_distinct(name), F.lit(1)))
                      .alias("share")).first()[0]
    return df.where(F.col(name) / 2.0**64 + 0.5 <= share)


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, if it is there too."""
    root = str(pathlib.Path(__file__).parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def parts(batch: pa.RecordBatch, column: str, limit: int = PART_BYTES):
    """Consecutive slices of `batch` with about `limit` bytes of `column`."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(df: DataFrame, function, added: str, keep=("doc_id",), text="text") -> DataFrame:
    """One row per row of `df`: the columns `keep`, and the columns `added` (DDL), which
    `function` returns as a list of arrays for a list of texts (None for null)."""
    more = StructType.fromDDL(added)
    fields, kept = list(to_arrow_schema(more)), list(keep)

    def run(batches):
        for batch in batches:
            for part in parts(batch, text):
                made = function(part.column(text).to_pylist())
                columns = [part.column(c) for c in kept] + [
                    pa.array(values, type=field.type)
                    for values, field in zip(made, fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(
                    [part.schema.field(c) for c in kept] + fields))

    schema = StructType([df.schema[c] for c in keep] + more.fields)
    reachable(df.sparkSession)
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def filter_texts(df: DataFrame, function, text="text") -> DataFrame:
    """The rows of `df`, all columns as they are, for which `function` returns true."""

    def run(batches):
        for batch in batches:
            for part in parts(batch, text):
                mask = function(part.column(text).to_pylist())
                yield part.filter(pa.array(mask, type=pa.bool_()))

    reachable(df.sparkSession)
    return df.mapInArrow(run, df.schema)
