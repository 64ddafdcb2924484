"""Reference data joined to a stream, as it is when a batch is processed."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.operators.reports import enrich_customer
from orderloom.session import delete_folder, work_folder
from orderloom.streaming.corrections import mark_done, steps_done
from orderloom.streaming.sinks import batch_path, start_query


def enrichment_writer(reference: Callable[[SparkSession], DataFrame], root: str, name="enriched"):
    """What `start_enrichment` does with each batch: `(rows, batch id) -> None`."""
    output, kept, ledger = (f"{root.rstrip('/')}/{name}{n}" for n in ("", "_reference", "_ledger"))

    def write_batch(batch: DataFrame, batch_id: int):
        spark, used = batch.sparkSession, batch_path(kept, batch_id)
        known, staged = reference(spark), work_folder(spark, "enrichment")
        batch.write.parquet(staged)  # it is used twice, its messages are parsed once
        rows = spark.read.schema(batch.schema).parquet(staged)
        if "kept" not in steps_done(spark, ledger, batch_id):
            known.join(rows.select("account_id"), "account_id", "left_semi").write.mode(
                "overwrite").parquet(used)
            mark_done(spark, ledger, batch_id, "kept")
        values = spark.read.schema(known.schema).parquet(used)
        enrich_customer(rows, values).write.mode("overwrite").parquet(
            batch_path(output, batch_id))
        delete_folder(spark, staged)

    return write_batch


def start_enrichment(rows: DataFrame, reference: Callable[[SparkSession], DataFrame], root: str,
                     trigger=None, name="enriched"):
    """Every row of a stream with the reference data of its account.

    A stream keeps the files that a static side had when the query was planned. So
    `reference(spark)`, a table with one row per account, is asked anew for every batch. The
    values that a batch uses are kept beside its output first: a batch that is repeated after a
    loss shows those of its first attempt. Rows of unknown or null accounts have nulls.
    """
    return start_query(
        rows.writeStream.queryName(name).foreachBatch(enrichment_writer(reference, root, name)),
        root, name, trigger=trigger)
