from pyspark.sql import functions as F

from orderloom.streaming import enrichment, sinks

ROWS = "event_id string, account_id string, customer_order_id string, ts_first_event long"


def test_a_batch_shows_what_was_valid_when_it_was_first_processed(spark, tmp_path):
    now = {"A1": "old", "A2": "other"}

    def reference(session):
        return session.createDataFrame(list(now.items()), "account_id string, segment string")

    write = enrichment.enrichment_writer(reference, str(tmp_path))
    first = spark.createDataFrame([("e1", "A1", "O1", 1), ("e2", None, "O2", 2),
                                   ("e3", "A9", "O3", 3), ("e1", "A1", "O1", 1)], ROWS)
    write(first, 0)
    now["A1"] = "new"
    write(first, 0)  # repeated after a loss
    write(spark.createDataFrame([("e4", "A1", "O4", 4)], ROWS), 1)
    write(first.where("false"), 2)
    found = sinks.read_batches(spark, f"{tmp_path}/enriched")
    assert sorted((r.event_id, r.segment) for r in found.collect()) == [
        ("e1", "old"), ("e1", "old"), ("e2", None), ("e3", None), ("e4", "new")]


def test_a_stream_reads_the_reference_anew(spark, tmp_path):
    topic, accounts, root = (f"{tmp_path}/{n}" for n in ("topic", "accounts", "out"))
    schema = "account_id string, segment string"
    for i in range(3):
        spark.createDataFrame([("A1", f"v{i}")], schema).write.mode("overwrite").parquet(accounts)
        spark.createDataFrame([(f"e{i}", "A1", "O", i)], ROWS).coalesce(1).write.mode(
            "append").parquet(topic)
        enrichment.start_enrichment(
            spark.readStream.schema(ROWS).parquet(topic),
            lambda s: s.read.schema(schema).parquet(accounts), root,
            {"availableNow": True}).awaitTermination()
    found = sinks.read_batches(spark, f"{root}/enriched").orderBy(F.col("event_id"))
    assert [(r.event_id, r.segment) for r in found.collect()] == [
        (f"e{i}", f"v{i}") for i in range(3)]


def test_messages_of_a_batch_are_parsed_once(spark, tmp_path):
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def parse(value):
        parsed.add(1)
        return value

    rows = spark.createDataFrame([(f"e{i}", "A1", "O", i) for i in range(7)], ROWS)
    enrichment.enrichment_writer(
        lambda s: s.createDataFrame([("A1", "v")], "account_id string, segment string"),
        str(tmp_path))(rows.withColumn("account_id", parse("account_id")), 0)
    assert parsed.value == 7
    assert sinks.read_batches(spark, f"{tmp_path}/enriched").where("segment = 'v'").count() == 7
