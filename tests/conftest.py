import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from orderloom.operators.events import tag_late  # noqa: E402
from orderloom.schema import EVENT_SCHEMA  # noqa: E402
from orderloom.session import build_session, clean_work, prepare  # noqa: E402

BASE_MS = 1_768_487_400_000  # 2026-01-15 14:30 UTC


def pytest_collection_modifyitems(items):
    """A child's peak memory starts at that of the process that forks it, so what measures a child
    runs while this one is small."""
    items.sort(key=lambda item: item.name != "test_memory_of_a_very_long_text")


@pytest.fixture(scope="session")
def spark():
    session = prepare(build_session("tests", master="local[8]", shuffle_partitions=4,
                                    **{"spark.driver.memory": "8g"}))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clean_work(session)
    session.stop()


def event(kind, after_ms=0, **fields):
    """An event `after_ms` after the base time, with every required field filled in."""
    ts = BASE_MS + after_ms
    row = {
        "event_id": f"{kind}-{fields.get('customer_order_id', 'O1')}-{after_ms}",
        "event_type": kind, "ts_event": ts, "ts_ingest": ts, "firm_id": "F",
        "account_id": "ACC", "customer_order_id": "O1", "firm_order_id": "F1",
        "symbol": "XYZ", "qty": 100, "side": "BUY"}
    row.update(fields)
    return row


def _tuple(row):
    return tuple(row.get(f) for f in EVENT_SCHEMA.fieldNames())


@pytest.fixture
def log(spark):
    """Builds a tagged event frame; `arrival` is the delay of each message in milliseconds."""
    def build(rows, arrival=0):
        frame = spark.createDataFrame([_tuple(r) for r in rows], EVENT_SCHEMA)
        envelope = (frame.withColumn("kafka_timestamp",
                                     F.timestamp_millis(F.col("ts_ingest") + arrival))
                    .withColumn("partition", F.lit(0))
                    .withColumn("offset", F.lit(0).cast("long")))
        return tag_late(envelope)
    return build


@pytest.fixture
def one(spark):
    return lambda df: df.collect()[0]
