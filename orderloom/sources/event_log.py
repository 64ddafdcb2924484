"""Readers of event messages and the options they share with the writers."""

from pyspark.sql import DataFrame, SparkSession

from orderloom.operators.events import decode_events
from orderloom.schema import EVENT_SCHEMA, MESSAGE_SCHEMA

# What the broker client needs for IAM sign-in.
IAM_OPTIONS = {
    "kafka.security.protocol": "SASL_SSL",
    "kafka.sasl.mechanism": "AWS_MSK_IAM",
    "kafka.sasl.jaas.config": "software.amazon.msk.auth.iam.IAMLoginModule required;",
    "kafka.sasl.client.callback.handler.class":
        "software.amazon.msk.auth.iam.IAMClientCallbackHandler",
}


def source_options(bootstrap_servers="localhost:9092", iam=False, **extra) -> dict:
    """Connection options for a broker, the same for reading and writing."""
    options = {"kafka.bootstrap.servers": bootstrap_servers, **extra}
    return {**options, **IAM_OPTIONS} if iam else options


def subscription(topic, starting_offsets="latest", fail_on_data_loss=False) -> dict:
    return {"subscribe": topic, "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower()}


def read_messages(spark: SparkSession, path: str, fmt="parquet") -> DataFrame:
    """A stored topic as a batch."""
    return spark.read.schema(MESSAGE_SCHEMA).format(fmt).load(path)


# How much one micro-batch takes unless the caller says otherwise, so that a backlog is worked off
# in many batches.
BATCH_LIMITS = {"kafka": {"maxOffsetsPerTrigger": 5_000_000}}
FILE_LIMITS = {"maxFilesPerTrigger": 1_000}


def read_message_stream(spark: SparkSession, fmt="kafka", path=None, **options) -> DataFrame:
    """Messages of a topic, from a broker (`subscription`) or from files of messages."""
    reader = spark.readStream.format(fmt).options(
        **{**BATCH_LIMITS.get(fmt, FILE_LIMITS), **options})
    if fmt != "kafka":
        reader = reader.schema(MESSAGE_SCHEMA)
    return reader.load(path) if path else reader.load()


def read_event_stream(spark: SparkSession, fmt="kafka", path=None, schema=EVENT_SCHEMA,
                      **options) -> DataFrame:
    """Decoded events of a topic; see `read_message_stream`."""
    return decode_events(read_message_stream(spark, fmt, path, **options), schema)
