"""Record layouts. Names, order and types are part of the data contract (fixed values)."""

from pyspark.sql import types as T

# The twenty fields of an event message; True marks an optional field.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("ts_event", T.LongType(), False),
    T.StructField("ts_ingest", T.LongType(), False),
    T.StructField("firm_id", T.StringType(), False),
    T.StructField("account_id", T.StringType(), False),
    T.StructField("customer_order_id", T.StringType(), False),
    T.StructField("firm_order_id", T.StringType(), False),
    T.StructField("parent_firm_order_id", T.StringType(), True),
    T.StructField("route_id", T.StringType(), True),
    T.StructField("venue", T.StringType(), True),
    T.StructField("exec_id", T.StringType(), True),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("qty", T.IntegerType(), False),
    T.StructField("side", T.StringType(), False),
    T.StructField("order_type", T.StringType(), True),
    T.StructField("limit_price", T.DoubleType(), True),
    T.StructField("exec_price", T.DoubleType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("corr_id", T.StringType(), True),
])

EVENT_FIELDS = EVENT_SCHEMA.fieldNames()
REQUIRED_FIELDS = [f.name for f in EVENT_SCHEMA.fields if not f.nullable]

# Rejections carry one more field.
EVENT_SCHEMA_WITH_REJECT = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField("reject_reason", T.StringType(), True)])

# What a message broker adds around the payload.
ENVELOPE_FIELDS = ["kafka_timestamp", "partition", "offset"]

# One message as stored in a topic.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

EDGE_FIELDS = ["edge_id", "edge_type", "source_id", "target_id", "customer_order_id", "ts_event"]

EXCEPTION_FIELDS = [
    "exception_id", "exception_type", "severity", "customer_order_id", "firm_order_id",
    "event_id", "symbol", "ts_event", "description", "metadata",
]

AUDIT_FIELDS = [
    "audit_id", "action", "customer_order_id", "reason", "previous_state", "new_state",
    "triggering_event_id", "ts_audit",
]
