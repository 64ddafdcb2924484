"""Column expressions shared by batch and streaming operators; all run inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_DELAY = "2 minutes"


def has_value(name) -> Column:
    """An id counts as given only if it is neither NULL nor empty."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def event_time() -> Column:
    return F.timestamp_millis(F.col("ts_event"))


def late_flag(delay=DEFAULT_DELAY) -> Column:
    """True if the message arrived strictly later than event time plus `delay`."""
    return F.col("kafka_timestamp") > F.col("event_time") + F.expr(f"INTERVAL {delay}")


def content_id(*parts) -> Column:
    """32 hex digits that depend on the parts only, so a replay gives the same id."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.substring(F.sha2(text, 256), 1, 32)


def on_type(event_type, value=None) -> Column:
    """`value` (default 1) on events of one type, NULL elsewhere."""
    return F.when(F.col("event_type") == event_type, F.lit(1) if value is None else value)


def signed_qty() -> Column:
    """Quantity an event adds to the filled total: fills count, busts reverse them."""
    qty = F.col("qty").cast("long")
    return (F.when(F.col("event_type") == "FILL", qty)
            .when(F.col("event_type") == "BUST", -qty).otherwise(F.lit(0).cast("long")))


def trade_date(ts="ts_event") -> Column:
    return F.timestamp_millis(F.col(ts)).cast("date").cast("string")


def status(canceled, filled, total, routes) -> Column:
    """Order state: a cancel wins, then the filled quantity, then routing."""
    return (F.when(canceled, "CANCELED")
            .when(filled >= total, "FILLED")
            .when(filled > 0, "PARTIALLY_FILLED")
            .when(routes > 0, "ROUTED")
            .otherwise("OPEN"))


def state_json(*names) -> Column:
    return F.to_json(F.struct(*names))
