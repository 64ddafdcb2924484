"""From raw messages to unique, tagged events. Works on batch and streaming frames."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.columns import DEFAULT_DELAY, event_time, late_flag
from orderloom.schema import ENVELOPE_FIELDS, EVENT_SCHEMA, REQUIRED_FIELDS


def decode_events(messages: DataFrame, schema=EVENT_SCHEMA) -> DataFrame:
    """JSON payload to typed columns plus the envelope and the event time.

    The fields come out of one generated row per message, so that later projections and filters
    read them instead of each getting a copy of the parser.
    """
    return (
        messages.select(
            F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))),
            F.col("timestamp").alias("kafka_timestamp"), "partition", "offset")
        .withColumn("event_time", event_time()))


def quarantine(messages: DataFrame, schema=EVENT_SCHEMA) -> DataFrame:
    """Messages that do not decode to an event, with the required fields they lack.

    A payload that is no event decodes to a row of NULLs, which the day window would
    drop without a trace.
    """
    missing = F.concat_ws(",", *[
        F.when(F.col(f"data.{name}").isNull(), name) for name in REQUIRED_FIELDS])
    # one generated row per message keeps the parser from being copied into every check
    parsed = F.explode(F.array(F.from_json(F.col("value").cast("string"), schema)))
    return (
        messages.withColumn("data", parsed)
        .withColumn("missing_fields", missing)
        .where(F.col("missing_fields") != "")
        .drop("data"))


def decodable(events: DataFrame) -> DataFrame:
    """Decoded events with all required fields; `quarantine` holds the other messages."""
    complete = F.lit(True)
    for name in REQUIRED_FIELDS:
        complete = complete & F.col(name).isNotNull()
    return events.where(complete)


def tag_late(events: DataFrame, delay=DEFAULT_DELAY) -> DataFrame:
    """Mark events that reached the log more than `delay` after they happened."""
    if "event_time" not in events.columns:
        events = events.withColumn("event_time", event_time())
    return events.withColumn("is_late", late_flag(delay))


def with_lateness(events: DataFrame, delay=DEFAULT_DELAY) -> DataFrame:
    """Event-time watermark plus late tag. In batch the watermark has no effect."""
    return tag_late(events.withWatermark("event_time", delay), delay)


#: Values that the hashes of events are counted by, and bits of the map of those that repeat.
HASHES = 1 << 40
MAP_BITS = 1 << 27
MAY_REPEAT = "may_repeat"


def dedup_events(events: DataFrame, stored=False) -> DataFrame:
    """One row per (event_id, event_time): the earliest arrival.

    The `= 1` filter lets Spark keep one row per key before the shuffle, so an event
    resent any number of times does not pile up in one task. The hash leads the key, as sorts
    compare eight bytes first and ids share their beginning.

    Of a `stored` log, which is cheap to read again, only events whose hash repeats are shuffled;
    all others stay in place.
    """
    if stored:
        marked = mark_repeats(events, repeated_bits(events))
        again = dedup_events(marked.where(MAY_REPEAT).drop(MAY_REPEAT))
        return marked.where(f"NOT {MAY_REPEAT}").drop(MAY_REPEAT).unionByName(again)
    first = Window.partitionBy(F.xxhash64("event_id"), "event_id", "event_time").orderBy(
        "ts_ingest", "partition", "offset")
    return (events.withColumn("_n", F.row_number().over(first))
            .where(F.col("_n") == 1).drop("_n"))


def _number():
    return F.pmod(F.xxhash64("event_id", "event_time"), F.lit(HASHES))


def repeated_bits(events: DataFrame) -> DataFrame:
    """(_bucket, _bits): the hashes of id and time that occur more than once, as a map of bits of
    fixed size (16 MB at most), which every task gets."""
    bit = F.pmod("_hash", F.lit(MAP_BITS)) + 1
    found = (events.select(_number().alias("_hash")).groupBy("_hash").agg(F.count("*").alias("n"))
             .where("n > 1").select(bit.alias("_bit")))
    return found.groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))


def mark_repeats(events: DataFrame, bits: DataFrame) -> DataFrame:
    """`may_repeat`: whether other events may have the same id and time; true for all that do.

    `bits` are the `repeated_bits` of all events. Where two hashes share a bit an event is looked at
    for nothing.
    """
    at = (events.withColumn("_bit", F.pmod(_number(), F.lit(MAP_BITS)) + 1)
          .withColumn("_bucket", F.bitmap_bucket_number("_bit"))
          .withColumn("_at", F.bitmap_bit_position("_bit")))
    is_set = F.expr("getbit(cast(conv(hex(substring(_bits, cast(_at div 8 as int) + 1, 1)), 16, 10)"
                    " as int), cast(_at % 8 as int)) = 1")
    return at.join(F.broadcast(bits), "_bucket", "left").select(
        *events.columns, F.coalesce(is_set, F.lit(False)).alias(MAY_REPEAT))


def dedup_stream(events: DataFrame, mode="event_time") -> DataFrame:
    """Streaming deduplication with bounded state; the first row to arrive stays.

    `event_time` keeps one row per (event_id, event_time); `event_id` keeps one per id
    within the watermark delay, also if the copies disagree on the event time.
    """
    if mode == "event_id":
        return events.dropDuplicatesWithinWatermark(["event_id"])
    return events.dropDuplicates(["event_id", "event_time"])


def late_events(tagged: DataFrame) -> DataFrame:
    """Late rows without the envelope, taken before any stateful operator drops them."""
    return tagged.where("is_late").drop(*ENVELOPE_FIELDS, "event_time")


def encode_json(df: DataFrame, key=None) -> DataFrame:
    """Rows as JSON messages, with an optional key column. NULL fields are left out."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).alias("key"), value)
