"""Message topics.

Messages have the broker's six columns ``key, value, topic, partition,
offset, timestamp``. The same transforms run on a batch DataFrame, on a
Structured Streaming DataFrame from the Kafka source, or on the file-stream
twin (JSON lines landed in a folder), which is what tests exercise offline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Message timestamps keep microseconds in landed JSON.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
MESSAGE_SCHEMA = ("key string, value string, topic string, partition int, offset long, "
                  "timestamp timestamp")


def read_messages(spark: SparkSession, path: str | None = None, kafka_options: dict | None = None,
                  files_per_trigger: int | None = None, streaming: bool = True) -> DataFrame:
    """S9/S10 source. ``kafka_options`` (``kafka.bootstrap.servers``,
    ``subscribe``, ``maxOffsetsPerTrigger``, ...) selects the Kafka source;
    otherwise JSON message files under ``path`` are read, ``files_per_trigger``
    files per micro-batch."""
    if kafka_options:
        r = spark.readStream if streaming else spark.read
        raw = r.format("kafka").options(**kafka_options).load()
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                          "partition", "offset", "timestamp")
    if streaming:
        r = spark.readStream.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true") \
                 .option("timestampFormat", TS_FORMAT)
        if files_per_trigger:
            r = r.option("maxFilesPerTrigger", files_per_trigger)
        return r.json(path)
    return spark.read.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true") \
                .option("timestampFormat", TS_FORMAT).json(path)


def consume_messages(spark: SparkSession, path: str | None = None, kafka_options: dict | None = None,
                     max_messages: int | None = None) -> DataFrame:
    """S9 bounded read: decoded envelopes of everything available, or of the
    first ``max_messages`` in (partition, offset) order if the caller names a cap."""
    m = read_messages(spark, path, kafka_options, streaming=False)
    if max_messages is not None:
        m = m.orderBy("partition", "offset").limit(max_messages)
    return decode_messages(m)


def message_uri(topic: Column, partition: Column, offset: Column) -> Column:
    return F.concat(F.lit("kafka://"), topic, F.lit("/"), partition.cast("string"), F.lit("/"),
                    offset.cast("string"))


def json_kind(v: Column) -> Column:
    """object / array / scalar for a variant; text when it did not parse.
    (Cast probes: about twice as fast as building ``schema_of_variant``.)"""
    return (F.when(v.isNull(), F.lit("text"))
             .when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), F.lit("object"))
             .when(F.try_variant_get(v, "$", "array<variant>").isNotNull(), F.lit("array"))
             .otherwise(F.lit("scalar")))


def decode_messages(msgs: DataFrame) -> DataFrame:
    """JSON-or-text decoding into an envelope. ``content`` is a VARIANT
    (null when the value is not JSON; ``raw_value`` keeps the text)."""
    v = F.try_parse_json("value")
    return msgs.select(
        F.col("key"), F.col("value").alias("raw_value"), v.alias("content"),
        json_kind(v).alias("content_kind"),
        F.struct(F.lit("kafka").alias("source_type"), F.col("topic"), F.col("partition"), F.col("offset"),
                 F.col("timestamp").alias("message_ts"), F.col("key"),
                 message_uri(F.col("topic"), F.col("partition"), F.col("offset")).alias("source_uri"),
                 F.current_timestamp().alias("ingestion_ts")).alias("metadata"))


def iot_readings(decoded: DataFrame, sensor_types: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Keep object messages of the listed sensor types and project
    ``sensor_id, sensor_type, location, value`` and all fields as ``payload``
    (names to texts, nested values as JSON); tag
    ``document_type='iot_sensor_data'``. Non-object messages go to the second
    (quarantine) DataFrame instead of failing the stream."""
    ok = decoded.where(F.col("content_kind") == "object")
    bad = decoded.where(F.col("content_kind") != "object") \
                 .withColumn("error", F.concat(F.lit("not a JSON object: "), F.col("content_kind")))
    st = F.try_variant_get("content", "$.sensor_type", "string")
    if sensor_types:
        ok = ok.where(st.isin(*sensor_types))
    ok = ok.select(
        "metadata",
        F.try_variant_get("content", "$.sensor_id", "string").alias("sensor_id"), st.alias("sensor_type"),
        F.try_variant_get("content", "$.location", "string").alias("location"),
        F.try_variant_get("content", "$.value", "double").alias("value"),
        F.lit("iot_sensor_data").alias("document_type"),
        F.try_variant_get("content", "$", "map<string,string>").alias("payload"))
    return ok, bad


def topic_summary(msgs: DataFrame) -> DataFrame:
    """Partitions and messages per topic."""
    return msgs.groupBy("topic").agg(F.count_distinct("partition").alias("partitions"),
                                     F.count(F.lit(1)).alias("messages"))


def to_messages(df: DataFrame, topic: str, key_col: str | None = None,
                value_cols: list[str] | None = None) -> DataFrame:
    """Rows -> ``key, value, topic`` for the Kafka sink; the value is the
    whole row (or ``value_cols``) as a JSON object."""
    cols = value_cols or df.columns
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(F.struct(*cols)).alias("value"), F.lit(topic).alias("topic"))


def produce_messages(df: DataFrame, topic: str, kafka_options: dict | None = None,
                     path: str | None = None, key_col: str | None = None) -> None:
    """Write rows to a topic (Kafka options) or to the JSON file twin."""
    out = to_messages(df, topic, key_col)
    if kafka_options:
        out.write.format("kafka").options(**kafka_options).save()
    else:
        out.write.mode("append").json(path)
