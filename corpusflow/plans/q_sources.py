"""Registered source queries (S1-S17, G5) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators.sizing import sized_broadcast
from corpusflow.plans import fixtures as fx
from corpusflow.plans.registry import register
from corpusflow.session import scratch_path
from corpusflow.sources import api, database, files
from corpusflow.sources import messages as msg
from corpusflow.sources.tables import read_table
from corpusflow.streaming.runner import read_back, run_available

SQL_OBJECTS = """obj AS (
  SELECT lang || '/doc_' || doc_id::VARCHAR || ['.txt', '.pdf', '.docx', '.md'][(doc_id % 4) + 1] AS key,
         octet_length(encode(text))::BIGINT AS size, md5(text) AS etag FROM documents)"""


@register("object_listing", f"WITH {SQL_OBJECTS} SELECT key, size, 'landing' AS bucket FROM obj WHERE key LIKE '%.txt'")
def q_object_listing(spark, sf_dir):
    """List landed objects ending in .txt (content column pruned)."""
    root = fx.land_document_objects(spark, sf_dir)
    return files.list_objects(spark, root, suffix=".txt", max_keys=None) \
                .select("key", F.col("size").cast("long").alias("size"), "bucket")


CTYPES = {".txt": "text/plain", ".pdf": "application/pdf",
          ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
          ".md": "text/markdown"}


@register("object_scan", f"""WITH {SQL_OBJECTS}
SELECT key, size, CASE {' '.join(f"WHEN key LIKE '%{e}' THEN '{t}'" for e, t in CTYPES.items())} END AS content_type,
       etag, 's3://landing/' || key AS source_uri, sha256('s3://landing/' || key) AS document_id FROM obj""")
def q_object_scan(spark, sf_dir):
    """Read every landed object as an envelope with full metadata."""
    root = fx.land_document_objects(spark, sf_dir)
    r = files.read_objects(spark, root)
    return r.select("metadata.key", F.col("metadata.size").cast("long").alias("size"), "metadata.content_type",
                    "metadata.etag", "metadata.source_uri", "document_id")


@register("folder_by_ext", f"""WITH {SQL_OBJECTS}
SELECT key, size FROM obj WHERE key LIKE '%.pdf' OR key LIKE '%.docx' OR key LIKE '%.txt'""")
def q_folder_by_ext(spark, sf_dir):
    """S3: folder ingest restricted to .pdf .docx .txt."""
    root = fx.land_document_objects(spark, sf_dir)
    r = files.ingest_folder(spark, root)
    return r.select("metadata.key", F.col("metadata.size").cast("long").alias("size"))


EMPTY_EVERY = 9


@register("objects_with_empty", f"""SELECT lang || '/doc_' || doc_id::VARCHAR || ['.txt', '.pdf', '.docx', '.md'][(doc_id % 4) + 1] AS key,
       CASE WHEN doc_id % {EMPTY_EVERY} = 0 THEN 0 ELSE octet_length(encode(text)) END::BIGINT AS size,
       md5(CASE WHEN doc_id % {EMPTY_EVERY} = 0 THEN '' ELSE text END) AS etag,
       CASE WHEN doc_id % {EMPTY_EVERY} = 0 THEN 0 ELSE octet_length(encode(text)) END::BIGINT AS listed_size FROM documents""")
def q_objects_with_empty(spark, sf_dir):
    """S1 + S2 over a landing in which every ninth object has no body: the
    objects read, each with the size that the listing gives it."""
    root = fx.land_document_objects(spark, sf_dir, EMPTY_EVERY)
    listed = files.list_objects(spark, root).select("key", F.col("size").alias("listed_size"))
    r = files.read_objects(spark, root).select("metadata.key", "metadata.size", "metadata.etag")
    return r.join(listed, "key", "full").select("key", F.col("size").cast("long").alias("size"), "etag",
                                                F.col("listed_size").cast("long").alias("listed_size"))


@register("table_scan", """SELECT c_custkey, c_name, c_acctbal, 'customer' AS table_name, 'db://customer' AS source_uri
FROM customer WHERE c_mktsegment = 'BUILDING'""")
def q_table_scan(spark, sf_dir):
    """Table scan with a column list and an equality filter."""
    t = database.ingest_table(read_table(spark, sf_dir, "customer"), "customer",
                              filters={"c_mktsegment": "BUILDING"}, columns=["c_custkey", "c_name", "c_acctbal"])
    return t.select("content.*", "metadata.table_name", "metadata.source_uri")


CUSTOM_SQL = ("SELECT o_orderkey, o_custkey, o_totalprice FROM cf_orders "
              "WHERE o_orderstatus = :status AND o_totalprice > :min_price")


@register("custom_query", f"""SELECT o_orderkey, o_custkey, o_totalprice, 'big_final_orders' AS query_name,
       'db://query/big_final_orders' AS source_uri, '{CUSTOM_SQL[:200]}' AS query
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000.0""")
def q_custom_query(spark, sf_dir):
    """Parameterised SQL over a registered table as envelopes."""
    read_table(spark, sf_dir, "orders").createOrReplaceTempView("cf_orders")
    r = database.ingest_custom_query(spark, CUSTOM_SQL, "big_final_orders",
                                     {"status": "F", "min_price": 100000.0})
    return r.select("content.*", "metadata.query_name", "metadata.source_uri", "metadata.query")


def _shipments(spark, sf_dir):
    """FIXTURES shipment_logs derivation."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    li = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("arrival_date"), F.sum("l_quantity").alias("weight_kg"))
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(sized_broadcast(n), F.col("c_nationkey") == n.n_nationkey, "left")
          .join(sized_broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
          .join(li, o.o_orderkey == li.l_orderkey, "left"))
    return j.select(
        F.col("o_orderkey").alias("shipment_id"), F.col("o_custkey").alias("vendor_id"),
        F.col("c_mktsegment").alias("origin"), F.col("n_name").alias("destination"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("departure_date"),
        "arrival_date",
        ((F.unix_micros(F.col("arrival_date").cast("timestamp")) - F.unix_micros(F.col("o_orderdate").cast("timestamp")))
         / 3.6e9).alias("delay_hours"),
        F.col("o_orderpriority").alias("cargo_type"), "weight_kg", F.col("r_name").alias("region"))


SQL_SHIPMENTS = """WITH li AS (SELECT l_orderkey, max(l_shipdate) AS arrival_date, sum(l_quantity) AS weight_kg
            FROM lineitem GROUP BY l_orderkey),
s AS (
  SELECT o.o_orderkey AS shipment_id, o.o_custkey AS vendor_id, c.c_mktsegment AS origin, n.n_name AS destination,
         o.o_orderstatus AS status, o.o_orderdate AS departure_date, li.arrival_date,
         (epoch_us(li.arrival_date) - epoch_us(o.o_orderdate)) / 3.6e9 AS delay_hours,
         o.o_orderpriority AS cargo_type, li.weight_kg, r.r_name AS region
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey)
SELECT shipment_id, vendor_id, origin, destination, status, departure_date::VARCHAR AS departure_date,
       arrival_date::VARCHAR AS arrival_date, round(delay_hours, 6) AS delay_hours, cargo_type,
       round(weight_kg, 6) AS weight_kg, region, 'db://shipment_logs/' || shipment_id::VARCHAR AS source_uri
FROM s WHERE departure_date >= TIMESTAMP '1995-01-01' AND departure_date <= TIMESTAMP '1998-12-31'
  AND region = 'ASIA'"""


@register("shipment_logs", SQL_SHIPMENTS)
def q_shipment_logs(spark, sf_dir):
    """Shipment log scan for ASIA, 1995-01-01..1998-12-31, newest first."""
    s = database.ingest_shipment_logs(_shipments(spark, sf_dir), "1995-01-01", "1998-12-31", "ASIA")
    return s.select("shipment_id", "vendor_id", "origin", "destination", "status",
                    F.col("departure_date").cast("string").alias("departure_date"),
                    F.col("arrival_date").cast("string").alias("arrival_date"),
                    F.round("delay_hours", 6).alias("delay_hours"), "cargo_type",
                    F.round("weight_kg", 6).alias("weight_kg"), "region", "source_uri")


ORDER_SCHEMA = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
SQL_SCHEMA = "\nUNION ALL\n".join(
    f"SELECT {i}::BIGINT AS position, '{c}' AS column_name, '{t}' AS data_type, TRUE AS nullable, "
    f"count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS null_count FROM orders"
    for i, (c, t) in enumerate(ORDER_SCHEMA))


@register("table_schema", SQL_SCHEMA)
def q_table_schema(spark, sf_dir):
    """Column names, types, nullability and observed null counts of the
    orders table."""
    s = database.table_schema(read_table(spark, sf_dir, "orders"))
    return s.select(F.col("position").cast("long").alias("position"), "column_name", "data_type", "nullable",
                    F.col("null_count").cast("long").alias("null_count"))


# ------------------------------------------------------------- messages
MSG_VALUE = ("CASE WHEN event_id % 97 = 0 THEN 'text' WHEN event_id % 89 = 0 THEN 'array' ELSE 'object' END")


@register("message_envelope", f"""SELECT 'iot-sensors' AS topic, (event_id % 4)::INTEGER AS partition,
       (event_id // 4)::BIGINT AS offset, user_id::VARCHAR AS key, {MSG_VALUE} AS content_kind,
       CASE WHEN {MSG_VALUE} = 'object' THEN user_id END AS sensor_id,
       'kafka://iot-sensors/' || (event_id % 4)::VARCHAR || '/' || (event_id // 4)::VARCHAR AS source_uri,
       ts::VARCHAR AS message_ts
FROM events""")
def q_message_envelope(spark, sf_dir):
    """Landed messages consumed as a stream (availableNow, checkpointed)
    and decoded JSON-or-text into envelopes."""
    path = fx.land_messages(spark, sf_dir)
    stream = msg.decode_messages(msg.read_messages(spark, path, files_per_trigger=100))
    out = run_available(stream.select(
        "metadata.topic", "metadata.partition", "metadata.offset", "key", "content_kind",
        F.try_variant_get("content", "$.sensor_id", "bigint").alias("sensor_id"),
        "metadata.source_uri", F.col("metadata.message_ts").cast("string").alias("message_ts")), "envelopes")
    return read_back(spark, out)


def _batch_stats(target):
    """Per micro-batch stats written to ``target/micro_batch=<id>`` with
    overwrite, so a replayed micro-batch replaces its own output."""
    def fn(batch, batch_id):
        (batch.groupBy("partition", F.floor(F.col("offset") / 500).cast("long").alias("batch_no"))
              .agg(F.count(F.lit(1)).alias("n_messages"), F.min("offset").alias("min_offset"),
                   F.max("offset").alias("max_offset"))
              .write.mode("overwrite").parquet(f"{target}/micro_batch={batch_id}"))
    return fn


@register("message_batches", """SELECT (event_id % 4)::INTEGER AS partition, ((event_id // 4) // 500)::BIGINT AS batch_no,
       count(*)::BIGINT AS n_messages, min(event_id // 4)::BIGINT AS min_offset, max(event_id // 4)::BIGINT AS max_offset
FROM events GROUP BY ALL""")
def q_message_batches(spark, sf_dir):
    """Consumer batches of 500 messages per partition; every landed
    batch is processed inside one micro-batch (foreachBatch, idempotent
    append keyed by micro-batch id)."""
    path = fx.land_messages(spark, sf_dir, 500)
    target = scratch_path(spark, "batches")
    run_available(msg.read_messages(spark, path, files_per_trigger=100), "batches",
                  foreach_batch=_batch_stats(target))
    return read_back(spark, target).select("partition", "batch_no", "n_messages", "min_offset", "max_offset")


IOT_TYPES = ["view", "click", "purchase"]


@register("iot_stream", f"""SELECT (event_id % 4)::INTEGER AS partition, (event_id // 4)::BIGINT AS offset,
       user_id::VARCHAR AS sensor_id, event_type AS sensor_type, 'zone-' || (user_id % 10)::VARCHAR AS location,
       value, 'iot_sensor_data' AS document_type
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_type IN ('view', 'click', 'purchase')""")
def q_iot_stream(spark, sf_dir):
    """Stateless streaming filter/projection of sensor readings;
    non-object messages are quarantined instead of failing the stream."""
    path = fx.land_messages(spark, sf_dir)
    ok, _bad = msg.iot_readings(msg.decode_messages(msg.read_messages(spark, path, files_per_trigger=100)), IOT_TYPES)
    out = run_available(ok.select("metadata.partition", "metadata.offset", "sensor_id", "sensor_type",
                                  "location", "value", "document_type"), "iot")
    return read_back(spark, out)


@register("topic_summary", """SELECT 'iot-sensors' AS topic, count(DISTINCT event_id % 4)::BIGINT AS partitions,
       count(*)::BIGINT AS messages FROM events""")
def q_topic_summary(spark, sf_dir):
    """Partitions and messages per topic over the landed messages."""
    path = fx.land_messages(spark, sf_dir)
    s = msg.topic_summary(msg.read_messages(spark, path, streaming=False))
    return s.select("topic", F.col("partitions").cast("long").alias("partitions"),
                    F.col("messages").cast("long").alias("messages"))


@register("produce_messages", """SELECT event_id::VARCHAR AS key,
       to_json({'event_id': event_id, 'event_type': event_type, 'value': value})::VARCHAR AS value,
       'events-out' AS topic FROM events""")
def q_produce_messages(spark, sf_dir):
    """Events produced to a topic (JSON file twin), read back."""
    path = scratch_path(spark, "produced")
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    msg.produce_messages(e, "events-out", path=path, key_col="event_id")
    return spark.read.schema("key string, value string, topic string").json(path)


# ----------------------------------------------------------- API landings
def _land_ports(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(sized_broadcast(n), s.s_nationkey == n.n_nationkey, "left")
    port = F.struct(F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("port_code"),
                    F.col("n_name").alias("country"), F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
                    F.col("s_acctbal").alias("congestion"), F.pmod("s_suppkey", F.lit(17)).alias("vessels_waiting"))
    # one response page per nation and block of 100 suppliers
    pages = j.groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 100).alias("blk")) \
             .agg(F.collect_list(port).alias("ports"))
    path = scratch_path(spark, "ports")
    api.land_json(pages.select(F.to_json(F.struct("ports")).alias("json")), path)
    return path


@register("port_congestion", """SELECT 'P' || s.s_suppkey::VARCHAR AS port_code, n.n_name AS country,
       '2024-01-01T00:00:00Z' AS data_timestamp, s.s_acctbal AS congestion, (s.s_suppkey % 17)::BIGINT AS vessels_waiting,
       'api://port_congestion/P' || s.s_suppkey::VARCHAR AS source_uri
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def q_port_congestion(spark, sf_dir):
    """Landed port responses exploded into one document per port."""
    r = api.port_congestion(api.read_responses(spark, _land_ports(spark, sf_dir), api.PORTS_SCHEMA))
    return r.select("metadata.port_code", "metadata.country", "metadata.data_timestamp",
                    F.try_variant_get("content", "$.congestion", "double").alias("congestion"),
                    F.try_variant_get("content", "$.vessels_waiting", "bigint").alias("vessels_waiting"), "metadata.source_uri")


def _weather(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    loc = s.select(F.pmod("s_suppkey", F.lit(90)).cast("double").alias("lat"),
                   F.pmod(F.col("s_nationkey") * 7, F.lit(180)).cast("double").alias("lon")).distinct()
    resp = loc.select(F.to_json(F.struct("lat", "lon", F.struct(
        F.lit(7).alias("days"), (F.col("lat") / 3 + 10).alias("temp_max"),
        (F.col("lon") / 9 - 5).alias("temp_min")).alias("forecast"))).alias("json"))
    path = scratch_path(spark, "weather")
    api.land_json(resp, path)
    c = read_table(spark, sf_dir, "customer")
    req = c.select(F.col("c_name").alias("name"), F.pmod("c_custkey", F.lit(90)).cast("double").alias("lat"),
                   F.pmod(F.col("c_nationkey") * 7, F.lit(180)).cast("double").alias("lon"))
    return api.weather_forecast(api.read_responses(spark, path, api.WEATHER_SCHEMA), req)


@register("weather_docs", """WITH loc AS (SELECT DISTINCT (s_suppkey % 90)::DOUBLE AS lat, ((s_nationkey * 7) % 180)::DOUBLE AS lon FROM supplier)
SELECT c.c_name AS name, l.lat, l.lon, 7::INTEGER AS days, round(l.lat / 3 + 10, 6) AS temp_max,
       'api://weather/' || c.c_name AS source_uri
FROM customer c JOIN loc l ON (c.c_custkey % 90)::DOUBLE = l.lat AND ((c.c_nationkey * 7) % 180)::DOUBLE = l.lon""")
def q_weather_docs(spark, sf_dir):
    """A forecast document for every requested customer location that
    has a landed response; the others are skipped."""
    w = _weather(spark, sf_dir)
    return w.select("name", "lat", "lon", F.try_variant_get("content", "$.days", "int").alias("days"),
                    F.round(F.try_variant_get("content", "$.temp_max", "double"), 6).alias("temp_max"),
                    "metadata.source_uri")


def _land_routes(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    o = n.select(F.col("n_nationkey").alias("ok"), F.col("n_name").alias("origin"))
    d = n.select(F.col("n_nationkey").alias("dk"), F.col("n_name").alias("destination"))
    j = (s.join(sized_broadcast(o), s.s_nationkey == o.ok, "left")
          .join(sized_broadcast(d), F.pmod(s.s_nationkey + 1, F.lit(25)) == d.dk, "left"))
    route = F.struct("origin", "destination", F.concat(F.lit("carrier-"), F.pmod("s_suppkey", F.lit(5)).cast("string"))
                     .alias("carrier"), F.col("s_acctbal").alias("rate"), F.lit("2024-01-01").alias("timestamp"))
    pages = j.groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 100).alias("blk")).agg(
        F.collect_list(route).alias("routes"))
    path = scratch_path(spark, "routes")
    api.land_json(pages.select(F.to_json(F.struct("routes")).alias("json")), path)
    return path


SQL_ROUTES = """r AS (SELECT o.n_name AS origin, d.n_name AS destination, 'carrier-' || (s.s_suppkey % 5)::VARCHAR AS carrier,
              s.s_acctbal AS rate FROM supplier s LEFT JOIN nation o ON s.s_nationkey = o.n_nationkey
              LEFT JOIN nation d ON (s.s_nationkey + 1) % 25 = d.n_nationkey),
req AS (SELECT o.n_name AS origin, d.n_name AS destination FROM nation o JOIN nation d ON (o.n_nationkey + 1) % 25 = d.n_nationkey
        WHERE o.n_nationkey % 2 = 0
        UNION ALL
        SELECT o.n_name, d.n_name FROM nation o JOIN nation d ON d.n_nationkey = 1 WHERE o.n_nationkey = 0)"""


@register("shipping_rates", f"""WITH {SQL_ROUTES}
SELECT r.origin, r.destination, r.carrier, r.rate, 'api://shipping_rates/' || r.origin || '/' || r.destination AS source_uri
FROM r JOIN req USING (origin, destination)""")
def q_shipping_rates(spark, sf_dir):
    """Rates of the requested routes (every even nation to the next one,
    plus nation 0 -> 1 requested twice: its rows appear twice)."""
    n = read_table(spark, sf_dir, "nation")
    o, d = n.alias("o"), n.alias("d")
    req = (o.join(d, F.pmod(F.col("o.n_nationkey") + 1, F.lit(25)) == F.col("d.n_nationkey"))
            .where(F.pmod(F.col("o.n_nationkey"), F.lit(2)) == 0)
            .select(F.col("o.n_name").alias("origin"), F.col("d.n_name").alias("destination")))
    dup = (o.join(d, F.col("d.n_nationkey") == 1).where(F.col("o.n_nationkey") == 0)
            .select(F.col("o.n_name").alias("origin"), F.col("d.n_name").alias("destination")))
    r = api.shipping_rates(api.read_responses(spark, _land_routes(spark, sf_dir), api.ROUTES_SCHEMA),
                           req.unionByName(dup))
    return r.select("origin", "destination", "metadata.carrier",
                    F.try_variant_get("content", "$.rate", "double").alias("rate"), "metadata.source_uri")


def _land_custom(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem")
    items = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part")))).alias("items"))
    j = o.join(items, o.o_orderkey == items.l_orderkey, "left")
    m = F.pmod("o_orderkey", F.lit(3))
    body = (F.when(m == 0, F.to_json(F.struct(F.struct(F.col("items").alias("results")).alias("data"))))
             .when(m == 1, F.to_json(F.struct(F.struct(F.struct(F.lit(0).alias("line"),
                                                                 F.col("o_custkey").alias("part"))
                                                        .alias("results")).alias("data"))))
             .otherwise(F.to_json(F.struct(F.struct(F.lit(1).alias("n")).alias("meta")))))
    path = scratch_path(spark, "custom")
    j.select(F.col("o_orderkey").alias("response_id"), body.alias("value")).write.parquet(path)
    return path


@register("custom_api", """WITH it AS (
  SELECT l_orderkey AS response_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS item_index,
         l_partkey::VARCHAR AS document_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 0, o_custkey::VARCHAR FROM orders WHERE o_orderkey % 3 = 1
  UNION ALL SELECT o_orderkey, 0, NULL FROM orders WHERE o_orderkey % 3 = 2
  UNION ALL SELECT o_orderkey, 0, NULL FROM orders WHERE o_orderkey % 3 = 0
            AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))
SELECT response_id, item_index::BIGINT AS item_index, document_id,
       'api://orders_api/' || coalesce(document_id, 'unknown') AS source_uri FROM it""")
def q_custom_api(spark, sf_dir):
    """Generic JSON responses: list, single object and missing data path."""
    resp = spark.read.parquet(_land_custom(spark, sf_dir))
    r = api.custom_api(resp, "orders_api", "order_items", data_path="data.results", id_field="part")
    return r.select("response_id", F.col("item_index").cast("long").alias("item_index"), "document_id",
                    "metadata.source_uri")


@register("polled_api", """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1),
k AS (SELECT *, day - (SELECT min(day) FROM d) AS di FROM d)
SELECT 'events_api' AS endpoint, row_number() OVER (ORDER BY day)::BIGINT AS poll_number, day::VARCHAR AS poll_time,
       '{"day":"' || day::VARCHAR || '","events":' || n::VARCHAR || ',"last_event":' || last_id::VARCHAR || '}' AS payload
FROM k WHERE di % 5 <> 0""")
def q_polled_api(spark, sf_dir):
    """Daily poll responses of an endpoint consumed as a stream; valid
    responses are numbered by a stateful operator, failed ones (every 5th
    day) are quarantined and do not advance the count."""
    e = read_table(spark, sf_dir, "events")
    d = e.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))
    # day offset from the first day (scalar subquery; no global window)
    d = d.withColumn("di", F.datediff("day", d.select(F.min("day")).scalar()))
    body = F.when(F.pmod("di", F.lit(5)) == 0, F.lit("ERROR 503 upstream unavailable")).otherwise(
        F.to_json(F.struct(F.col("day").cast("string").alias("day"), F.col("n").alias("events"),
                           F.col("last_id").alias("last_event"))))
    path = scratch_path(spark, "polls")
    d.select(F.lit("events_api").alias("endpoint"), F.col("day").cast("string").alias("poll_time"),
             body.alias("value")).coalesce(1).write.json(path)
    polls = spark.readStream.schema("endpoint string, poll_time string, value string").json(path)
    numbered, _bad = api.poll_endpoint(polls)
    out = run_available(numbered, "polls")
    return read_back(spark, out)


# ------------------------------------------- ingest of records and API data
def _run_rows(run):
    """Chunks and quarantined records of a run, each with the run's counters."""
    rows = run.chunks.select("document_id", F.col("chunk_index").cast("long").alias("chunk_index"),
                             F.col("total_chunks").cast("long").alias("total_chunks"), "content",
                             F.lit(None).cast("string").alias("error")) \
        .unionByName(run.quarantine, allowMissingColumns=True)
    return rows.withColumns({f"run_{k}": F.lit(v).cast("long") for k, v in run.stats.items()})


INGEST_SQL = ("SELECT nullif(o_orderkey, 50 * (o_orderkey div 50)) AS o_orderkey, o_custkey, o_orderstatus, o_orderpriority "
              "FROM cf_orders")


def _sql_ingest_records() -> str:
    from corpusflow.operators.chunking import DEFAULT_SEPARATORS
    from corpusflow.plans.q_chunking import _sql_recursive
    text = " || chr(10) || ".join(f"'{c}: ' || coalesce({c}::VARCHAR, 'None')"
                                  for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
    return f"""WITH rec AS (SELECT 'db://query/all_orders/' || o_orderkey::VARCHAR AS document_id, {text} AS text
  FROM (SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders)),
good AS (SELECT * FROM rec WHERE document_id IS NOT NULL),
{_sql_recursive("", "good", "document_id", 50, 20, DEFAULT_SEPARATORS)},
u AS (SELECT document_id, i::BIGINT AS chunk_index, total::BIGINT AS total_chunks, content, NULL AS error FROM chunks
      UNION ALL SELECT NULL, NULL, NULL, text, 'no document id' FROM rec WHERE document_id IS NULL)
SELECT *, (SELECT count(*) FROM rec)::BIGINT AS run_total, (SELECT count(*) FROM good)::BIGINT AS run_successful,
       (SELECT count(*) FROM rec WHERE document_id IS NULL)::BIGINT AS run_failed, (SELECT count(*) FROM chunks)::BIGINT AS run_total_chunks
FROM u"""


@register("ingest_records", _sql_ingest_records())
def q_ingest_records(spark, sf_dir):
    """Database ingest run: a query's records as text, recursive chunks
    (50/20) in the document log, counters observed in the one pass over the
    source; records without an id are quarantined."""
    from corpusflow.operators.document_log import DocumentLog
    from corpusflow.operators.record_ingest import ingest_records
    read_table(spark, sf_dir, "orders").createOrReplaceTempView("cf_orders")
    records = database.ingest_custom_query(spark, INGEST_SQL, "all_orders")
    log = DocumentLog(spark, scratch_path(spark, "record-log"))
    return _run_rows(ingest_records(records, "o_orderkey", log, chunk_size=50, chunk_overlap=20, mask=False))


@register("ingest_api", """WITH p AS (SELECT 'api://port_congestion/P' || s.s_suppkey::VARCHAR AS document_id,
       'congestion: ' || regexp_replace(s.s_acctbal::VARCHAR, '\\.0$', '') || coalesce(chr(10) || 'country: ' || n.n_name, '') || chr(10)
       || 'port_code: P' || s.s_suppkey::VARCHAR || chr(10) || 'timestamp: 2024-01-01T00:00:00Z' || chr(10)
       || 'vessels_waiting: ' || (s.s_suppkey % 17)::VARCHAR AS content
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey)
SELECT document_id, 0::BIGINT AS chunk_index, 1::BIGINT AS total_chunks, content, NULL AS error,
       (SELECT count(*) FROM p)::BIGINT AS run_total, (SELECT count(*) FROM p)::BIGINT AS run_successful, 0::BIGINT AS run_failed,
       (SELECT count(*) FROM p)::BIGINT AS run_total_chunks FROM p""")
def q_ingest_api(spark, sf_dir):
    """API ingest run: landed port responses, one document a port, stored in
    the document log, counters observed in the one pass."""
    from corpusflow.operators.document_log import DocumentLog
    from corpusflow.operators.record_ingest import ingest_api
    docs = api.port_congestion(api.read_responses(spark, _land_ports(spark, sf_dir), api.PORTS_SCHEMA))
    return _run_rows(ingest_api(docs, store=DocumentLog(spark, scratch_path(spark, "api-log")), mask=False))
