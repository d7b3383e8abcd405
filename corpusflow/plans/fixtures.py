"""Inputs derived from the given tables, identically expressible in SQL.

Each function reads the whole table(s) and derives rows with column
expressions only, so the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.sizing import sized_broadcast
from corpusflow.session import scratch_path
from corpusflow.sources.tables import file_stamp, read_table

# Metadata vocabularies used to derive the corpus metadata.
CLEARANCES = ["public", "internal", "confidential", "restricted"]
SOURCE_TYPES = ["s3", "database", "api"]
# Roles cycled over queries: the four known roles and one unknown role.
QUERY_ROLES = ["admin", "supply_chain_manager", "warehouse_operator", "viewer", "guest"]
BASE_DATE = "2024-01-01"


def _pick(values: list[str], idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def corpus_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents + derived metadata: security_clearance (doc_id % 4), region
    (region name of doc_id % 5), source_type (doc_id % 3), document_type
    (= source), doc_date (2024-01-01 + doc_id % 90 days)."""
    docs = read_table(spark, sf_dir, "documents")
    region = read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("_rk"), F.col("r_name").alias("region"))
    d = docs.select(
        "doc_id", "text", "lang", "source", "n_chars",
        _pick(CLEARANCES, F.pmod("doc_id", F.lit(4))).alias("security_clearance"),
        _pick(SOURCE_TYPES, F.pmod("doc_id", F.lit(3))).alias("source_type"),
        F.col("source").alias("document_type"),
        F.date_add(F.lit(BASE_DATE).cast("date"), F.pmod("doc_id", F.lit(90)).cast("int")).alias("doc_date"),
        F.pmod("doc_id", F.lit(5)).alias("_rk"),
    )
    return d.join(sized_broadcast(region), "_rk", "left").drop("_rk")


# (application id, path, size, mtime) -> path of the built index
_INDEXES: dict[tuple, str] = {}


def term_index(spark: SparkSession, sf_dir: str):
    """The keyword index of ``corpus_docs``, built once per session and table, then loaded."""
    from corpusflow.operators.term_index import build_term_index, load_term_index
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    key = (spark.sparkContext.applicationId, path, *file_stamp(spark, path))
    if key not in _INDEXES:
        out = scratch_path(spark, "term-index")
        build_term_index(corpus_docs(spark, sf_dir), out)
        _INDEXES[key] = out
    return load_term_index(spark, _INDEXES[key])


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, embedding)`` for documents that have an embedding
    (documents.doc_id = embeddings.vec_id)."""
    emb = read_table(spark, sf_dir, "embeddings")
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return emb.select(F.col("vec_id").alias("doc_id"), "embedding").join(docs, "doc_id", "left_semi")


def all_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")


def text_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item is a query: ``query_id = item_id``."""
    b = read_table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def hybrid_queries(spark: SparkSession, sf_dir: str, with_roles: bool = True) -> DataFrame:
    """benchmark items with the vector of ``vec_id = item_id`` and a role
    cycled over QUERY_ROLES by item_id % 5."""
    q = text_queries(spark, sf_dir)
    emb = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec"))
    q = q.join(emb, "query_id", "left")
    if with_roles:
        q = q.withColumn("user_role", _pick(QUERY_ROLES, F.pmod("query_id", F.lit(5))))
    return q


def filtered_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hybrid_queries plus metadata filters derived from item_id:
    source_types = [s3, api] for even ids, none for odd; regions = the region
    of item_id % 5 and of (item_id + 1) % 5; a 45-day date window starting at
    2024-01-01 + item_id % 45 days."""
    q = hybrid_queries(spark, sf_dir)
    region = read_table(spark, sf_dir, "region")
    r = region.select(F.col("r_regionkey").cast("long").alias("_rk"), "r_name")
    regs = (q.select("query_id").withColumn("_rk", F.explode(F.array(
                F.pmod("query_id", F.lit(5)), F.pmod(F.col("query_id") + 1, F.lit(5)))))
            .join(sized_broadcast(r), "_rk")
            .groupBy("query_id").agg(F.array_sort(F.collect_set("r_name")).alias("regions")))
    start = F.date_add(F.lit(BASE_DATE).cast("date"), F.pmod("query_id", F.lit(45)).cast("int"))
    return (q.join(regs, "query_id", "left")
             .withColumn("source_types", F.when(F.pmod("query_id", F.lit(2)) == 0,
                                                F.array(F.lit("s3"), F.lit("api"))))
             .withColumn("date_start", start)
             .withColumn("date_end", F.date_add(start, 44)))


def pii_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with injected PII appended, built from doc_id:
    `` call 555-<ddd>-<dddd> ssn <ddd>-<dd>-<dddd> iban DE<20 digits>`` where
    ddd = doc_id % 1000, dddd = doc_id % 10000, dd = doc_id % 100 (zero padded)
    and the IBAN digits are doc_id % 100 then doc_id padded to 18."""
    d = read_table(spark, sf_dir, "documents")

    def pad(x, n):
        return F.lpad(x.cast("string"), n, "0")

    i = F.col("doc_id")
    tail = F.concat(
        F.lit(" call 555-"), pad(F.pmod(i, F.lit(1000)), 3), F.lit("-"), pad(F.pmod(i, F.lit(10000)), 4),
        F.lit(" ssn "), pad(F.pmod(i, F.lit(1000)), 3), F.lit("-"), pad(F.pmod(i, F.lit(100)), 2), F.lit("-"),
        pad(F.pmod(i, F.lit(10000)), 4),
        F.lit(" iban DE"), pad(F.pmod(i, F.lit(100)), 2), pad(i, 18))
    return d.select("doc_id", F.concat(F.col("text"), tail).alias("text"))


def customer_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed personal fields derived from customer rows (c_custkey = k):
    email = lower(c_name with '#' -> '.') + '@example.com';
    phone = '(5' + k%100 (2 digits) + ') ' + k%1000 (3) + '-' + k%10000 (4);
    ssn = k%1000 (3) + '-' + k%100 (2) + '-' + k%10000 (4);
    credit_card = '4' + k padded to 15 digits; bank_account = 'DE' + k padded
    to 20 digits; name = c_name."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def pad(x, n):
        return F.lpad(x.cast("string"), n, "0")

    return c.select(
        "c_custkey",
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("(5"), pad(F.pmod(k, F.lit(100)), 2), F.lit(") "), pad(F.pmod(k, F.lit(1000)), 3),
                 F.lit("-"), pad(F.pmod(k, F.lit(10000)), 4)).alias("phone"),
        F.concat(pad(F.pmod(k, F.lit(1000)), 3), F.lit("-"), pad(F.pmod(k, F.lit(100)), 2), F.lit("-"),
                 pad(F.pmod(k, F.lit(10000)), 4)).alias("ssn"),
        F.concat(F.lit("4"), pad(k, 15)).alias("credit_card"),
        F.concat(F.lit("DE"), pad(k, 20)).alias("bank_account"),
        F.col("c_name").alias("name"),
    )


# ------------------------------------------------------------ landed inputs
# Extensions cycled over landed document objects (doc_id % 4).
OBJECT_EXTS = [".txt", ".pdf", ".docx", ".md"]


def land_document_objects(spark: SparkSession, sf_dir: str, empty_every: int | None = None) -> str:
    """Write every document as an object ``<lang>/doc_<id><ext>`` under a
    fresh ``.../landing`` folder in the shared scratch area; returns it. With
    ``empty_every`` n, documents whose id n divides are landed without a body."""
    from corpusflow.session import scratch_path
    from corpusflow.sources.files import land_objects
    root = scratch_path(spark, "objects") + "/landing"
    d = read_table(spark, sf_dir, "documents")
    ext = F.element_at(F.array(*[F.lit(e) for e in OBJECT_EXTS]), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    text = F.col("text") if empty_every is None else \
        F.when(F.pmod("doc_id", F.lit(empty_every)) == 0, F.lit("")).otherwise(F.col("text"))
    keys = d.select(F.concat("lang", F.lit("/doc_"), F.col("doc_id").cast("string"), ext).alias("key"),
                    F.encode(text, "UTF-8").alias("data"))
    land_objects(keys, root)
    return root


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as topic messages: key = user_id; value = JSON object
    {sensor_id: user_id, sensor_type: event_type, value, location:
    'zone-' + user_id % 10}, except every 97th event (plain text
    'raw reading <value>') and every 89th (a JSON array [value]);
    topic 'iot-sensors', partition = event_id % 4, offset = event_id div 4,
    timestamp = ts."""
    e = read_table(spark, sf_dir, "events")
    obj = F.to_json(F.struct(F.col("user_id").alias("sensor_id"), F.col("event_type").alias("sensor_type"),
                             "value", F.concat(F.lit("zone-"), F.pmod("user_id", F.lit(10)).cast("string"))
                             .alias("location")))
    value = (F.when(F.pmod("event_id", F.lit(97)) == 0, F.concat(F.lit("raw reading "), F.col("value").cast("string")))
              .when(F.pmod("event_id", F.lit(89)) == 0, F.to_json(F.array("value")))
              .otherwise(obj))
    return e.select(F.col("user_id").cast("string").alias("key"), value.alias("value"),
                    F.lit("iot-sensors").alias("topic"), F.pmod("event_id", F.lit(4)).cast("int").alias("partition"),
                    F.floor(F.col("event_id") / 4).cast("long").alias("offset"),
                    F.col("ts").cast("timestamp").alias("timestamp"))


# Messages per landed file, about: whole consumer batches, so that files don't grow in number with every 500 messages.
FILE_MESSAGES = 50_000


def land_messages(spark: SparkSession, sf_dir: str, batch_size: int = 500, path: str | None = None,
                  part: tuple[int, int] = (0, 1)) -> str:
    """Land messages as JSON lines. A consumer batch, the messages of a partition with the same
    offset div batch_size, is whole in one file; a file holds many of them. ``part`` (k, n) lands the
    k-th of n shares, added to what ``path`` holds."""
    from corpusflow.session import scratch_path
    path = path or scratch_path(spark, "messages")
    from corpusflow.sources.messages import TS_FORMAT
    m = messages(spark, sf_dir).where(F.col("offset") % part[1] == part[0])
    share = read_table(spark, sf_dir, "events").count() // part[1]
    n = max(spark.sparkContext.defaultParallelism, -(-share // FILE_MESSAGES))
    (m.repartition(n, "partition", F.floor(F.col("offset") / batch_size)).sortWithinPartitions("partition", "offset")
      .write.mode("append").option("timestampFormat", TS_FORMAT).json(path))
    return path
