"""SQL sources as envelopes.

Two routes: ``read.format("jdbc")`` for an external database (partitioned
reads, pushed-down filters, ``fetchsize`` = batch size) and ``spark.sql`` with
named parameters for tables registered in the session catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              batch_size: int = 1000) -> DataFrame:
    """S4 over JDBC: a table or a query, optionally split into
    ``num_partitions`` range reads on ``partition_column``."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", batch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    r = r.option("dbtable", table) if table else r.option("query", query)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return r.load()


def run_query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """S4 over registered tables: parameterised SQL (``:name`` markers)."""
    return spark.sql(sql, args=params or {})


def _envelope(df: DataFrame, uri, extra: dict) -> DataFrame:
    content = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    meta = F.struct(F.lit("database").alias("source_type"), uri.alias("source_uri"),
                    *[v.alias(k) for k, v in extra.items()],
                    F.current_timestamp().alias("ingestion_ts"))
    return df.select(content.alias("content"), meta.alias("metadata"))


def ingest_custom_query(spark: SparkSession, sql: str, query_name: str,
                        params: dict | None = None) -> DataFrame:
    """Query rows tagged ``query_name``, ``db://query/<name>`` and the
    first 200 characters of the query text."""
    df = run_query(spark, sql, params)
    return _envelope(df, F.lit(f"db://query/{query_name}"),
                     {"query_name": F.lit(query_name), "query": F.lit(sql[:200])})


def ingest_table(df: DataFrame, table_name: str, schema: str | None = None,
                 filters: dict | None = None, columns: list[str] | None = None) -> DataFrame:
    """A whole table with a column list and AND-ed equality filters
    (pushed into the scan)."""
    if filters:
        cond = F.lit(True)
        for k, v in filters.items():
            cond = cond & (F.col(k) == F.lit(v))
        df = df.where(cond)
    if columns:
        df = df.select(*columns)
    return _envelope(df, F.lit(f"db://{table_name}"),
                     {"table_name": F.lit(table_name), "schema": F.lit(schema).cast("string")})


SHIPMENT_COLUMNS = ["shipment_id", "vendor_id", "origin", "destination", "status", "departure_date",
                    "arrival_date", "delay_hours", "cargo_type", "weight_kg", "region"]


def ingest_shipment_logs(shipments: DataFrame, start_date: str, end_date: str | None = None,
                         region: str | None = None) -> DataFrame:
    """The 11 shipment columns, ``departure_date >= start`` (and ``<= end``,
    ``region =`` when given), newest first, with ``db://shipment_logs/<id>``."""
    d = shipments.select(*SHIPMENT_COLUMNS).where(F.col("departure_date") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date:
        d = d.where(F.col("departure_date") <= F.lit(end_date).cast("timestamp_ntz"))
    if region:
        d = d.where(F.col("region") == region)
    return d.orderBy(F.col("departure_date").desc()).withColumn(
        "source_uri", F.concat(F.lit("db://shipment_logs/"), F.col("shipment_id").cast("string")))


def table_schema(df: DataFrame) -> DataFrame:
    """``position, column_name, data_type, nullable, column_default,
    is_primary_key`` from the schema (defaults and keys exist only in JDBC
    metadata, so they are null here) plus ``null_count`` observed in the data,
    all from one aggregation pass over the table."""
    fields = df.schema.fields
    counts = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"__n{i}") for i, f in enumerate(fields)])
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                                 F.lit(f.dataType.simpleString()).alias("data_type"),
                                 F.lit(f.nullable).alias("nullable"), F.col(f"__n{i}").alias("null_count"))
                        for i, f in enumerate(fields)])
    return counts.select(F.inline(entries)) \
                 .withColumn("column_default", F.lit(None).cast("string")) \
                 .withColumn("is_primary_key", F.lit(None).cast("boolean"))
