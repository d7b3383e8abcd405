"""JSON API responses landed as files (one JSON document per line),
then flattened with explode / variant functions. Requests that drive lookups
(locations, routes) are DataFrames joined to the responses."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.sizing import sized_broadcast

# Elements are variants: a document keeps every field that the response has.
PORTS_SCHEMA = "ports array<variant>"
ROUTES_SCHEMA = "routes array<variant>"
WEATHER_SCHEMA = "lat double, lon double, forecast variant"


def _field(node: str, name: str, kind: str = "string"):
    return F.try_variant_get(node, f"$.{name}", kind)


def land_json(df: DataFrame, path: str, json_col: str = "json") -> None:
    """Write one JSON document per line (a response per line)."""
    df.select(F.col(json_col).alias("value")).write.mode("overwrite").text(path)


def read_responses(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_responses_checked(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Landed responses split into parsed rows and a quarantine of lines that
    are not valid JSON (``raw_response``, ``error``), so failed landings are
    counted instead of silently becoming empty results."""
    lines = spark.read.text(path)
    valid = F.try_parse_json("value").isNotNull()
    good = lines.where(valid).select(F.from_json("value", schema).alias("__r")).select("__r.*")
    bad = lines.where(~valid).select(F.col("value").alias("raw_response"),
                                     F.lit("malformed response").alias("error"))
    return good, bad


def _api_meta(api_name: str, document_type: str, uri, **extra):
    return F.struct(F.lit("api").alias("source_type"), F.lit(api_name).alias("api_name"),
                    F.lit(document_type).alias("document_type"), uri.alias("source_uri"),
                    *[v.alias(k) for k, v in extra.items()],
                    F.current_timestamp().alias("ingestion_ts"))


def port_congestion(responses: DataFrame, port_codes: list[str] | None = None) -> DataFrame:
    """One document per port in ``ports[]``, its whole object as content; optional port filter."""
    p = responses.select(F.explode("ports").alias("port"))
    if port_codes:
        p = p.where(_field("port", "port_code").isin(*port_codes))
    uri = F.concat(F.lit("api://port_congestion/"), _field("port", "port_code"))
    return p.select(F.col("port").alias("content"),
                    _api_meta("port_congestion", "port_congestion", uri,
                              port_code=_field("port", "port_code"), country=_field("port", "country"),
                              data_timestamp=_field("port", "timestamp")).alias("metadata"))


def weather_forecast(responses: DataFrame, locations: DataFrame) -> DataFrame:
    """One forecast document per requested location ``(name, lat, lon)``
    that has a response; locations without one are skipped."""
    r = sized_broadcast(responses.select("lat", "lon", "forecast"))
    j = locations.join(r, ["lat", "lon"])
    uri = F.concat(F.lit("api://weather/"), F.col("name"))
    return j.select(F.col("forecast").alias("content"), "name", "lat", "lon",
                    _api_meta("weather", "weather_forecast", uri, location=F.col("name")).alias("metadata"))


def shipping_rates(responses: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """All route rates, or those of the requested ``(origin,
    destination)`` pairs; a pair requested twice yields its rows twice."""
    r = responses.select(F.explode("routes").alias("route")).select(
        "route", *[_field("route", k).alias(k) for k in ("origin", "destination")])
    if routes is not None:
        r = r.join(sized_broadcast(routes.select("origin", "destination")), ["origin", "destination"])
    uri = F.concat(F.lit("api://shipping_rates/"), F.col("origin"), F.lit("/"), F.col("destination"))
    return r.select(F.col("route").alias("content"), "origin", "destination",
                    _api_meta("shipping_rates", "shipping_rates", uri, carrier=_field("route", "carrier"),
                              data_timestamp=_field("route", "timestamp")).alias("metadata"))


def custom_api(responses: DataFrame, api_name: str, document_type: str, data_path: str | None = None,
               id_field: str | None = None, text_col: str = "value") -> DataFrame:
    """Any JSON response. ``data_path`` is dotted; at that path a list
    gives one document per element, anything else one document; a missing
    path gives one empty object. Responses that aren't JSON give no document
    (:func:`malformed_responses` has them); without a ``response_id`` column the
    hash of the response is its id. ``document_id`` comes from ``id_field``
    (``api://<name>/<id or unknown>``)."""
    v = F.try_parse_json(text_col)
    path = "$" + "".join(f".{k}" for k in data_path.split(".")) if data_path else "$"
    node = F.try_variant_get(v, path, "variant")
    node = F.coalesce(node, F.parse_json(F.lit("{}")))
    as_list = F.try_variant_get(node, "$", "array<variant>")
    items = F.when(as_list.isNotNull(), as_list).otherwise(F.array(node))
    responses = responses.where(v.isNotNull())
    r = responses.withColumn("__resp", F.xxhash64(text_col)) if "response_id" not in responses.columns \
        else responses.withColumnRenamed("response_id", "__resp")
    x = r.select(F.col("__resp").alias("response_id"), F.posexplode(items).alias("item_index", "item"))
    doc_id = F.try_variant_get("item", f"$.{id_field}", "string") if id_field else F.lit(None).cast("string")
    uri = F.concat(F.lit(f"api://{api_name}/"), F.coalesce(doc_id, F.lit("unknown")))
    return x.select("response_id", "item_index", F.col("item").alias("content"),
                    doc_id.alias("document_id"),
                    _api_meta(api_name, document_type, uri, document_id=doc_id).alias("metadata"))


def malformed_responses(responses: DataFrame, text_col: str = "value") -> DataFrame:
    """The responses that :func:`custom_api` can't read, with an ``error``."""
    bad = F.try_parse_json(text_col).isNull()
    return responses.where(bad).withColumn("error", F.lit("malformed response"))


POLL_OUT = "endpoint string, poll_number long, poll_time string, payload string"
POLL_STATE = "polls long"


def number_polls(endpoint_col: str = "endpoint", time_col: str = "poll_time"):
    """S17 stateful step for ``applyInPandasWithState``: successful responses of
    an endpoint are numbered 1, 2, 3, ... across micro-batches; failed polls
    never reach it, so they do not advance the count."""
    def fn(key, pdfs, state):
        done = state.get[0] if state.exists else 0
        rows = pd.concat(list(pdfs), ignore_index=True).sort_values(time_col, kind="stable")
        n = len(rows)
        out = pd.DataFrame({
            "endpoint": [key[0]] * n,
            "poll_number": range(done + 1, done + n + 1),
            "poll_time": rows[time_col].astype(str).to_list(),
            "payload": rows["payload"].to_list(),
        })
        state.update((done + n,))
        yield out
    return fn


def poll_endpoint(polls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S17 over a stream of landed poll responses ``(endpoint, poll_time,
    value)``: valid JSON responses are numbered per endpoint; invalid ones are
    returned separately (quarantine) and not counted."""
    v = F.try_parse_json("value")
    good = polls.where(v.isNotNull()).select("endpoint", "poll_time", F.col("value").alias("payload"))
    bad = polls.where(v.isNull())
    numbered = good.groupBy("endpoint").applyInPandasWithState(
        number_polls(), POLL_OUT, POLL_STATE, "append", "NoTimeout")
    return numbered, bad
