"""Registered parsing queries (P1-P10, P14-P16) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import render
from corpusflow.operators import parsing as ps
from corpusflow.operators.chunking import chunk_fixed
from corpusflow.plans.registry import register
from corpusflow.sources.tables import read_table

# File-name suffixes cycled over pages by page_id % 10.
NAME_SUFFIXES = [".pdf", ".PDF", ".xlsx", ".xls", ".jpg", ".jpeg", ".png", ".txt", ".docx", ""]


def _sql_list(xs):
    return "[" + ", ".join("'" + x + "'" for x in xs) + "]"


SQL_ROUTE = f"""WITH f AS (SELECT page_id, 'doc_' || page_id::VARCHAR || {_sql_list(NAME_SUFFIXES)}[(page_id % 10) + 1] AS filename
           FROM pages),
e AS (SELECT page_id, filename, CASE WHEN length(filename) = 0 THEN '' ELSE lower(string_split(filename, '.')[-1]) END AS file_ext FROM f)
SELECT page_id, filename, file_ext,
       CASE WHEN file_ext = 'pdf' THEN 'pdf' WHEN file_ext IN ('xlsx', 'xls') THEN 'workbook'
            WHEN file_ext IN ('jpg', 'jpeg', 'png') THEN 'image' ELSE 'text' END AS route
FROM e"""


@register("route_files", SQL_ROUTE)
def q_route_files(spark, sf_dir):
    """Route every page by the extension of a derived file name."""
    p = read_table(spark, sf_dir, "pages").select("page_id")
    sfx = F.element_at(F.array(*[F.lit(s) for s in NAME_SUFFIXES]), (F.pmod("page_id", F.lit(10)) + 1).cast("int"))
    p = p.withColumn("filename", F.concat(F.lit("doc_"), F.col("page_id").cast("string"), sfx))
    return ps.route_documents(p).select("page_id", "filename", "file_ext", "route")


SQL_DECODE = """WITH b AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN encode(html) || '\\xFF'::BLOB ELSE encode(html) END AS content
           FROM pages)
SELECT page_id, octet_length(content)::BIGINT AS n_bytes, try(decode(content)) AS text,
       CASE WHEN try(decode(content)) IS NULL THEN 'invalid_utf8' ELSE 'ok' END AS decode_status
FROM b"""


@register("decode_text", SQL_DECODE)
def q_decode_text(spark, sf_dir):
    """Strict UTF-8 decoding of page bytes; every 7th page carries an
    invalid trailing byte and is flagged instead of decoded."""
    p = read_table(spark, sf_dir, "pages")
    raw = F.encode("html", "UTF-8")
    content = F.when(F.pmod("page_id", F.lit(7)) == 0, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw)
    d = ps.decode_utf8(p.select("page_id", content.alias("content")))
    return d.select("page_id", F.octet_length("content").cast("long").alias("n_bytes"), "text", "decode_status")


def _conv_pages(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("document_id"), F.col("turn").alias("page"), "text")


SQL_PAGES = """SELECT conv_id AS document_id,
       coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE length(text) > 0), '') AS full_text,
       count(*)::BIGINT AS num_pages
FROM conversations GROUP BY conv_id"""


@register("page_join", SQL_PAGES)
def q_page_join(spark, sf_dir):
    """Conversation turns as pages joined into one text per document."""
    return ps.join_pages(_conv_pages(spark, sf_dir)).select(
        "document_id", "full_text", F.col("num_pages").cast("long").alias("num_pages"))


@register("bill_of_lading", SQL_PAGES.replace("SELECT conv_id AS document_id,",
                                              "SELECT conv_id AS document_id, 'bill_of_lading' AS document_type,"))
def q_bill_of_lading(spark, sf_dir):
    """Bill-of-lading records (type tag + page text) per document."""
    return ps.bill_of_lading(_conv_pages(spark, sf_dir)).select(
        "document_id", "document_type", "full_text", F.col("num_pages").cast("long").alias("num_pages"))


LINE_COLS = ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]


def _sql_md(cols):
    head = "| " + " | ".join(cols) + " |"
    sep = "| " + " | ".join(["---"] * len(cols)) + " |"
    row = "'| ' || " + " || ' | ' || ".join(f"coalesce({c}::VARCHAR, '')" for c in cols) + " || ' |'"
    return head, sep, row


def _sql_table_md():
    head, sep, row = _sql_md(LINE_COLS)
    return f"""SELECT l_orderkey AS document_id,
       '{head}' || chr(10) || '{sep}' || chr(10) || string_agg({row}, chr(10) ORDER BY {", ".join(LINE_COLS)}) AS markdown
FROM lineitem GROUP BY l_orderkey"""


@register("table_markdown", _sql_table_md())
def q_table_markdown(spark, sf_dir):
    """Each order's line items as a 2-D cell table rendered to Markdown."""
    li = read_table(spark, sf_dir, "lineitem")
    t = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        F.struct(*LINE_COLS).alias("o"), ps.sheet_cells(li, LINE_COLS).alias("c")))).alias("r"))
    cells = F.concat(F.array(F.array(*[F.lit(c) for c in LINE_COLS])), F.transform("r", lambda x: x["c"]))
    return t.select(F.col("l_orderkey").alias("document_id"), render.table_markdown(cells).alias("markdown"))


def _contract_text_spark(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    k = F.col("o_orderkey")
    d1 = F.date_format("o_orderdate", "dd/MM/yyyy")
    d2 = F.date_format("o_orderdate", "MM-dd-yy")
    m = F.pmod(k, F.lit(4))
    text = (F.when(m == 0, F.concat(F.lit("Contract ID: CT-"), k.cast("string"), F.lit("\nVendor: Acme "),
                                     F.lower("c_mktsegment"), F.lit(" & Co.\nDate: "), d1,
                                     F.lit(" total "), F.col("o_totalprice").cast("string")))
             .when(m == 1, F.concat(F.lit("contract no.: ct"), k.cast("string"), F.lit(" vendor: "),
                                    F.lower("c_mktsegment"), F.lit(" Date "), d2))
             .when(m == 2, F.concat(F.lit("Purchase order "), k.cast("string"), F.lit(" for "), F.col("c_name")))
             .otherwise(F.concat(F.lit("Contract Number:"), k.cast("string"), F.lit("\nVendor:"),
                                 F.col("c_mktsegment"), F.lit("\nSigned "), d1, F.lit(" and "), d2)))
    return j.select("o_orderkey", text.alias("full_text"))


SQL_CONTRACT_TEXT = """ct AS (
  SELECT o.o_orderkey, CASE o.o_orderkey % 4
    WHEN 0 THEN 'Contract ID: CT-' || o.o_orderkey::VARCHAR || chr(10) || 'Vendor: Acme ' || lower(c.c_mktsegment)
                || ' & Co.' || chr(10) || 'Date: ' || strftime(o.o_orderdate, '%d/%m/%Y') || ' total ' || o.o_totalprice::VARCHAR
    WHEN 1 THEN 'contract no.: ct' || o.o_orderkey::VARCHAR || ' vendor: ' || lower(c.c_mktsegment) || ' Date '
                || strftime(o.o_orderdate, '%m-%d-%y')
    WHEN 2 THEN 'Purchase order ' || o.o_orderkey::VARCHAR || ' for ' || c.c_name
    ELSE 'Contract Number:' || o.o_orderkey::VARCHAR || chr(10) || 'Vendor:' || c.c_mktsegment || chr(10) || 'Signed '
         || strftime(o.o_orderdate, '%d/%m/%Y') || ' and ' || strftime(o.o_orderdate, '%m-%d-%y') END AS full_text
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

SQL_CONTRACT = f"""WITH {SQL_CONTRACT_TEXT}
SELECT o_orderkey,
       CASE WHEN regexp_matches(full_text, '(?i){ps.CONTRACT_ID}') THEN regexp_extract(full_text, '(?i){ps.CONTRACT_ID}', 1) END AS contract_id,
       CASE WHEN regexp_matches(full_text, '(?i){ps.VENDOR}') THEN regexp_replace(regexp_extract(full_text, '(?i){ps.VENDOR}', 1), '^\\s+|\\s+$', '', 'g') END AS vendor_name,
       CASE WHEN len(regexp_extract_all(full_text, '{ps.DATE}', 1)) > 0 THEN array_to_string(regexp_extract_all(full_text, '{ps.DATE}', 1), ',') END AS dates_found
FROM ct"""


@register("contract_fields", SQL_CONTRACT)
def q_contract_fields(spark, sf_dir):
    """P5: contract id / vendor / dates from templated contract texts."""
    r = ps.extract_contract_fields(_contract_text_spark(spark, sf_dir))
    return r.select("o_orderkey", "contract_id", "vendor_name",
                    F.array_join("dates_found", ",").alias("dates_found"))


# ------------------------------------------------------------ workbook views
def _sql_profile(table: str, cols: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{table}' AS sheet_name, {i}::BIGINT AS column_position, '{c}' AS column_name, "
             f"'{k}' AS column_kind, count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS null_count, "
             f"count(*)::BIGINT AS num_rows, {len(cols)}::BIGINT AS num_columns FROM {table}"
             for i, (c, k) in enumerate(cols)]
    return "\nUNION ALL\n".join(parts)


PROFILE_TABLES = {
    "customer": [("c_custkey", "numeric"), ("c_name", "text"), ("c_nationkey", "numeric"),
                 ("c_acctbal", "numeric"), ("c_mktsegment", "text")],
    "orders": [("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_orderstatus", "text"),
               ("o_totalprice", "numeric"), ("o_orderdate", "date"), ("o_orderpriority", "text")],
    "part": [("p_partkey", "numeric"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"),
             ("p_size", "numeric"), ("p_retailprice", "numeric")],
}


@register("sheet_profile", "\nUNION ALL\n".join(_sql_profile(t, c) for t, c in PROFILE_TABLES.items()))
def q_sheet_profile(spark, sf_dir):
    """Per-column profile (kind, null count) of customer, orders, part."""
    out = None
    for t in PROFILE_TABLES:
        p = ps.sheet_profile(read_table(spark, sf_dir, t), t)
        out = p if out is None else out.unionByName(p)
    return out.select("sheet_name", F.col("column_position").cast("long").alias("column_position"),
                      "column_name", "column_kind", F.col("null_count").cast("long").alias("null_count"),
                      F.col("num_rows").cast("long").alias("num_rows"),
                      F.col("num_columns").cast("long").alias("num_columns"))


SHEET_COLS = LINE_COLS + ["l_shipdate"]
SHEET_ORDER = ", ".join(SHEET_COLS)


def _sql_render():
    head, sep, row = _sql_md(SHEET_COLS)
    csv_cell = ("CASE WHEN regexp_matches(coalesce({c}::VARCHAR, ''), '[,\"\\r\\n]') THEN '\"' || "
                "replace(coalesce({c}::VARCHAR, ''), '\"', '\"\"') || '\"' ELSE coalesce({c}::VARCHAR, '') END")
    csv_row = " || ',' || ".join(csv_cell.format(c=c) for c in SHEET_COLS)
    esc = "replace(replace(replace(coalesce({c}::VARCHAR, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    html_row = "'<tr>' || " + " || ".join(f"'<td>' || {esc.format(c=c)} || '</td>'" for c in SHEET_COLS) + " || '</tr>'"
    html_head = "<tr>" + "".join(f"<th>{c}</th>" for c in SHEET_COLS) + "</tr>"
    return f"""SELECT l_orderkey AS document_id, 'lines' AS sheet_name, count(*)::BIGINT AS num_rows,
       {len(SHEET_COLS)}::BIGINT AS num_columns,
       '{head}' || chr(10) || '{sep}' || chr(10) || string_agg({row}, chr(10) ORDER BY {SHEET_ORDER}) AS markdown,
       '<table><thead>{html_head}</thead><tbody>' || string_agg({html_row}, '' ORDER BY {SHEET_ORDER}) || '</tbody></table>' AS html,
       '{",".join(SHEET_COLS)}' || chr(10) || string_agg({csv_row}, chr(10) ORDER BY {SHEET_ORDER}) || chr(10) AS csv
FROM lineitem GROUP BY l_orderkey"""


def _line_sheets(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.withColumn("document_id", F.col("l_orderkey")).withColumn("sheet_name", F.lit("lines"))


@register("sheet_render", _sql_render())
def q_sheet_render(spark, sf_dir):
    """Each order's line items as a sheet rendered to Markdown/HTML/CSV."""
    r = ps.render_sheets(_line_sheets(spark, sf_dir), ["document_id", "sheet_name"], SHEET_COLS, SHEET_COLS)
    return r.select("document_id", "sheet_name", F.col("num_rows").cast("long").alias("num_rows"),
                    F.col("num_columns").cast("long").alias("num_columns"), "markdown", "html", "csv")


def _aliased_orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("Shipment No"), (F.col("o_orderkey") * 10).alias("ID"),
                    F.col("o_custkey").alias("Supplier_No"), F.col("o_orderstatus").alias("State"),
                    F.col("o_orderdate").alias("Dept Date"), F.col("o_orderpriority").alias("Product"),
                    F.col("o_totalprice").alias("Weight_KG"), F.lit("x").alias("Comment"))


SQL_NORMALIZE = """SELECT o_orderkey * 10 AS shipment_id, o_custkey AS vendor_id, NULL::VARCHAR AS origin,
       NULL::VARCHAR AS destination, o_orderstatus AS status, o_orderdate::VARCHAR AS departure_date,
       NULL::VARCHAR AS arrival_date, o_orderpriority AS cargo_type, o_totalprice AS weight
FROM orders"""


@register("normalize_shipments", SQL_NORMALIZE)
def q_normalize_shipments(spark, sf_dir):
    """Orders exported under alias headers, normalised back to the nine
    standard shipment fields ('ID' outranks 'Shipment No')."""
    n = ps.normalize_shipments(_aliased_orders(spark, sf_dir))
    return n.withColumn("departure_date", F.col("departure_date").cast("string"))


def _sql_row_chunks():
    head, sep, row = _sql_md(LINE_COLS)
    data = "to_json({" + ", ".join(f"'{c}': {c}" for c in LINE_COLS) + "})"
    return f"""SELECT l_orderkey AS document_id,
       (row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_COLS)}) - 1)::BIGINT AS row_index,
       '{head}' || chr(10) || '{sep}' || chr(10) || {row} AS content, 'table_row' AS type, {data}::VARCHAR AS data
FROM lineitem"""


@register("row_chunks", _sql_row_chunks())
def q_row_chunks(spark, sf_dir):
    """P10: one Markdown chunk (header + row) per line item, numbered within
    its order's sheet."""
    r = ps.row_chunks(_line_sheets(spark, sf_dir), ["document_id"], LINE_COLS, LINE_COLS)
    return r.select("document_id", F.col("row_index").cast("long").alias("row_index"), "content", "type", "data")


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
SQL_RECORD = ("array_to_string([" + ", ".join(f"'{c}: ' || coalesce({c}::VARCHAR, 'None')" for c in ORDER_COLS)
              + "], chr(10))")


@register("record_text", f"SELECT o_orderkey, {SQL_RECORD} AS content FROM orders")
def q_record_text(spark, sf_dir):
    """Every order row as ``name: value`` lines."""
    o = read_table(spark, sf_dir, "orders")
    return ps.records_to_text(o, ORDER_COLS).select("o_orderkey", "content")


@register("db_record_chunks", f"""SELECT o_orderkey, (s // 80)::BIGINT AS chunk_index,
       count(*) OVER (PARTITION BY o_orderkey)::BIGINT AS total_chunks, substr(content, s + 1, 100) AS content
FROM (SELECT o_orderkey, content, unnest(range(0, length(content), 80)) AS s
      FROM (SELECT o_orderkey, {SQL_RECORD} AS content FROM orders))""")
def q_db_record_chunks(spark, sf_dir):
    """Order records -> text -> fixed chunks (100 chars, overlap 20)."""
    o = ps.records_to_text(read_table(spark, sf_dir, "orders"), ORDER_COLS, out_col="text")
    c = chunk_fixed(o.select("o_orderkey", "text"), 100, 20, id_col="o_orderkey")
    return c.select("o_orderkey", F.col("chunk_index").cast("long").alias("chunk_index"),
                    F.col("total_chunks").cast("long").alias("total_chunks"), "content")


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
SQL_EVENT = ("array_to_string([" + ", ".join(f"'{c}: ' || coalesce({c}::VARCHAR, 'None')" for c in EVENT_COLS)
             + "], chr(10))")


@register("stream_record_chunk", f"""SELECT event_id, 0::BIGINT AS chunk_index, 1::BIGINT AS total_chunks,
       length({SQL_EVENT})::BIGINT AS chunk_size, {SQL_EVENT} AS content FROM events""")
def q_stream_record_chunk(spark, sf_dir):
    """Each event record becomes exactly one chunk."""
    e = ps.single_chunk(ps.records_to_text(read_table(spark, sf_dir, "events"), EVENT_COLS))
    return e.select("event_id", F.col("chunk_index").cast("long").alias("chunk_index"),
                    F.col("total_chunks").cast("long").alias("total_chunks"),
                    F.col("chunk_size").cast("long").alias("chunk_size"), "content")


@register("image_facts", """SELECT 'img/supplier_' || s_suppkey::VARCHAR || '.png' AS key, 'PNG' AS format, 'RGB' AS mode,
       (s_suppkey % 50 + 1)::INTEGER AS width, (s_nationkey + 1)::INTEGER AS height, 3::INTEGER AS n_channels,
       'image/png' AS mime_type FROM supplier""")
def q_image_facts(spark, sf_dir):
    """One PNG per supplier landed in the shared folder, read back
    with the image source (size, channels) and binaryFile (bytes, base64)."""
    from corpusflow.session import scratch_path
    from corpusflow.sources.files import land_objects
    from corpusflow.sources.images import image_facts, solid_png
    s = read_table(spark, sf_dir, "supplier")
    root = scratch_path(spark, "images") + "/landing"
    data = solid_png(F.pmod("s_suppkey", F.lit(50)) + 1, F.col("s_nationkey") + 1, F.col("s_suppkey"),
                     F.col("s_nationkey") * 9, F.floor(F.abs("s_acctbal")))
    land_objects(s.select(F.concat(F.lit("img/supplier_"), F.col("s_suppkey").cast("string"), F.lit(".png"))
                          .alias("key"), data.alias("data")), root)
    f = image_facts(spark, root)
    return f.where(F.length("base64") > 0).select(
        F.regexp_extract("path", "/landing/(.*)$", 1).alias("key"), "format", "mode", "width", "height",
        "n_channels", "mime_type")
