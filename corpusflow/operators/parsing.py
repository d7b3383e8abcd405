"""Routing, decoding, page/table assembly, field extraction, sheet
profiling/rendering/normalisation and record-to-text conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions import render
from corpusflow.functions.text import record_text, ustrip

# Extension -> route.
PDF_EXT = ["pdf"]
WORKBOOK_EXT = ["xlsx", "xls"]
IMAGE_EXT = ["jpg", "jpeg", "png"]
IMAGE_MIME = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png"}


# ------------------------------------------------------------------- P1, P2

def file_extension(name: Column) -> Column:
    """Lower-cased text after the last dot (the whole name if it has none;
    empty for an empty or null name)."""
    return F.when(F.coalesce(F.length(name), F.lit(0)) == 0, F.lit("")) \
            .otherwise(F.lower(F.element_at(F.split(name, r"\.", -1), -1)))


def route_documents(df: DataFrame, name_col: str = "filename") -> DataFrame:
    """Add ``file_ext`` and ``route`` (pdf / workbook / image / text)."""
    ext = file_extension(F.col(name_col))
    return df.withColumn("file_ext", ext).withColumn(
        "route", F.when(ext.isin(*PDF_EXT), "pdf").when(ext.isin(*WORKBOOK_EXT), "workbook")
                  .when(ext.isin(*IMAGE_EXT), "image").otherwise("text"))


def decode_utf8(df: DataFrame, bytes_col: str = "content", out_col: str = "text") -> DataFrame:
    """Strict UTF-8 decode. Invalid input gives a null text and
    ``decode_status = 'invalid_utf8'`` (to be routed to quarantine)."""
    s = F.col(bytes_col).cast("string")
    ok = F.is_valid_utf8(s)
    return df.withColumn(out_col, F.when(ok, s)) \
             .withColumn("decode_status", F.when(F.col(bytes_col).isNull(), "missing")
                         .when(ok, "ok").otherwise("invalid_utf8"))


# ------------------------------------------------------------------- P3-P6

PAGE_BLOCK = 1024


def join_pages(pages: DataFrame, doc_col: str = "document_id", page_col: str = "page",
               text_col: str = "text", block: int = PAGE_BLOCK) -> DataFrame:
    """``(document_id, full_text, num_pages)``; non-empty page texts in
    page order joined by a blank line.

    Two-level: pages are first joined within blocks of ``block`` page numbers
    (``page div block``), then the block texts per document. A document with a
    huge number of pages is thus pre-aggregated in parallel and its final
    group holds one partial text per block, not one entry per page."""
    nonempty = lambda t: F.coalesce(F.length(t), F.lit(0)) > 0
    ordered = lambda c: F.transform(F.array_sort(c), lambda x: x["t"])
    part = pages.groupBy(doc_col, F.floor(F.col(page_col) / block).alias("__blk")).agg(
        F.array_join(F.filter(ordered(F.collect_list(F.struct(F.col(page_col).alias("p"),
                                                              F.col(text_col).alias("t")))), nonempty),
                     "\n\n").alias("__part"),
        F.count(F.lit(1)).alias("__n"))
    g = part.groupBy(doc_col).agg(
        F.array_join(F.filter(ordered(F.collect_list(F.struct(F.col("__blk").alias("p"),
                                                              F.col("__part").alias("t")))), nonempty),
                     "\n\n").alias("full_text"),
        F.sum("__n").alias("num_pages"))
    return g


# Contract field patterns.
CONTRACT_ID = r"Contract\s*(?:ID|Number|No\.?):\s*([A-Z0-9\-]+)"
VENDOR = r"Vendor:\s*([A-Za-z\s&.,]+?)(?:\n|Date)"
DATE = r"(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})"


def extract_contract_fields(df: DataFrame, text_col: str = "full_text") -> DataFrame:
    """P5: first contract id, first vendor (stripped), all dates; absent ->
    null."""
    t = F.col(text_col)
    cid = F.regexp_extract(t, "(?iU)" + CONTRACT_ID, 1)
    vendor = ustrip(F.regexp_extract(t, "(?iU)" + VENDOR, 1))
    dates = F.regexp_extract_all(t, F.lit("(?U)" + DATE), 1)
    has_cid = t.rlike("(?iU)" + CONTRACT_ID)
    has_vendor = t.rlike("(?iU)" + VENDOR)
    return df.withColumns({
        "contract_id": F.when(has_cid, cid),
        "vendor_name": F.when(has_vendor, vendor),
        "dates_found": F.when(F.size(dates) > 0, dates),
    })


def bill_of_lading(pages: DataFrame, tables: DataFrame | None = None, doc_col: str = "document_id") -> DataFrame:
    """``document_type='bill_of_lading'``, ``parsed_at``, full text and
    (optionally) the document's Markdown tables."""
    docs = join_pages(pages, doc_col)
    if tables is not None:
        t = tables.groupBy(doc_col).agg(F.array_sort(F.collect_list(
            F.struct("page", "table_index", render.table_markdown(F.col("cells")).alias("markdown"))))
            .alias("tables"))
        docs = docs.join(t, doc_col, "left")
    return docs.withColumn("document_type", F.lit("bill_of_lading")) \
               .withColumn("parsed_at", F.current_timestamp())


# ------------------------------------------------------------------ P7-P11

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def column_kind(dt: T.DataType) -> str:
    if isinstance(dt, NUMERIC):
        return "numeric"
    if isinstance(dt, DATES):
        return "date"
    if isinstance(dt, T.StringType):
        return "text"
    return "other"


def sheet_profile(df: DataFrame, sheet_name: str) -> DataFrame:
    """One row per column: ``sheet_name, column_position, column_name,
    column_kind, null_count, num_rows, num_columns``. All counts come from one
    aggregation pass over the sheet."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"__null{i}") for i, c in enumerate(cols)]
    counts = df.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(i).alias("column_position"), F.lit(c).alias("column_name"),
                                 F.lit(column_kind(df.schema[c].dataType)).alias("column_kind"),
                                 F.col(f"__null{i}").alias("null_count"))
                        for i, c in enumerate(cols)])
    return counts.select(F.lit(sheet_name).alias("sheet_name"), F.col("__n").alias("num_rows"),
                         F.lit(len(cols)).alias("num_columns"), F.inline(entries))


def sheet_cells(df: DataFrame, columns: list[str]) -> Column:
    """Row values as ``array<string>`` in column order."""
    return F.array(*[F.col(f"`{c}`").cast("string") for c in columns])


def _order_key(order_cols: str | list[str]) -> Column:
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return F.struct(*[F.col(f"`{c}`") for c in cols])


def render_sheets(rows: DataFrame, key_cols: list[str], order_cols: str | list[str],
                  columns: list[str]) -> DataFrame:
    """Per sheet (``key_cols``) Markdown, HTML and CSV renderings, rows in
    ``order_cols`` order (typed values). A sheet is one group, so sheets must
    be bounded (workbook sheets are)."""
    header = F.array(*[F.lit(c) for c in columns])
    g = rows.groupBy(*key_cols).agg(F.array_sort(F.collect_list(
        F.struct(_order_key(order_cols).alias("o"), sheet_cells(rows, columns).alias("cells")))).alias("__r"),
        F.count(F.lit(1)).alias("num_rows"))
    table = F.concat(F.array(header), F.transform("__r", lambda r: r["cells"]))
    return g.select(*key_cols, "num_rows", F.lit(len(columns)).alias("num_columns"),
                    render.table_markdown(table).alias("markdown"), render.table_html(table).alias("html"),
                    render.table_csv(table).alias("csv"))


# Standard shipment fields and their accepted header spellings,
# in order of preference.
SHIPMENT_FIELDS = {
    "shipment_id": ["Shipment ID", "ShipmentID", "ID", "Shipment No"],
    "vendor_id": ["Vendor ID", "VendorID", "Supplier_No", "Supplier ID"],
    "origin": ["Origin", "From", "Source", "Departure"],
    "destination": ["Destination", "To", "Target", "Arrival"],
    "status": ["Status", "State", "Condition"],
    "departure_date": ["Departure Date", "Dept Date", "Start Date"],
    "arrival_date": ["Arrival Date", "Arr Date", "End Date"],
    "cargo_type": ["Cargo Type", "Product", "Goods Type"],
    "weight": ["Weight", "Weight (kg)", "Weight_KG"],
}


def normalize_shipments(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Schema-level rename. For each standard field the first alias
    present among the columns wins (even if its values are null); fields with
    no alias are null; other columns are dropped. Without an id alias the
    result is empty."""
    present = set(df.columns)
    sel = [F.col(f"`{k}`") for k in (keep or [])]
    has_id = False
    for std, aliases in SHIPMENT_FIELDS.items():
        hit = next((a for a in aliases if a in present), None)
        if std == "shipment_id":
            has_id = hit is not None
        sel.append(F.col(f"`{hit}`").alias(std) if hit else F.lit(None).cast("string").alias(std))
    out = df.select(*sel)
    return out if has_id else out.where(F.lit(False))


def row_chunks(rows: DataFrame, key_cols: list[str], order_cols: str | list[str],
               columns: list[str]) -> DataFrame:
    """P10 (row mode): one chunk per row holding the header and that row as
    Markdown, ``row_index`` = position within its sheet by ``order_cols``."""
    header = F.array(*[F.lit(c) for c in columns])
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    w = Window.partitionBy(*key_cols).orderBy(*[F.col(f"`{c}`") for c in cols])
    cells = sheet_cells(rows, columns)
    return rows.select(*key_cols, (F.row_number().over(w) - 1).alias("row_index"),
                       render.table_markdown(F.array(header, cells)).alias("content"),
                       F.lit("table_row").alias("type"), F.lit("excel_row").alias("format"),
                       F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("data"))


def table_chunks(rows: DataFrame, key_cols: list[str], order_cols: str | list[str], columns: list[str],
                 chunk_by: str = "row") -> DataFrame:
    """P10: workbook chunks by ``row`` (header + one row each), ``sheet`` or
    ``table`` (the whole sheet as one Markdown chunk; a sheet is one table)."""
    if chunk_by == "row":
        return row_chunks(rows, key_cols, order_cols, columns)
    if chunk_by not in ("sheet", "table"):
        raise ValueError(f"Unknown chunk_by: {chunk_by}")
    r = render_sheets(rows, key_cols, order_cols, columns)
    return r.select(*key_cols, F.col("markdown").alias("content"), F.lit("table").alias("type"),
                    F.lit(f"excel_{chunk_by}").alias("format"), "num_rows", "num_columns")


def select_sheets(sheets: DataFrame, parse_all_sheets: bool = True,
                  index_col: str = "sheet_index") -> DataFrame:
    """All sheets, or only the first of each workbook."""
    return sheets if parse_all_sheets else sheets.where(F.col(index_col) == 0)


# --------------------------------------------------------------- P14-P16

def records_to_text(df: DataFrame, columns: list[str] | None = None, out_col: str = "content") -> DataFrame:
    """``name: value`` lines in field order (null -> ``None``)."""
    cols = columns or df.columns
    return df.withColumn(out_col, record_text(cols, [F.col(f"`{c}`") for c in cols]))


def single_chunk(df: DataFrame, content_col: str = "content") -> DataFrame:
    """A stream or API record is exactly one chunk (index 0 of 1)."""
    return df.withColumns({"chunk_index": F.lit(0), "total_chunks": F.lit(1),
                           "chunk_size": F.length(content_col)})
