from pyspark.sql import functions as F

from corpusflow.functions import render
from corpusflow.operators import parsing as ps


def test_route(spark):
    df = spark.createDataFrame([("a.PDF",), ("b.xls",), ("c.jpeg",), ("d.txt",), ("noext",), ("",), (None,)],
                               "filename string")
    got = [r.route for r in ps.route_documents(df).collect()]
    assert got == ["pdf", "workbook", "image", "text", "text", "text", "text"]


def test_decode(spark):
    df = spark.createDataFrame([(bytearray("héllo", "utf-8"),), (bytearray(b"\xff\xfe"),)], "content binary")
    rows = ps.decode_utf8(df).collect()
    assert (rows[0].text, rows[0].decode_status) == ("héllo", "ok")
    assert (rows[1].text, rows[1].decode_status) == (None, "invalid_utf8")


def test_table_markdown(spark):
    df = spark.createDataFrame([([["a", "b"], ["1", None]],), ([["only"]],), ([],)], "t array<array<string>>")
    got = [r.m for r in df.select(render.table_markdown(F.col("t")).alias("m")).collect()]
    assert got == ["| a | b |\n| --- | --- |\n| 1 |  |", "", ""]


def test_join_pages(spark):
    pages = spark.createDataFrame([(1, 2, "second"), (1, 1, "first"), (1, 3, ""), (2, 1, None)],
                                  "document_id long, page long, text string")
    got = {r.document_id: r.full_text for r in ps.join_pages(pages).collect()}
    assert got == {1: "first\n\nsecond", 2: ""}


def test_contract_fields(spark):
    text = "CONTRACT ID: ab-12\nVendor:  Acme & Sons, Inc.\nDate: 1/2/2024 and 03-04-24"
    r = ps.extract_contract_fields(spark.createDataFrame([(text,), ("nothing",)], "full_text string")).collect()
    assert r[0].contract_id == "ab-12" and r[0].vendor_name == "Acme & Sons, Inc."
    assert r[0].dates_found == ["1/2/2024", "03-04-24"]
    assert r[1].contract_id is None and r[1].vendor_name is None and r[1].dates_found is None


def test_normalize_shipments(spark):
    df = spark.createDataFrame([(1, 10, None, "x")], "`Shipment No` long, `ID` long, `Status` string, junk string")
    r = ps.normalize_shipments(df).collect()[0]
    assert r.shipment_id == 10 and r.status is None and "junk" not in r.asDict()
    no_id = spark.createDataFrame([("a",)], "Origin string")
    assert ps.normalize_shipments(no_id).count() == 0


def test_profile_and_records(spark):
    df = spark.createDataFrame([(1, None, 2.5), (2, "b", None)], "a long, b string, c double")
    prof = {r.column_name: (r.column_kind, r.null_count) for r in ps.sheet_profile(df, "s").collect()}
    assert prof == {"a": ("numeric", 0), "b": ("text", 1), "c": ("numeric", 1)}
    r = ps.records_to_text(df).orderBy("a").first()
    assert r.content == "a: 1\nb: None\nc: 2.5"
    one = ps.single_chunk(ps.records_to_text(df)).first()
    assert (one.chunk_index, one.total_chunks) == (0, 1)


def test_table_chunks_modes(spark):
    rows = spark.createDataFrame([(1, "s", 2, "b"), (1, "s", 1, "a"), (2, "s", 1, "c")],
                                 "doc long, sheet string, n long, v string")
    by_row = ps.table_chunks(rows, ["doc", "sheet"], ["n"], ["n", "v"], "row").orderBy("doc", "row_index").collect()
    assert [(r.doc, r.row_index) for r in by_row] == [(1, 0), (1, 1), (2, 0)]
    assert by_row[0].content == "| n | v |\n| --- | --- |\n| 1 | a |"
    by_sheet = {r.doc: r.content for r in ps.table_chunks(rows, ["doc", "sheet"], ["n"], ["n", "v"], "sheet").collect()}
    assert by_sheet[1] == "| n | v |\n| --- | --- |\n| 1 | a |\n| 2 | b |"
    import pytest
    with pytest.raises(ValueError):
        ps.table_chunks(rows, ["doc"], ["n"], ["n"], "page")


def test_join_pages_multi_block(spark):
    rows = [(1, p, f"p{p}" if p % 3 else "") for p in range(1, 11)]
    pages = spark.createDataFrame(rows, "document_id long, page long, text string")
    got = ps.join_pages(pages, block=2).first()
    assert got.full_text == "\n\n".join(f"p{p}" for p in range(1, 11) if p % 3)
    assert got.num_pages == 10


def test_select_sheets_and_bill_of_lading(spark):
    sheets = spark.createDataFrame([(1, 0, "lines"), (1, 1, "summary"), (2, 0, "lines")],
                                   "workbook long, sheet_index int, sheet_name string")
    assert ps.select_sheets(sheets, True).count() == 3
    assert sorted(r.sheet_name for r in ps.select_sheets(sheets, False).collect()) == ["lines", "lines"]
    pages = spark.createDataFrame([(7, 1, "BOL 123"), (7, 2, "Consignee: ACME")], "document_id long, page long, text string")
    tables = spark.createDataFrame([(7, 1, 0, [["item", "qty"], ["bolts", "5"]])],
                                   "document_id long, page long, table_index long, cells array<array<string>>")
    r = ps.bill_of_lading(pages, tables).first()
    assert r.document_type == "bill_of_lading" and r.full_text == "BOL 123\n\nConsignee: ACME"
    assert r.tables[0].markdown == "| item | qty |\n| --- | --- |\n| bolts | 5 |" and r.parsed_at is not None
