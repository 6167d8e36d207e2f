import json
from collections import Counter
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from tablespoon.operators.nested import flatten, nest, normalize_payload, parse_invoice_payload, split_document
from tablespoon.schemas import INVOICES, ORDERS
from tablespoon.sinks import land, land_lines, tables
from tablespoon.sources import read_days, read_document, read_master

ORDER_ROWS = [
    {"Id": "1", "Date": "2024-01-20", "BranchId": "b", "line_items": [
        {"Id": "l1", "BranchId": "own", "Quantity": 2, "OrderId": "wrong"}, {"Id": "l2", "Quantity": "1.5"}]},
    {"Id": "2", "Date": None, "line_items": []},
    {"Id": "3", "line_items": None},
    {"Id": "4", "TotalAmount": 12.50},
]


def landed(spark, tmp_path, rows, document=ORDERS, lines=True):
    path = tmp_path / document.file
    text = "\n".join(json.dumps(r, ensure_ascii=False) for r in rows) if lines else json.dumps(rows, ensure_ascii=False)
    path.write_text(text, encoding="utf-8")
    return read_document(spark, document, [str(path)])


@pytest.mark.parametrize("lines", [True, False])
def test_lines_and_arrays_read_alike(spark, tmp_path, lines):
    frames = split_document(landed(spark, tmp_path, ORDER_ROWS, lines=lines), ORDERS)
    assert {r["Id"] for r in frames["order_header"].collect()} == {"1", "2", "3", "4"}
    rows = {r["Id"]: r for r in frames["order_detail"].collect()}
    assert set(rows) == {"l1", "l2"}
    assert (rows["l1"]["OrderId"], rows["l1"]["BranchId"], rows["l1"]["OrderDate"]) == ("1", "b", "2024-01-20")
    assert (rows["l1"]["Quantity"], rows["l2"]["Quantity"]) == ("2", "1.5")


def test_empty_file_gives_no_rows(spark, tmp_path):
    assert landed(spark, tmp_path, [], lines=False).count() == 0


def test_arrays_land_as_lines(spark, tmp_path):
    """Arrays and lines mixed; fields outside any schema, nested arrays, escapes and digits stay."""
    documents = [{"Id": "a", "Extra": {"x": [1, [2]]}, "TotalAmount": 12345678.125}, {"Id": "é\n\"[", "OrderDetails": [{"Id": "l"}]}, {"Id": "c"}]
    folder = tmp_path / "arrays"
    folder.mkdir()
    (folder / "one.json").write_text("  " + json.dumps(documents[:2]) + "\n\n" + json.dumps(documents[2]) + "\n[]\n[null]\n")
    (folder / "two.json").write_text("")
    land_lines(spark, [str(folder)], f"{tmp_path}/lines")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/lines").collect()]
    assert sorted(lines, key=str) == sorted(documents, key=str)
    assert read_document(spark, ORDERS, [f"{tmp_path}/lines"]).count() == 3
    indented = tmp_path / "indented"
    indented.mkdir()
    (indented / "array.json").write_text("\n" + json.dumps(documents, indent=1))
    (indented / "object.json").write_text(json.dumps(documents[0], indent=1))
    land_lines(spark, [str(indented)], f"{tmp_path}/lines", multi_line=True)
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/lines").collect()]
    assert sorted(lines, key=str) == sorted([*documents, documents[0]], key=str)
    (folder / "two.json").write_text('[{"Id": "a"')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        land_lines(spark, [str(folder)], f"{tmp_path}/lines")


def test_indented_array_needs_multi_line(spark, tmp_path):
    path = tmp_path / "orders.json"
    path.write_text(json.dumps(ORDER_ROWS, indent=2))
    assert read_document(spark, ORDERS, [str(path)], multi_line=True).count() == 4


def test_malformed_json_fails(spark, tmp_path):
    path = tmp_path / "orders.json"
    path.write_text('{"Id": "1"}\n{"Id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_document(spark, ORDERS, [str(path)]).collect()


def test_invoice_children_take_over_header_fields(spark, tmp_path):
    rows = [{"RefId": "r1", "RefDate": "2024-01-20", "BranchId": "b", "CustomerId": "c", "CreatedDate": "x",
             "invoice_details": [{"RefDetailId": "d1", "RefID": "wrong", "BranchName": "own"}],
             "invoice_payments": [{"SAInvoicePaymentID": "p1", "CustomerID": "other", "Amount": 5}]}]
    frames = split_document(landed(spark, tmp_path, rows, INVOICES), INVOICES)
    detail, payment = frames["invoice_detail"].first(), frames["invoice_payment"].first()
    assert (detail["RefID"], detail["BranchName"], detail["CustomerId"]) == ("r1", None, "c")
    assert (payment["RefID"], payment["CustomerId"], payment["Amount"]) == ("r1", "c", "5")
    assert "invoice_details" not in frames["invoice_header"].columns


def test_missing_day_is_skipped(spark, tmp_path, caplog):
    day = tmp_path / "2024-01-20"
    day.mkdir()
    (day / "orders.json").write_text('[{"Id": "1"}]')
    (day / "invoices.json").write_text("[]")
    documents = read_days(spark, str(tmp_path), ["2024-01-19", "2024-01-20"])
    assert documents["order_header"].count() == 1 and documents["invoice_header"].count() == 0
    assert "2024-01-19" in caplog.text
    none = read_days(spark, str(tmp_path), ["2031-01-01"])
    assert none["order_header"].count() == 0 and none["order_header"].schema == ORDERS.landing()


def test_master_reads_whole_snapshots(spark, tmp_path):
    (tmp_path / "master").mkdir()
    (tmp_path / "master/products.json").write_text('[{"Id": "p", "Inactive": true, "Price": 3}]')
    (tmp_path / "master/customers.json").write_text('[{"Id": "c", "Name": "Nguyễn"}]', encoding="utf-8")
    frames = read_master(spark, str(tmp_path))
    assert frames["product"].first()["Inactive"] is True
    assert frames["customer"].first()["Name"] == "Nguyễn"


PAYLOADS = {
    '{"OrderDetails": [{"Id": "a"}, {"Id": "b"}]}': ["a", "b"], '  [{"Id": "a"}]': ["a"], "[]": [], "{}": [],
    '{"OrderDetails": null}': [], '{"OrderDetails": []}': [], "null": [], '"text"': [], "7": [], "": [], None: [],
    '{"Other": 1}': [],
}


def test_payload_shapes(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PAYLOADS)], "i int, p string")
    out = df.select("i", F.transform(normalize_payload(F.col("p")), lambda x: x["Id"]).alias("ids")).orderBy("i")
    assert [r["ids"] for r in out.collect()] == list(PAYLOADS.values())


def test_invoice_payload(spark):
    texts = ['{"SAInvoiceDetails": [{"RefDetailId": "d"}]}', "{}", None]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    out = df.select(*[F.size(c).alias(n) for n, c in parse_invoice_payload(F.col("p")).items()])
    assert [tuple(r) for r in out.collect()] == [(1, 0), (0, 0), (0, 0)]


def keyed(spark, keys, children):
    header = spark.createDataFrame([(k,) for k in keys], "Id string")
    rows = [(k, i, v) for i, (k, v) in enumerate(children)]
    return header, spark.createDataFrame(rows, "OrderId string, n int, v string")


def test_nest_without_children(spark):
    header, child = keyed(spark, ["a", None], [("z", "orphan"), (None, "lost")])
    rows = nest(header, {"line_items": child}, "Id", "OrderId").collect()
    assert sorted((r["Id"] or "", r["line_items"]) for r in rows) == [("", []), ("a", [])]


def test_nest_two_arrays(spark):
    header, child = keyed(spark, ["a"], [("a", "x"), ("a", "y")])
    other = spark.createDataFrame([("a", "p")], "OrderId string, pay string")
    row = nest(header, {"lines": child, "payments": other}, "Id", "OrderId").first()
    assert sorted(x["v"] for x in row["lines"]) == ["x", "y"] and [x["pay"] for x in row["payments"]] == ["p"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(children=hs.lists(hs.tuples(hs.sampled_from("abc"), hs.sampled_from("xy")), max_size=40), parts=hs.integers(1, 4))
def test_flatten_undoes_nest(spark, children, parts):
    header, child = keyed(spark, ["a", "b", "c", "d"], children)
    nested = nest(header, {"line_items": child.drop("n")}, "Id", "OrderId", parts=parts).cache()
    flat = flatten(nested, "line_items", {"OrderId": "Id"})
    assert Counter((r["OrderId"], r["v"]) for r in flat.collect()) == Counter(children)
    assert Counter(r["Id"] for r in nested.collect()) == dict.fromkeys("abcd", parts)  # whatever a header's size
    nested.unpersist()


def test_parts_share_a_large_group_even_if_all_copies(spark):
    copies = spark.range(30_000).select(F.lit("hot").alias("OrderId"), F.lit("same").alias("v"))
    distinct = spark.range(30_000).select(F.lit("warm").alias("OrderId"), F.col("id").cast("string").alias("v"))
    few = spark.createDataFrame([("cold", "v")], "OrderId string, v string")
    header = spark.createDataFrame([("hot",), ("warm",), ("cold",)], "Id string")
    nested = nest(header, {"line_items": copies.union(distinct).union(few)}, "Id", "OrderId", parts=20)
    sizes = {k: [] for k in ("hot", "warm", "cold")}
    for r in nested.select("Id", F.size("line_items").alias("n")).collect():
        sizes[r["Id"]].append(r["n"])
    assert all(len(x) == 20 for x in sizes.values())
    assert sum(sizes["hot"]) == sum(sizes["warm"]) == 30_000 and sum(sizes["cold"]) == 1
    assert max(sizes["hot"]) == 1500 and max(sizes["warm"]) < 1800
    tables = split_document(nested.withColumn("OrderDate", F.lit(None).cast("string")), replace(ORDERS, parents={"OrderId": "Id"}))
    assert tables["order_header"].count() == 3 and tables["order_detail"].count() == 60_001


def test_landed_days(spark, tmp_path):
    df = spark.createDataFrame([("1", "2024-01-20"), ("2", "2024-01-21")], "Id string, day string")
    land(df, f"{tmp_path}/orders.json", "day")
    land(df.filter("Id = '2'"), f"{tmp_path}/orders.json", "day")  # the same day again replaces it
    assert read_document(spark, ORDERS, [f"{tmp_path}/orders.json"]).count() == 2


def test_packed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PACKED_ROWS", 10)
    df = spark.range(25).select(F.col("id").cast("string").alias("Id")).coalesce(1)
    land(df, f"{tmp_path}/documents", packed=True)
    land_lines(spark, [f"{tmp_path}/documents"], f"{tmp_path}/lines", packed=True)
    for folder in ("documents", "lines"):
        assert len(list((tmp_path / folder).glob("*.json.gz" if folder == "documents" else "*.txt.gz"))) == 3
        assert {r["Id"] for r in spark.read.schema("Id string").json(f"{tmp_path}/{folder}").collect()} == {str(n) for n in range(25)}
