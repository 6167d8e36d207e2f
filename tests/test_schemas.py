from pyspark.sql import types as T

from tablespoon.schemas import INVOICES, ORDERS, SPECS, snake_case, specs_from_config


def test_naming_rule():
    assert [snake_case(n) for n in ("RefDetailId", "RefID", "VATAmount", "OrderDetailID", "Id")] == [
        "ref_detail_id", "ref_id", "vat_amount", "order_detail_id", "id",
    ]


def test_exceptions_to_the_rules():
    assert SPECS["order_header"].columns["BranchId"] == "brand_id"
    assert SPECS["order_detail"].columns["BranchId"] == "branch_id"
    assert SPECS["invoice_detail"].columns["SAInvoicePromotionAmount"] == "sainvoice_promotion_amount"
    assert SPECS["order_header"].types["order_status"] == "text"
    assert SPECS["invoice_header"].types["payment_status"] == "int4"
    assert SPECS["product"].types["inactive"] == "bool"


def test_seven_tables_and_keys():
    assert {n: s.key for n, s in SPECS.items()} == {
        "order_header": "order_id", "order_detail": "order_detail_id", "invoice_header": "ref_id",
        "invoice_detail": "ref_detail_id", "invoice_payment": "invoice_payment_id",
        "product": "product_id", "customer": "customer_id",
    }
    assert all(s.key in s.columns.values() for s in SPECS.values())
    assert [len(SPECS[n].columns) for n in SPECS] == [12, 10, 33, 23, 10, 10, 5]


def test_bronze_schema_ends_with_partitions():
    names = SPECS["invoice_payment"].bronze.names
    assert names[-5:] == ["DateFormat", "report_date", "year", "month", "day"]
    assert "DateFormat" not in SPECS["product"].bronze.names
    assert SPECS["invoice_detail"].bronze["quantity"].dataType == T.LongType()


def test_documents_nest_child_tables():
    assert ORDERS.landing()["line_items"].dataType.elementType.names == SPECS["order_detail"].landing.names
    assert INVOICES.landing().names[-3:] == ["CreatedDate", "invoice_details", "invoice_payments"]


def test_registry_from_config():
    config = {
        "Schema": {"order_header": {"Id": "string", "TotalAmount": "float64", "Extra": "int64", "DateFormat": "string"}},
        "Column-Renaming": {"order_header": {"Id": "order_id", "TotalAmount": "total", "Note": "note"}},
        "Target-Schema": {"order_header": {"order_id": "text", "total": "float4"}},
        "Key-Column": {"order_header": "order_id"},
        "Partition-Column": {"order_header": ["year"]},
    }
    spec = specs_from_config(config)["order_header"]
    assert spec.columns == {"Id": "order_id", "TotalAmount": "total", "Note": "note"}
    assert spec.types == {"order_id": "text", "total": "float4", "note": "text"}
    assert set(spec.raw.names) == {"Id", "TotalAmount", "Note", "Extra"}
    assert spec.key == "order_id" and spec.partitions == ("year",)


def test_session_sizing():
    from tablespoon.session import sizing

    small, large = sizing(1 << 20, 8), sizing(100 << 40, 8000)
    assert small == {"spark.sql.shuffle.partitions": "8", "spark.sql.files.maxPartitionBytes": str(128 << 20)}
    assert int(large["spark.sql.shuffle.partitions"]) * (256 << 20) == 100 << 40
    bounded = sizing(100 << 40, 8000, max_tasks=200_000)
    assert int(bounded["spark.sql.shuffle.partitions"]) == 200_000
    assert (100 << 40) // int(bounded["spark.sql.files.maxPartitionBytes"]) <= 200_000
