import datetime as dt

from pyspark.sql import functions as F

from tablespoon.operators import standardize as st
from tablespoon.plans.transform import transform
from tablespoon.schemas import SPECS

RUN = dt.datetime(2024, 1, 20, 20, tzinfo=dt.timezone.utc)  # the 21st in the local zone


def branches(spark, rows, branch_map, schema="Id int, BranchId string, BranchName string"):
    df = st.branch_enrich(spark.createDataFrame(rows, schema), branch_map)
    return {r["Id"]: r["BranchName"] for r in df.collect()}


def test_branch_names(spark):
    rows = [
        (1, "AB-1", "own"), (2, "  ab-1 \n", None), (3, "zz", "own"), (4, "zz", None),
        (5, None, "own"), (6, None, None), (7, "e", "own"), (8, "none", "own"),
    ]
    branch_map = {" Ab-1 ": "Central", "e": "", "None": "trap"}
    assert branches(spark, rows, branch_map) == {
        1: "Central", 2: "Central", 3: "own", 4: "zz", 5: "own", 6: None, 7: "", 8: "trap",
    }
    assert branches(spark, rows, {}) == {
        1: "own", 2: "  ab-1 \n", 3: "own", 4: "zz", 5: "own", 6: None, 7: "own", 8: "own",
    }


def test_branch_columns_may_be_missing(spark):
    assert branches(spark, [(1, "x"), (2, "y")], {"x": "X"}, "Id int, BranchId string") == {1: "X", 2: "y"}
    untouched = st.branch_enrich(spark.createDataFrame([(1,)], "Id int"), {"x": "X"})
    assert untouched.columns == ["Id"]


def test_branch_ids_that_differ_in_case_alone(spark):
    assert branches(spark, [(1, "x", None), (2, "y", None)], {"x": "X", " X ": "last", "y": "Y"}) == {1: "last", 2: "Y"}


def test_date_field_is_chosen_by_presence_not_by_value(spark):
    df = spark.createDataFrame([(None, "2024-01-20")], "Date string, RefDate string")
    assert st.pick_date_column(df.columns) == "Date"
    assert st.add_business_date(df).first()["DateFormat"] is None
    assert st.pick_date_column(["created_at", "OrderDate"]) == "OrderDate"
    assert st.pick_date_column(["Id"]) is None


def test_business_date_replaces_a_landed_one(spark):
    df = spark.createDataFrame([("2024-01-20T20:00:00Z", "landed")], "Date string, DateFormat string")
    assert st.add_business_date(df).first()["DateFormat"] == "2024-01-21"


def test_rename_keeps_mapped_and_system_columns(spark):
    df = spark.createDataFrame([("1", "p", "x")], "Id string, ProcessDate string, Other string")
    renamed = st.rename_project(df, SPECS["customer"])
    assert set(renamed.columns) == {"customer_id", "customer_name", "customer_tel", "customer_code", "address", "ProcessDate"}
    assert renamed.first()["customer_name"] is None
    assert st.rename_project(df, None).columns == df.columns


def test_unknown_token_changes_nothing(spark):
    df = spark.createDataFrame([(True,)], "inactive boolean")
    assert st.cast_table(df, SPECS["product"]).first()["inactive"] is True


def header(spark, rows):
    return spark.createDataFrame(rows, "Id string, Date string")


def test_partitions_from_business_date(spark):
    rows = [("1", "2024-01-20T20:00:00Z"), ("2", "2024-01-20T10:00:00Z"), ("3", None), ("4", "20/01/2024")]
    df = transform(header(spark, rows), "order_header", RUN)
    parts = {r["order_id"]: (r["report_date"], r["year"], r["month"], r["day"]) for r in df.collect()}
    assert parts == {
        "1": ("2024-01-21", 2024, 1, 21), "2": ("2024-01-20", 2024, 1, 20),
        "3": ("1970-01-01", 0, 0, 0), "4": ("1970-01-01", 0, 0, 0),
    }


def test_table_with_every_date_null_is_undated_not_today(spark):
    df = transform(header(spark, [("1", None)]), "order_header", RUN)
    assert df.first()["report_date"] == "1970-01-01"
    no_field = spark.createDataFrame([("1",)], "Id string")  # the mapped date column is added as null
    row = transform(no_field, "order_header", RUN).first()
    assert (row["report_date"], row["year"]) == ("1970-01-01", 0)


def test_fallback_date_is_shifted_once(spark):
    df = spark.createDataFrame([("1", None, "2024-01-20T20:00:00Z")], "RefId string, Date string, RefDate string")
    row = transform(df, "invoice_header", RUN).first()
    assert row["DateFormat"] is None
    assert row["ref_date"] == dt.datetime(2024, 1, 21, 3)
    assert row["report_date"] == "2024-01-21"


def test_one_business_date_switches_the_fallback_off(spark):
    rows = [("1", None, "2024-01-20T20:00:00Z"), ("2", "2024-01-01", "2024-01-20T20:00:00Z")]
    df = transform(spark.createDataFrame(rows, "RefId string, Date string, RefDate string"), "invoice_header", RUN)
    assert {r["ref_id"]: r["report_date"] for r in df.collect()} == {"1": "1970-01-01", "2": "2024-01-01"}


def test_no_date_column_at_all_is_the_day_of_the_run(spark):
    df = transform(spark.createDataFrame([("1",)], "code string"), "unmapped", RUN)
    assert df.first().asDict() == {"code": "1", "report_date": "2024-01-21", "year": 2024, "month": 1, "day": 21}


def test_unmapped_table_with_text_date_column(spark):
    df = transform(spark.createDataFrame([("2024-01-20T20:00:00Z",)], "created_at string"), "unmapped", RUN)
    assert df.first()["report_date"] == "2024-01-21"


def test_master_tables_get_the_day_of_the_run(spark):
    df = spark.createDataFrame([("1", "2020-01-01")], "Id string, Date string")
    assert transform(df, "customer", RUN).first()["report_date"] == "2024-01-21"
    assert st.local_day(dt.datetime(2024, 1, 20, 20)) == dt.date(2024, 1, 21)


def test_empty_input_keeps_the_schema(spark):
    df = transform(spark.createDataFrame([], SPECS["invoice_detail"].landing), "invoice_detail", RUN)
    assert df.count() == 0
    assert df.select(SPECS["invoice_detail"].bronze.names).schema.simpleString() == SPECS["invoice_detail"].bronze.simpleString()


def test_every_table_has_its_stored_schema(spark):
    for name, spec in SPECS.items():
        out = transform(spark.createDataFrame([], spec.landing), name, RUN)
        assert {(f.name, f.dataType) for f in out.schema} == {(f.name, f.dataType) for f in spec.bronze}, name


def test_typed_values(spark):
    df = spark.createDataFrame(
        [("d1", "1.7", "12.5", "2024-01-20", None)], "RefDetailId string, Quantity string, Amount string, RefDate string, TaxAmount string"
    )
    row = transform(df, "invoice_detail", RUN).first()
    assert (row["quantity"], row["amount"], row["tax_amount"], row["item_id"]) == (1, 12.5, 0.0, None)
    assert row["ref_date"] == dt.datetime(2024, 1, 20, 7)


def test_no_extra_pass_when_date_columns_share_a_field(spark):
    df = transform(header(spark, [("1", "2024-01-20")]), "order_header", RUN)
    assert "scalar-subquery" not in df._jdf.queryExecution().analyzed().toString()
    assert df.filter(F.col("year") == 2024).count() == 1
