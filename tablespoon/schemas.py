"""Table registry: what lands, what each table keeps, and how columns are typed.

Every downstream step is driven by a :class:`TableSpec`. Table column names
follow one rule (snake case of the landed name) and types follow another (from
the landed type); only the exceptions to either rule are listed. A deployment
that keeps its own mapping in a JSON config builds the same registry with
:func:`specs_from_config`.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Type tokens understood by the caster.
FLOAT_TOKENS = ("float", "float4", "float8", "float64")
INT_TOKENS = ("int", "int4", "int8", "int64")
TIMESTAMP_TOKENS = ("timestamp",)
STRING_TOKENS = ("string", "text")

# Columns kept besides the mapped ones.
SYSTEM_COLUMNS = ("DateFormat", "ProcessDate")

# Tables stamped with the load date instead of a data date.
MASTER_TABLES = ("customer", "product", "branch")

PARTITION_COLUMNS = ("year", "month", "day")

# Which landed copy of a document a row came from: its load, the day it landed
# and its content, with dashes between.
INGEST_COLUMN = "ingest_id"

_LANDED_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int64": T.LongType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
}
_TOKEN_OF_TYPE = {"string": "text", "bigint": "int4", "double": "float4", "boolean": "bool"}
_TYPE_OF_TOKEN: dict[str, T.DataType] = {
    **{t: T.DoubleType() for t in FLOAT_TOKENS},
    **{t: T.LongType() for t in INT_TOKENS},
    **{t: T.TimestampNTZType() for t in TIMESTAMP_TOKENS},
    **{t: T.StringType() for t in STRING_TOKENS},
    "bool": T.BooleanType(),
}


def snake_case(name: str) -> str:
    """``RefDetailId`` -> ``ref_detail_id``, ``VATAmount`` -> ``vat_amount``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


@dataclass(frozen=True)
class TableSpec:
    name: str
    raw: T.StructType  # landed fields, in landed order
    columns: Mapping[str, str]  # landed name -> table column, the ones kept
    types: Mapping[str, str]  # table column -> type token
    key: str
    partitions: tuple[str, ...] = PARTITION_COLUMNS

    @property
    def is_master(self) -> bool:
        return self.name in MASTER_TABLES

    @property
    def landing(self) -> T.StructType:
        """Read schema: numbers are read as text, so ``"1.7"`` and ``1.7`` land
        alike and only the caster decides what a bad value becomes."""
        return T.StructType(
            [
                T.StructField(f.name, f.dataType if isinstance(f.dataType, T.BooleanType) else T.StringType())
                for f in self.raw.fields
            ]
        )

    @property
    def bronze(self) -> T.StructType:
        """Schema of the stored table, partition columns last."""
        kept = [
            T.StructField(self.columns[f.name], _TYPE_OF_TOKEN[self.types[self.columns[f.name]]])
            for f in self.raw.fields
            if f.name in self.columns
        ]
        dated = [] if self.is_master else [T.StructField("DateFormat", T.StringType())]
        stamp = [T.StructField("report_date", T.StringType())]
        parts = [T.StructField(p, T.IntegerType()) for p in self.partitions]
        return T.StructType(kept + dated + stamp + parts)

    @property
    def stored(self) -> T.StructType:
        """What the jobs store: rows also say which landed copy they are of."""
        return T.StructType(self.bronze.fields + [T.StructField(INGEST_COLUMN, T.StringType())])


def _struct(fields: Mapping[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _LANDED_TYPES[token]) for name, token in fields.items()])


def _spec(name: str, key: str, raw: str, dropped: str = "", named: dict | None = None, typed: dict | None = None):
    schema = _struct(dict(f.split() for f in raw.split(",")))
    drop, named, typed = set(dropped.split()), named or {}, typed or {}
    kept = [f for f in schema.fields if f.name not in drop]
    columns = {f.name: named.get(f.name, snake_case(f.name)) for f in kept}
    types = {columns[f.name]: typed.get(f.name, _TOKEN_OF_TYPE[f.dataType.simpleString()]) for f in kept}
    return TableSpec(name, schema, columns, types, key)


# Landed fields per table with their declared types, the fields
# that are not carried over, and the exceptions to the naming and typing rules.
_SPECS = [
    _spec(
        "order_header",
        key="order_id",
        raw="""CustomerTel string, Date string, CustomerName string, Status bigint, No double,
               TotalAmount double, ShippingAddress string, CustomerId string, Type bigint,
               EmployeeId string, Id string, DeliveryAmount double, BranchId string,
               BranchName string, DepositAmount double""",
        dropped="No DeliveryAmount DepositAmount",
        named={"Id": "order_id", "BranchId": "brand_id", "Date": "order_date",
               "Type": "order_type", "Status": "order_status"},
        typed={"Date": "timestamp", "Status": "text"},
    ),
    _spec(
        "order_detail",
        key="order_detail_id",
        raw="""Quantity double, Status bigint, OrderDate string, UnitId string, ItemName string,
               SortOrder bigint, Price double, OrderId string, ItemId string, Amount double,
               Id string, UnitName string, BranchId string, BranchName string""",
        dropped="Status UnitId SortOrder BranchName",
        named={"Id": "order_detail_id"},
        typed={"Quantity": "int4", "OrderDate": "timestamp"},
    ),
    _spec(
        "invoice_header",
        key="ref_id",
        raw="""RefId string, TipAmount double, CardAmount double, EmployeeId string, VATRate double,
               UsedPoint bigint, CustomerTel string, EmployeeName string, PaymentStatus string,
               AddPoint bigint, SaleAmount double, ServiceRate double, RefNo string,
               ReturnAmount double, NumberOfPeople bigint, ServiceTaxRate double,
               DeliveryAmount double, CashAmount double, DebitAmount double, CancelBy string,
               CustomerId string, VoucherAmount double, ReceiveAmount double,
               DiscountAmount double, PromotionAmount double, PromotionName string,
               TotalItemAmountAfterTax double, PromotionRate double, ServiceAmount double,
               DeliveryTaxRate double, CancelReason string, RefType string, Amount double,
               RefDate string, TotalItemAmount double, PromotionItemsAmount double,
               CustomerName string, TotalItem bigint, VATAmount double, Description string,
               OrderType string, AvailablePoint bigint, BranchId string, BranchName string,
               TotalAmount double, DepositAmount double""",
        dropped="""VATRate ServiceRate ReturnAmount ServiceTaxRate DebitAmount CancelBy ReceiveAmount
                   TotalItemAmountAfterTax PromotionRate DeliveryTaxRate Amount AvailablePoint
                   DepositAmount""",
        typed={"PaymentStatus": "int4", "RefType": "int4", "OrderType": "int4", "RefDate": "timestamp"},
    ),
    _spec(
        "invoice_detail",
        key="ref_detail_id",
        raw="""RefDetailId string, RefID string, ItemName string, TaxAmount double,
               PromotionAmount double, PreTaxAmount double, InventoryItemType bigint,
               SortOrder bigint, Quantity double, RefDetailType bigint,
               SAInvoicePromotionAmount double, IsItemByTime boolean, ParentID string,
               PromotionName string, AllocationAmount double, OrderDetailID string, ItemID string,
               UnitID string, IsSeftPrice boolean, PromotionRate double, PromotionType bigint,
               DiscountRate double, ItemCode string, Amount double, UnitPrice double,
               UnitName string, RefDate string, BranchId string, BranchName string,
               CustomerId string, AllocationDeliveryPromotionAmount double""",
        dropped="""InventoryItemType SortOrder IsItemByTime ParentID UnitID IsSeftPrice
                   PromotionRate DiscountRate""",
        named={"SAInvoicePromotionAmount": "sainvoice_promotion_amount"},
        typed={"Quantity": "int4", "RefDate": "timestamp", "AllocationDeliveryPromotionAmount": "float"},
    ),
    _spec(
        "invoice_payment",
        key="invoice_payment_id",
        raw="""CustomerName string, VoucherDrinkAmount double, Amount double, PaymentName string,
               RefID string, CardName string, CustomerID string, ExchangeRate double,
               CardNo string, CardID string, PaymentType bigint, ApprovalCode string,
               ExchangeAmount double, SAInvoicePaymentID string, ApplyVoucherType bigint,
               VoucherFoodAmount double, VoucherAllAmount double, RefDate string,
               BranchId string, BranchName string""",
        dropped="""CustomerName VoucherDrinkAmount CustomerID ExchangeRate CardID ApprovalCode
                   ExchangeAmount ApplyVoucherType VoucherFoodAmount VoucherAllAmount""",
        named={"SAInvoicePaymentID": "invoice_payment_id"},
        typed={"RefDate": "timestamp"},
    ),
    _spec(
        "product",
        key="product_id",
        raw="""Code string, IsSeftPrice boolean, Name string, Inactive boolean, Id string,
               CategoryName string, CategoryID string, ItemType bigint, Price double,
               AllowAdjustPrice boolean, Description string, UnitName string, UnitID string,
               BranchId string, BranchName string""",
        dropped="IsSeftPrice ItemType AllowAdjustPrice Description BranchId",
        named={"Id": "product_id", "Name": "product_name", "Code": "product_code"},
    ),
    _spec(
        "customer",
        key="customer_id",
        raw="""Address string, Code string, Inactive boolean, Name string, Id string,
               NormalizedTel string, Tel string, OriginalBranchId string, BranchId string,
               BranchName string""",
        dropped="Inactive Tel OriginalBranchId BranchId BranchName",
        named={"Id": "customer_id", "Name": "customer_name", "NormalizedTel": "customer_tel",
               "Code": "customer_code"},
    ),
]

SPECS: dict[str, TableSpec] = {s.name: s for s in _SPECS}


@dataclass(frozen=True)
class Document:
    """A landed document: a header table with child arrays nested inside."""

    file: str
    header: str
    children: Mapping[str, str] = field(default_factory=dict)  # array field -> table
    parents: Mapping[str, str] = field(default_factory=dict)  # child field -> header field
    extra: tuple[str, ...] = ()

    def landing(self, specs: Mapping[str, TableSpec] = SPECS) -> T.StructType:
        """Read schema of the whole document."""
        text = [T.StructField(n, T.StringType()) for n in self.extra]
        arrays = [
            T.StructField(array, T.ArrayType(specs[table].landing)) for array, table in self.children.items()
        ]
        return T.StructType(specs[self.header].landing.fields + text + arrays)


# File names, array names and the header fields that every child takes over.
ORDERS = Document(
    "orders.json",
    "order_header",
    children={"line_items": "order_detail"},
    parents={"OrderId": "Id", "OrderDate": "Date", "BranchId": "BranchId", "BranchName": "BranchName"},
)
INVOICES = Document(
    "invoices.json",
    "invoice_header",
    children={"invoice_details": "invoice_detail", "invoice_payments": "invoice_payment"},
    parents={
        "RefID": "RefId",
        "RefDate": "RefDate",
        "BranchId": "BranchId",
        "BranchName": "BranchName",
        "CustomerId": "CustomerId",
    },
    extra=("CreatedDate",),
)
PRODUCTS = Document("products.json", "product")
CUSTOMERS = Document("customers.json", "customer")


def specs_from_config(config: Mapping) -> dict[str, TableSpec]:
    """Registry from a JSON config with the sections ``Schema``, ``Column-Renaming``,
    ``Target-Schema``, ``Key-Column`` and ``Partition-Column``, one entry per table."""
    specs = {}
    for table, renames in config.get("Column-Renaming", {}).items():
        listed = config.get("Schema", {}).get(table, {})
        declared = {name: token for name, token in listed.items() if name not in SYSTEM_COLUMNS}
        raw = _struct({**dict.fromkeys(renames, "string"), **declared})
        target = config.get("Target-Schema", {}).get(table, {})
        types = {
            renames[f.name]: target.get(renames[f.name], _TOKEN_OF_TYPE[f.dataType.simpleString()])
            for f in raw.fields
            if f.name in renames
        }
        key = config.get("Key-Column", {}).get(table, "")
        partitions = config.get("Partition-Column", {}).get(table, PARTITION_COLUMNS)
        specs[table] = TableSpec(table, raw, dict(renames), types, key, tuple(partitions))
    return specs
