"""Headers with child arrays: flattening, nesting, and mixed payload shapes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespoon.schemas import INGEST_COLUMN, SPECS, Document, TableSpec


def flatten(df: DataFrame, array: str, parents: Mapping[str, str]) -> DataFrame:
    """One row per child. Fields taken over from the header win over the child's
    own, also where the header lacks the field, which gives null. A null, missing
    or empty array gives no row. Narrow: no shuffle."""
    taken = {name.lower() for name in parents}
    own = [f for f in df.schema[array].dataType.elementType.names if f.lower() not in taken]
    exploded = df.select(
        *[
            (F.col(header) if header in df.columns else F.lit(None).cast("string")).alias(f"_{i}")
            for i, header in enumerate(parents.values())
        ],
        F.explode(array).alias("_child"),
    )
    return exploded.select(
        *[F.col("_child").getField(f).alias(f) for f in own],
        *[F.col(f"_{i}").alias(name) for i, name in enumerate(parents)],
    )


def split_document(df: DataFrame, document: Document) -> dict[str, DataFrame]:
    """One nested frame into one frame per table, still with landed field names.
    Children say, like their header, which landed copy they are of. Of a header
    nested in parts the first part gives the header row."""
    parents = {**document.parents, **{c: c for c in (INGEST_COLUMN,) if c in df.columns}}
    children = {table: flatten(df, array, parents) for array, table in document.children.items()}
    header = df.filter("part = 0").drop("part") if "part" in df.columns else df
    return {document.header: header.drop(*document.children), **children}


def nest(header: DataFrame, children: Mapping[str, DataFrame], key: str, parent_key: str, parts: int = 1) -> DataFrame:
    """Puts child rows into arrays beside their header, one row per header.

    ``children`` maps the array name to a frame that has ``parent_key``, which
    refers to ``key`` of the header. A header without children gets empty arrays.
    A row holds all children of its header, as the document it stands for does.
    Where headers have more than fits into a row, the caller asks for ``parts``:
    every header then has that many rows, numbered by ``part``, whatever its
    size, and its children are dealt over them by their content. Flattening the
    result gives back exactly the children.
    """
    rows = header if parts == 1 else header.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    for name, child in children.items():
        row = F.struct(*[F.col(c) for c in child.columns]).alias(name)
        of = child.select(F.col(parent_key).alias("_key"), row).filter(F.col("_key").isNotNull())
        if parts == 1:
            grouped = of.groupBy("_key").agg(F.collect_list(name).alias(name))
            rows = rows.join(grouped, rows[key] == F.col("_key"), "left").drop("_key")
        else:
            grouped = _dealt(of, name, parts).groupBy("_key", F.col("part").alias("_part")).agg(F.collect_list(name).alias(name))
            matches = (rows[key] == F.col("_key")) & (rows["part"] == F.col("_part"))
            rows = rows.join(grouped, matches, "left").drop("_key", "_part")
    empty = {name: F.coalesce(F.col(name), F.array().cast(rows.schema[name].dataType)) for name in children}
    return rows.withColumns(empty)


def _dealt(children: DataFrame, name: str, parts: int) -> DataFrame:
    """Children with the ``part`` each goes to, by its content. Equal copies are
    counted first and dealt round the parts, so copies of one child spread as
    well. Nothing depends on row order, so a task that is run again deals the
    same way."""
    counted = children.groupBy("_key", name).count()
    dealt = counted.withColumn("_turn", F.explode(F.sequence(F.lit(0), F.least(F.col("count"), F.lit(parts)).cast("int") - 1)))
    share = F.floor((F.col("count") - F.col("_turn") - 1) / parts) + 1
    return dealt.select(
        "_key",
        name,
        F.pmod(F.xxhash64(name) + F.col("_turn"), F.lit(parts)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(1), share.cast("int"))).alias("_copy"),
    )


def normalize_payload(payload: Column, item: TableSpec = SPECS["order_detail"]) -> Column:
    """Detail payload text to an array of items: an object holding
    ``OrderDetails``, a bare list, or anything else, which gives no items. A bare
    list is put into such an object as text, so that any payload is parsed once."""
    items = f"array<{item.landing.simpleString()}>"
    held = F.when(F.ltrim(payload).startswith("["), F.concat(F.lit('{"OrderDetails":'), payload, F.lit("}"))).otherwise(payload)
    parsed = F.from_json(held, f"struct<OrderDetails:{items}>").getField("OrderDetails")
    return F.coalesce(parsed, F.array().cast(items))


def parse_invoice_payload(payload: Column, specs: Mapping[str, TableSpec] = SPECS) -> dict[str, Column]:
    """Child arrays out of an invoice payload text, by the name they land under;
    a list that is missing is empty."""
    arrays = {
        "invoice_details": ("SAInvoiceDetails", specs["invoice_detail"]),
        "invoice_payments": ("SAInvoicePayments", specs["invoice_payment"]),
    }
    types = {landed: f"array<{spec.landing.simpleString()}>" for landed, (_, spec) in arrays.items()}
    fields = ", ".join(f"{field}: {types[landed]}" for landed, (field, _) in arrays.items())
    parsed = F.from_json(payload, f"struct<{fields}>")
    return {
        landed: F.coalesce(parsed.getField(field), F.array().cast(types[landed]))
        for landed, (field, _) in arrays.items()
    }
