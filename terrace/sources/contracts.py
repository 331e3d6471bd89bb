"""Source contracts: explicit schemas for the three landing feeds.

Schemas are declared, never inferred. A contract names the columns and the types
that Silver gives them; the landing files are read as text (:func:`landing_schema`),
so Bronze holds what the source sent, digit by digit, and a line that cannot be read
keeps its whole text in ``_corrupt_record``. Money is DECIMAL; dates and times are
parsed in Silver too. ``batch_date`` is the delivery partition column of the landing
layout ``<entity>/batch_date=YYYY-MM-DD/``.

The columns and types of the three contracts are fixed values, set by the source systems.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from terrace.functions.money import PRICE, RATE

CUSTOMER_CONTRACT = StructType(
    [
        StructField("customer_id", StringType()),
        StructField("full_name", StringType()),
        StructField("email", StringType()),
        StructField("city", StringType()),
        StructField("country", StringType()),
        StructField("segment", StringType()),
        StructField("signup_date", StringType()),
        StructField("updated_at", StringType()),
    ]
)

PRODUCT_CONTRACT = StructType(
    [
        StructField("product_id", StringType()),
        StructField("product_name", StringType()),
        StructField("category", StringType()),
        StructField("unit_cost", PRICE),
        StructField("list_price", PRICE),
        StructField("active", BooleanType()),
        StructField("updated_at", StringType()),
    ]
)

ORDER_CONTRACT = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("product_id", StringType()),
        StructField("ordered_at", StringType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", PRICE),
        StructField("discount_pct", RATE),
        StructField("channel", StringType()),
        StructField("status", StringType()),
        StructField("currency", StringType()),
    ]
)

CONTRACTS = {
    "customers": CUSTOMER_CONTRACT,
    "products": PRODUCT_CONTRACT,
    "orders": ORDER_CONTRACT,
}

# Landing formats per entity (fixed by the source systems).
FORMATS = {"customers": "csv", "products": "json", "orders": "csv"}

# Logical source-system names stamped into Bronze.
SOURCE_SYSTEMS = {"customers": "crm_csv", "products": "product_json", "orders": "commerce_csv"}

PARTITION_COLUMN = "batch_date"

# Where a line goes that does not parse.
CORRUPT = "_corrupt_record"


def with_partition(contract: StructType) -> StructType:
    """Contract plus the typed delivery partition column."""
    return StructType(list(contract.fields) + [StructField(PARTITION_COLUMN, DateType())])


def landing_schema(entity: str) -> StructType:
    """Every contract column as text, the text of an unreadable line, and the typed partition column."""
    text = [StructField(f.name, StringType()) for f in CONTRACTS[entity].fields]
    return with_partition(StructType([*text, StructField(CORRUPT, StringType())]))


def source_columns(entity: str) -> list[str]:
    return [f.name for f in CONTRACTS[entity].fields]
