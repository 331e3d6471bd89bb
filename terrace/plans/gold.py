"""Gold: star schema (dimensions with surrogate keys, sales fact) and marts.

Join strategy: dimension lookups are plain equi-joins; AQE measures the
dimension side at runtime and broadcasts it only when it is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` — otherwise a sort-merge join,
with AQE splitting a skewed fact partition (one customer holding a third of
all sales) across tasks. No broadcast is forced: dimensions grow with the data.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import money
from terrace.functions.identity import surrogate_key
from terrace.operators.rank import dense_rank_within

DIM_CUSTOMER_COLUMNS = [
    "customer_key", "customer_id", "full_name", "email", "city", "country", "segment", "signup_date", "valid_from",
]
DIM_PRODUCT_COLUMNS = ["product_key", "product_id", "product_name", "category", "unit_cost", "list_price", "active"]
FACT_COLUMNS = [
    "sales_key", "order_id", "customer_key", "product_key", "order_date", "ordered_at", "quantity",
    "gross_amount", "discount_amount", "net_amount", "cost_amount", "margin_amount", "channel", "status", "currency",
]


def dim_customer(customers_history: DataFrame) -> DataFrame:
    """Current customer versions with a surrogate key."""
    return (
        customers_history.filter(F.col("is_current"))
        .withColumn("customer_key", surrogate_key("customer_id"))
        .select(*DIM_CUSTOMER_COLUMNS)
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.withColumn("product_key", surrogate_key("product_id")).select(*DIM_PRODUCT_COLUMNS)


#: What the fact takes from a dimension, by the flag of the reference check that finds the same row of it.
LOOKED_UP = {"_customer_exists": ["customer_key"], "_product_exists": ["product_key", "unit_cost"]}


def fact_sales(sales: DataFrame, dim_cust: DataFrame, dim_prod: DataFrame, natural_keys: Sequence[str] = ()) -> DataFrame:
    """Sales ⋈ customer keys ⋈ product keys and cost; cost and margin per line.

    Sales whose reference check has brought along what :data:`LOOKED_UP` names from these dimensions were joined with
    them there, so a join that is done is not done again: each sends every sale through another shuffle.

    ``natural_keys`` names dimension ids to show after the fact's columns. They are those the sale was joined by, so a caller
    that names the fact's rows by them needs no join of the fact with its dimensions on the surrogate keys.
    """
    customer, product = LOOKED_UP.values()
    joined = sales
    if not set(customer) <= set(sales.columns):
        joined = joined.join(dim_cust.select("customer_id", *customer), "customer_id")
    if not set(product) <= set(sales.columns):
        joined = joined.join(dim_prod.select("product_id", *product), "product_id")
    cost = money.amount(F.col("quantity") * F.col("unit_cost"))
    derived = {
        "sales_key": surrogate_key("order_id"),
        "cost_amount": cost,
        "margin_amount": money.amount(F.col("net_amount") - cost),
    }
    return joined.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FACT_COLUMNS], *natural_keys)


def _orders(distinct_orders: bool):
    # ``order_id`` is unique in the fact by construction (latest-per-key in Silver,
    # dimension keys unique) and gated by the ``order_id_unique`` check, so a plain
    # count equals the distinct count without the extra shuffle of every fact row
    # that a distinct aggregate needs. ``distinct_orders=True`` restores it.
    return F.count_distinct("order_id") if distinct_orders else F.count("order_id")


def daily_sales(fact: DataFrame, distinct_orders: bool = False) -> DataFrame:
    """Date × channel: orders, units, gross, discounts, net, margin, average order value."""
    return fact.groupBy("order_date", "channel").agg(
        _orders(distinct_orders).alias("orders"),
        F.sum("quantity").alias("units"),
        money.round_sum("gross_amount").alias("gross_revenue"),
        money.round_sum("discount_amount").alias("discounts"),
        money.round_sum("net_amount").alias("net_revenue"),
        money.round_sum("margin_amount").alias("gross_margin"),
        money.rounded_average("net_amount").alias("average_order_value"),
    )


def customer_360(
    fact: DataFrame, dim_cust: DataFrame, as_of: _dt.date, distinct_orders: bool = False
) -> DataFrame:
    """Per customer: lifetime orders/value, last order, average, distinct products,
    recency (days before ``as_of``) and value band. Customers without sales are absent."""
    per_customer = fact.groupBy("customer_key").agg(
        _orders(distinct_orders).alias("lifetime_orders"),
        money.round_sum("net_amount").alias("lifetime_value"),
        F.max("ordered_at").alias("last_order_at"),
        money.rounded_average("net_amount").alias("average_order_value"),
        F.count_distinct("product_key").alias("distinct_products"),
    )
    return per_customer.join(dim_cust, "customer_key").select(
        "*",
        F.datediff(F.lit(as_of), F.to_date("last_order_at")).alias("days_since_last_order"),
        money.value_band("lifetime_value").alias("value_band"),
    )


def product_totals(fact: DataFrame, dim_prod: DataFrame, distinct_orders: bool = False) -> DataFrame:
    """Per product: orders, units, net revenue, margin, with the product dimension."""
    per_product = fact.groupBy("product_key").agg(
        _orders(distinct_orders).alias("orders"),
        F.sum("quantity").alias("units_sold"),
        money.round_sum("net_amount").alias("net_revenue"),
        money.round_sum("margin_amount").alias("gross_margin"),
    )
    return per_product.join(dim_prod, "product_key")


def rank_in_category(totals: DataFrame) -> DataFrame:
    """Dense revenue rank inside each category (distributed; see ``operators.rank``)."""
    return dense_rank_within(totals, "category", "net_revenue", "revenue_rank_in_category")


def product_performance(fact: DataFrame, dim_prod: DataFrame, distinct_orders: bool = False) -> DataFrame:
    """Per product: orders, units, net revenue, margin, and dense revenue rank in category."""
    return rank_in_category(product_totals(fact, dim_prod, distinct_orders))
