"""Print the physical plans of the key operators over Parquet-backed Bronze.

Usage: python tools/plans.py [sf_dir] > plans.txt

Bronze tables are first written as Parquet into the checkpoint folder, so the
scans are real file scans (pushdown and pruning visible), as in production.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from terrace.operators.dedupe import latest_per_key  # noqa: E402
from terrace.operators.merge import upsert  # noqa: E402
from terrace.operators.scd2 import apply_scd2, first_load  # noqa: E402
from terrace.plans import gold as G  # noqa: E402
from terrace.plans import silver as S  # noqa: E402
from terrace.session import fresh_path, local_session  # noqa: E402
from terrace.sources import fixtures as X  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()

    def parquet(df, name):
        path = fresh_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    bo = parquet(X.bronze_orders(spark, sf), "bronze-orders")
    bc = parquet(X.bronze_customers(spark, sf, 1), "bronze-customers")
    bp = parquet(X.bronze_products(spark, sf, 1), "bronze-products")
    hist = parquet(first_load(S.customers_incoming(S.customers_classified(bc)), X.DAY1), "customers")
    products = parquet(S.products_valid(S.products_classified(bp)), "products")
    sales = parquet(S.sales_rows(S.orders_classified(S.orders_checked(bo, hist, products))), "sales")
    dc, dp = G.dim_customer(hist), G.dim_product(products)
    fact = parquet(G.fact_sales(sales, dc, dp), "fact")
    day2 = S.customers_incoming(S.customers_classified(X.bronze_customers(spark, sf, 2)))
    plans = {
        "latest_per_key": latest_per_key(bo, "order_id").select("order_id", "quantity"),
        "orders_classified": S.orders_classified(S.orders_checked(bo, hist, products)).select(
            "order_id", "_quarantine_reason"),
        "upsert_small_delivery": upsert(sales, sales.filter(F.col("order_date") >= "1998-08-01"), "order_id"),
        "scd2_apply": apply_scd2(hist, day2, "customer_id", X.DAY2),
        "fact_sales": G.fact_sales(sales, dc, dp),
        "daily_sales": G.daily_sales(fact),
        "customer_360": G.customer_360(fact, dc, X.DAY1.date()),
        "product_performance": G.product_performance(fact, dp),
    }
    for name, df in plans.items():
        df.write.format("noop").mode("overwrite").save()  # run once so AQE shows its final plan
        print(f"\n===== {name} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
