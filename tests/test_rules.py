import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from terrace.operators import rules as R
from terrace.plans import silver as S

ORDER_SCHEMA = ("order_id string, customer_id string, product_id string, quantity int, unit_price decimal(12,2), "
                "_customer_exists boolean, _product_exists boolean")


def test_first_violated_rule_names_the_reason_and_nothing_is_lost(spark):
    rows = [
        ("o1", "c", "p", 1, Decimal("1"), True, True),      # valid
        ("o2", "c", "p", 0, Decimal("-1"), None, None),     # quantity first
        ("o3", "c", "p", 1, Decimal("-1"), None, True),     # price before customer
        ("o4", "x", "p", None, Decimal("1"), None, True),   # NULL quantity + unknown customer
        ("o5", "c", "p", None, Decimal("1"), True, True),   # NULL quantity only -> MISSING_MEASURE
        ("o6", "c", "p", 2, None, True, True),              # NULL price only -> MISSING_MEASURE
        (None, "c", "p", 1, Decimal("1"), True, True),      # key
        ("", "c", "q", 1, Decimal("1"), True, None),        # product before key
    ]
    df = spark.createDataFrame(rows, ORDER_SCHEMA)
    c = R.classify(df, S.order_rules())
    got = {r.order_id: r._quarantine_reason for r in c.collect()}
    assert got == {
        "o1": None, "o2": "NON_POSITIVE_QUANTITY", "o3": "NEGATIVE_PRICE", "o4": "UNKNOWN_CUSTOMER",
        "o5": "MISSING_MEASURE", "o6": "MISSING_MEASURE", None: "INVALID_ORDER_KEY", "": "UNKNOWN_PRODUCT",
    }
    valid, invalid = R.split(df, S.order_rules())
    assert valid.count() + invalid.count() == df.count()


def test_null_email_accepted_unless_required(spark):
    df = spark.createDataFrame([("C1", None), ("C2", "bad"), (" ", "a@b.c"), ("C3", "a@b.c")],
                               "customer_id string, email string")
    df = df.withColumn("customer_id", F.upper(F.trim("customer_id")))
    lax = {r.customer_id: r._quarantine_reason for r in R.classify(df, S.customer_rules()).collect()}
    assert lax == {"C1": None, "C2": S.INVALID_CUSTOMER, "": S.INVALID_CUSTOMER, "C3": None}
    strict = {r.customer_id: r._quarantine_reason
              for r in R.classify(df, S.customer_rules(require_email=True)).collect()}
    assert strict["C1"] == S.INVALID_CUSTOMER


def test_invalid_products_are_quarantined_not_dropped(spark):
    schema = ("product_id string, product_name string, category string, unit_cost decimal(12,2), "
              "list_price decimal(12,2), active boolean, updated_at string, _source_file string, _batch_id string, "
              "_ingested_at timestamp_ntz, _record_hash string")
    rows = [("p1", "a", "c", Decimal("1"), Decimal("2"), True, None, "f", "b", None, "h1"),
            (None, "a", "c", Decimal("1"), Decimal("2"), True, None, "f", "b", None, "h2"),
            ("p2", "a", "c", Decimal("-1"), Decimal("2"), True, None, "f", "b", None, "h3"),
            ("p3", "a", "c", None, Decimal("2"), True, None, "f", "b", None, "h4")]
    cls = S.products_classified(spark.createDataFrame(rows, schema))
    q = S.products_quarantine(cls, None)
    assert q.count() == 3
    assert S.products_valid(cls).count() == 1


def test_reference_flags_do_not_fan_out(spark):
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c2"), ("o3", "c9")], "order_id string, customer_id string")
    keys = spark.createDataFrame([("c1",), ("c1",), ("c2",), (None,)], "customer_id string")
    out = R.reference_flags(orders, {"_customer_exists": (keys, "customer_id")})
    assert out.count() == 3
    assert {r.order_id: r._customer_exists for r in out.collect()} == {"o1": True, "o2": True, "o3": None}


def test_quarantine_id_is_deterministic(spark):
    df = spark.createDataFrame([("o1", "r", "f", "b")], "order_id string, _quarantine_reason string, "
                                                          "_source_file string, _batch_id string")
    a = R.quarantine(df, "order", None).first()._quarantine_id
    b = R.quarantine(df, "order", None).first()._quarantine_id
    assert a == b


def test_valid_invalid_split_adds_no_exchange(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("order_id"), F.lit(1).alias("quantity"),
                                  F.lit(1).cast("decimal(12,2)").alias("unit_price"),
                                  F.lit(True).alias("_customer_exists"), F.lit(True).alias("_product_exists"))
    classified = R.classify(df, S.order_rules())
    for side in (R.valid_rows(classified), R.invalid_rows(classified)):
        assert "Exchange" not in side._jdf.queryExecution().sparkPlan().toString()  # noqa: SLF001


def test_checks_carry_neither_lineage_nor_source_copy_of_sales(spark):
    order = dict(order_id="O1", customer_id="C1", product_id="P1", ordered_at="2024-01-01 10:00:00", quantity="2", unit_price="3.50",
                 discount_pct="0.1", channel="WEB", status="DONE", currency="USD")
    lineage = dict(_source_file="f", _batch_id="b", _ingested_at=dt.datetime(2024, 1, 1), _record_hash="h", _bronze_record_id="r")
    rows = [order | lineage, order | lineage | dict(order_id="O2", customer_id=None, _bronze_record_id="s"), order | lineage | dict(order_id=None, product_id=None, _bronze_record_id="t"),
            order | lineage | dict(order_id=None, product_id=None, _bronze_record_id="u")]
    bronze = spark.createDataFrame(rows, ", ".join(f"{c} {'timestamp_ntz' if c == '_ingested_at' else 'string'}" for c in rows[0]))
    customers = spark.createDataFrame([("C1", True), (None, True), ("C2", False)], "customer_id string, is_current boolean")
    products = spark.createDataFrame([("P1",), (None,)], "product_id string")
    checked = S.orders_checked(bronze, customers, products)
    got = sorted(((r.order_id, r._customer_exists, r._product_exists, r._raw) for r in checked.collect()), key=str)
    raw = [(r[0], r[1], r[2], "customer_id" in r[3], "product_id" in r[3]) for r in got]
    assert raw == [("O1", True, True, True, True), ("O2", None, True, False, True), (None, True, None, True, False), (None, True, None, True, False)]
    assert checked.columns[-2:] == ["_customer_exists", "_product_exists"]
    plan = S.sales_rows(S.orders_classified(checked))._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert "to_json" not in plan and "_source_file" not in plan.split("LogicalRDD")[0]
