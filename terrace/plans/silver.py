"""Silver: normalise, validate, quarantine, dedupe, SCD2 and upsert — as plans.

Every function is a pure ``DataFrame -> DataFrame`` plan; ``as_of`` (the run
instant) is passed in, never read from a clock, so a run is reproducible and
its expiry/open instants agree.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import money
from terrace.functions.identity import attribute_hash
from terrace.functions.normalize import UNREADABLE, email_ok, key, lower_trim, parse_date, parse_timestamp, title, typed
from terrace.operators import rules as R
from terrace.operators.dedupe import latest_per_key
from terrace.operators.scd2 import apply_scd2, first_load
from terrace.sources.contracts import CORRUPT, CUSTOMER_CONTRACT, ORDER_CONTRACT, PRODUCT_CONTRACT

# Fixed reason codes.
INVALID_CUSTOMER = "INVALID_CUSTOMER_KEY_OR_EMAIL"
INVALID_PRODUCT = "INVALID_PRODUCT"
NON_POSITIVE_QUANTITY = "NON_POSITIVE_QUANTITY"
NEGATIVE_PRICE = "NEGATIVE_PRICE"
UNKNOWN_CUSTOMER = "UNKNOWN_CUSTOMER"
UNKNOWN_PRODUCT = "UNKNOWN_PRODUCT"
INVALID_ORDER_KEY = "INVALID_ORDER_KEY"
MISSING_MEASURE = "MISSING_MEASURE"
AMOUNT_OUT_OF_RANGE = "AMOUNT_OUT_OF_RANGE"
CORRUPT_RECORD = "CORRUPT_RECORD"
UNREADABLE_VALUE = "UNREADABLE_VALUE"
# The row as it landed, beside the parsed one.
RAW = "_raw"
_DEALT = "_dealt"

CUSTOMER_ATTRIBUTES = ["full_name", "email", "city", "country", "segment"]
CUSTOMER_COLUMNS = [
    "customer_id", "full_name", "email", "city", "country", "segment",
    "signup_date", "source_updated_at", "attribute_hash",
]
PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "unit_cost", "list_price", "active", "source_updated_at",
]
SALES_COLUMNS = [
    "order_id", "customer_id", "product_id", "ordered_at", "order_date", "quantity",
    "unit_price", "discount_pct", "gross_amount", "discount_amount", "net_amount",
    "channel", "status", "currency", "_batch_id", "_ingested_at",
]


def _landed(bronze: DataFrame, contract) -> DataFrame:
    """Bronze rows with their source values as JSON in ``_raw`` (NULL fields left out), then typed by the contract."""
    source = [f.name for f in contract.fields if f.name in bronze.columns] + ([CORRUPT] if CORRUPT in bronze.columns else [])
    return typed(bronze.withColumn(RAW, F.to_json(F.struct(*source))), contract)


def _broken(df: DataFrame) -> list[R.Rule]:
    """A line that could not be read at all names its reason before any other."""
    return [R.Rule(CORRUPT_RECORD, F.col(CORRUPT).isNotNull())] if CORRUPT in df.columns else []


# --------------------------------------------------------------------------- customers
def customers_normalized(bronze: DataFrame) -> DataFrame:
    """Trim/upper ids, title-case names and cities, lower e-mails, parse date/time; ``_raw`` keeps the source values."""
    return _landed(bronze, CUSTOMER_CONTRACT).withColumns(
        {
            "customer_id": key("customer_id"),
            "full_name": title("full_name"),
            "email": lower_trim("email"),
            "city": title("city"),
            "signup_date": parse_date(bronze, "signup_date"),
            "source_updated_at": parse_timestamp(bronze, "updated_at"),
        }
    )


def customer_rules(require_email: bool = False) -> list[R.Rule]:
    """Blank/NULL id, or an e-mail failing the pattern.

    A NULL e-mail is accepted unless ``require_email``: the pattern test of NULL
    is NULL, which does not violate the rule.
    """
    bad_email = ~email_ok("email")
    if require_email:
        bad_email = F.coalesce(bad_email, F.lit(True))
    violated = F.col("customer_id").isNull() | (F.col("customer_id") == "") | bad_email
    return [R.Rule(INVALID_CUSTOMER, violated)]


def customers_classified(bronze: DataFrame, require_email: bool = False) -> DataFrame:
    return R.classify(customers_normalized(bronze), [*_broken(bronze), *customer_rules(require_email)])


def customers_incoming(classified: DataFrame) -> DataFrame:
    """Valid customers, newest row per id, with the attribute hash.

    Validity is the negated (total) rule predicate rather than ``all EXCEPT
    invalid``: same rows after the per-key dedupe, without a set-difference
    shuffle.
    """
    valid = R.valid_rows(classified)
    latest = latest_per_key(valid, "customer_id")
    return latest.withColumn("attribute_hash", attribute_hash(CUSTOMER_ATTRIBUTES)).select(*CUSTOMER_COLUMNS)


def customers_quarantine(classified: DataFrame, quarantine_date: _dt.date) -> DataFrame:
    invalid = R.invalid_rows(classified)
    payload = CUSTOMER_COLUMNS[:-1] + ["updated_at", "_source_file", "_batch_id", RAW]
    return R.quarantine(invalid, "customer", quarantine_date, payload)


def customers_history(history: DataFrame | None, incoming: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """First load, or SCD2 apply against the existing history."""
    if history is None:
        return first_load(incoming, as_of)
    return apply_scd2(history, incoming, "customer_id", as_of)


# --------------------------------------------------------------------------- products
def product_rules() -> list[R.Rule]:
    return [
        R.Rule(
            INVALID_PRODUCT,
            F.col("product_id").isNull() | ~(F.col("unit_cost") >= 0) | ~(F.col("list_price") >= 0),
        )
    ]


def products_classified(bronze: DataFrame) -> DataFrame:
    """Invalid products are quarantined (not silently dropped), unreadable values with a reason of their own.

    A NULL cost or price violates the rule (``NOT (NULL >= 0)`` is NULL → counted
    as violated by the total predicate), matching a filter that keeps only rows
    where the comparisons are TRUE.
    """
    rules = [R.Rule(INVALID_PRODUCT, F.coalesce(r.violated, F.lit(True))) for r in product_rules()]
    df = _landed(bronze, PRODUCT_CONTRACT)
    return R.classify(df, [*_broken(df), R.Rule(UNREADABLE_VALUE, F.col(UNREADABLE).isNotNull()), *rules]).withColumns(
        {"product_id": key("product_id"), "source_updated_at": parse_timestamp(bronze, "updated_at")}
    )


def products_valid(classified: DataFrame) -> DataFrame:
    return latest_per_key(R.valid_rows(classified), "product_id").select(*PRODUCT_COLUMNS)


def products_quarantine(classified: DataFrame, quarantine_date: _dt.date) -> DataFrame:
    payload = [
        "product_id", "product_name", "category", "unit_cost", "list_price", "active", "updated_at",
        "_source_file", "_batch_id", RAW,
    ]
    return R.quarantine(R.invalid_rows(classified), "product", quarantine_date, payload)


# --------------------------------------------------------------------------- orders
def order_financials(latest_orders: DataFrame) -> DataFrame:
    """Type the row, parse order time, derive date and the three amounts (decimal, HALF_UP)."""
    return _landed(latest_orders, ORDER_CONTRACT).withColumns(
        {"ordered_at": parse_timestamp(latest_orders, "ordered_at")}
    ).withColumns(
        {
            "order_date": F.to_date("ordered_at"),
            "gross_amount": money.gross("quantity", "unit_price"),
            "net_amount": money.net("quantity", "unit_price", "discount_pct"),
        }
    ).withColumn("discount_amount", money.amount(F.col("gross_amount") - F.col("net_amount")))


def order_rules() -> list[R.Rule]:
    """First match wins; the reference reasons keep their order, MISSING_MEASURE
    (NULL quantity or price, which the plain OR would lose) is tested last."""
    return [
        R.Rule(NON_POSITIVE_QUANTITY, F.col("quantity") <= 0),
        R.Rule(NEGATIVE_PRICE, F.col("unit_price") < 0),
        R.Rule(UNKNOWN_CUSTOMER, F.col("_customer_exists").isNull()),
        R.Rule(UNKNOWN_PRODUCT, F.col("_product_exists").isNull()),
        R.Rule(INVALID_ORDER_KEY, F.col("order_id").isNull() | (F.col("order_id") == "")),
        R.Rule(MISSING_MEASURE, F.col("quantity").isNull() | F.col("unit_price").isNull()),
    ]


def orders_checked(
    bronze_orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    looked_up: dict[str, list] | None = None,
    written: Callable[[DataFrame, str], DataFrame] | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Latest per order id (NULL ids pass through) → reference flags → financials.

    ``customers`` is the SCD2 history (only current rows count); ``products`` the
    Silver products. The joins come before the rows are typed: what is derived from a row
    (amounts, its source values as JSON) is never shuffled, nor is a lineage column
    that the result does not show, so a row without a key is dealt by a number made
    from its identity before the first shuffle. ``looked_up`` names, per reference flag, columns of the customers or
    products that the result shows after the flags (see :func:`~terrace.operators.rules.reference_flags`).

    With ``written``, which writes a frame by a name and reads it back, the latest rows are written before they are
    checked, with the lineage columns ``carried``: less bytes than a shuffle of them, and the keys are read from there alone.
    """
    identity = next((F.col(c) for c in ("_bronze_record_id", "_record_hash") if c in bronze_orders.columns), F.struct(*bronze_orders.columns))
    no_key = F.col("customer_id").isNull() | F.col("product_id").isNull()
    numbered = bronze_orders.withColumn(_DEALT, F.when(no_key, F.hash(identity)))
    latest = latest_per_key(numbered, "order_id")
    if written is not None:
        latest = written(latest.select(*[c for c in latest.columns if not c.startswith("_") or c in (CORRUPT, _DEALT, *carried)]), "orders-latest")
    current_ids = customers.filter(F.col("is_current"))
    references = {
        "_customer_exists": (current_ids, "customer_id"),
        "_product_exists": (products, "product_id"),
    }
    flagged = R.reference_flags(latest, references, keyless=F.col(_DEALT), shown=looked_up, written=written)
    last = [c for c in flagged.columns if c not in latest.columns]
    checked = order_financials(flagged.drop(_DEALT))
    return checked.select(*[c for c in checked.columns if c not in last], *last)


def order_checks(checked: DataFrame) -> list[R.Rule]:
    """Broken lines, the reference's rules, values that are not exactly of their type, missing measures, and amounts that
    have more digits than an amount can hold."""
    too_large = F.col("gross_amount").isNull() | (F.col("net_amount").isNull() & F.col("discount_pct").isNotNull())
    *rules, missing = order_rules()
    unreadable = [R.Rule(UNREADABLE_VALUE, F.col(UNREADABLE).isNotNull())] if UNREADABLE in checked.columns else []
    return [*_broken(checked), *rules, *unreadable, missing, R.Rule(AMOUNT_OUT_OF_RANGE, too_large)]


def orders_classified(checked: DataFrame) -> DataFrame:
    return R.classify(checked, order_checks(checked))


def sales_rows(classified: DataFrame) -> DataFrame:
    return R.valid_rows(classified).select(*SALES_COLUMNS)


def sales_of_checked(checked: DataFrame, looked_up: Sequence[str] = ()) -> DataFrame:
    """:func:`sales_rows` of :func:`orders_classified`, for a plan that shows no reasons: a filter a rule. ``looked_up``
    names columns of ``checked`` to show besides.

    No valid order is without an id; the ``coalesce`` changes none, but tells Spark so: a mart that only counts orders
    then does not carry their ids through its joins.
    """
    valid = R.keeping_rules(checked, order_checks(checked))
    return valid.withColumn("order_id", F.coalesce("order_id", F.lit(""))).select(*SALES_COLUMNS, *looked_up)


ORDER_PAYLOAD = [
    "order_id", "customer_id", "product_id", "ordered_at", "order_date", "quantity", "unit_price",
    "discount_pct", "gross_amount", "discount_amount", "net_amount", "channel", "status", "currency",
    "_source_file", "_batch_id", RAW,
]


def orders_quarantine(classified: DataFrame, quarantine_date: _dt.date) -> DataFrame:
    return R.quarantine(R.invalid_rows(classified), "order", quarantine_date, ORDER_PAYLOAD)
