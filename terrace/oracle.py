"""Independent SQL oracle (DuckDB dialect) for the registered queries.

The same fixture deliveries, Silver rules and Gold formulas are written here as
plain SQL over the driver's tables, so the Spark plans can be checked against a
second engine. Engine differences are bridged explicitly:

* Spark's ``to_json`` text is spelled out field by field (NULL fields omitted,
  decimals with their scale, ``TIMESTAMP_NTZ`` as ``yyyy-MM-ddTHH:mm:ss.SSS``);
* ``initcap`` (absent in DuckDB) is rebuilt from split/upper/lower;
* money is rounded as DECIMAL and compared as DOUBLE; sums of integers are cast
  to BIGINT (DuckDB widens them to HUGEINT);
* averages are rounded half away from zero from exact integer cents;
* order counts use ``COUNT(DISTINCT order_id)`` as the marts are defined, which
  also checks the Spark side's plain count (valid because ``order_id`` is unique).
"""

from __future__ import annotations

from terrace.sources import fixtures as X

TS1 = "TIMESTAMP '1999-01-01 00:00:00'"
TS2 = "TIMESTAMP '1999-01-02 00:00:00'"
D1 = "DATE '1999-01-01'"
CUTOFF = "TIMESTAMP '1996-01-01 00:00:00'"
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


# ----------------------------------------------------------------------------- helpers
def json_text(fields: list[tuple[str, str]], keep_nulls: bool = False) -> str:
    """SQL for Spark's ``to_json(struct(...))`` text of ``fields`` = [(column, kind)]."""
    parts = []
    for name, kind in fields:
        if kind == "str":
            value = f"CAST(to_json({name}) AS VARCHAR)"
        elif kind == "num":
            value = f"CAST({name} AS VARCHAR)"
        elif kind == "ts":
            value = f"concat('\"', strftime({name}, '%Y-%m-%dT%H:%M:%S.%g'), '\"')"
        elif kind == "date":
            value = f"concat('\"', strftime({name}, '%Y-%m-%d'), '\"')"
        elif kind == "bool":
            value = f"CASE WHEN {name} THEN 'true' ELSE 'false' END"
        else:  # pragma: no cover
            raise ValueError(kind)
        null_part = f"'\"{name}\":null'" if keep_nulls else "NULL"
        parts.append(f"CASE WHEN {name} IS NULL THEN {null_part} ELSE concat('\"{name}\":', {value}) END")
    return "concat('{', concat_ws(',', " + ", ".join(parts) + "), '}')"


def initcap(expr: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
        f"lambda w: concat(upper(left(w, 1)), substr(w, 2))), ' ')"
    )


def money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DECIMAL(18,2))"


def rounded_avg(col: str) -> str:
    s = f"SUM(CAST({col} * 100 AS BIGINT))"
    n = f"COUNT({col})"
    mag = f"((2 * ABS({s}) + {n}) // (2 * {n}))"
    return f"CASE WHEN {n} > 0 THEN CAST(CASE WHEN {s} < 0 THEN -{mag} ELSE {mag} END AS DOUBLE) / 100 END"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CUSTOMER_SRC = [("customer_id", "str"), ("full_name", "str"), ("email", "str"), ("city", "str"),
                ("country", "str"), ("segment", "str"), ("signup_date", "str"), ("updated_at", "str")]
PRODUCT_SRC = [("product_id", "str"), ("product_name", "str"), ("category", "str"), ("unit_cost", "str"),
               ("list_price", "str"), ("active", "str"), ("updated_at", "str")]
PRODUCT_LINE = [(c, {"unit_cost": "num", "list_price": "num", "active": "bool"}.get(c, k)) for c, k in PRODUCT_SRC]
ORDER_SRC = [("order_id", "str"), ("customer_id", "str"), ("product_id", "str"), ("ordered_at", "ts"),
             ("quantity", "str"), ("unit_price", "str"), ("discount_pct", "str"), ("channel", "str"),
             ("status", "str"), ("currency", "str")]
CUSTOMER_ATTR = [("full_name", "str"), ("email", "str"), ("city", "str"), ("country", "str"), ("segment", "str")]

# ----------------------------------------------------------------------------- fixtures
CRM = f"""crm AS (
  SELECT c_custkey AS _custkey,
    CASE WHEN c_custkey % {X.BLANK_CUSTOMER_ID} = 0 THEN ' ' ELSE concat(' c', printf('%06d', c_custkey)) END AS customer_id,
    concat(c_name, ' ') AS full_name,
    CASE WHEN c_custkey % {X.BAD_EMAIL} = 0 THEN 'not-an-email' WHEN c_custkey % {X.NULL_EMAIL} = 0 THEN NULL
         ELSE concat('User.', CAST(c_custkey AS VARCHAR), '@Example.test') END AS email,
    n_name AS city, r_name AS country, c_mktsegment AS segment,
    CASE WHEN c_custkey % {X.BAD_SIGNUP_DATE} = 0 THEN 'not-a-date'
         ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 1460 AS INTEGER) AS VARCHAR) END AS signup_date,
    concat(CAST(DATE '1998-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR), ' 00:00:00') AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CRM2 = f"""crm2 AS (
  SELECT _custkey, customer_id, full_name,
    CASE WHEN _custkey % {X.BAD_EMAIL} = 0 THEN concat('fixed.', CAST(_custkey AS VARCHAR), '@example.test') ELSE email END AS email,
    city, country,
    CASE WHEN _custkey % {X.SEGMENT_CHANGE} = 0 THEN concat(segment, '-PLUS') ELSE segment END AS segment,
    CASE WHEN _custkey % {X.SEGMENT_CHANGE} = 1 AND _custkey % {X.BAD_SIGNUP_DATE} <> 0 THEN '1994-12-31' ELSE signup_date END AS signup_date,
    '1999-01-02 00:00:00' AS updated_at
  FROM crm)"""

TEXT = ("CAST(unit_cost AS VARCHAR) AS unit_cost", "CAST(list_price AS VARCHAR) AS list_price", "CAST(active AS VARCHAR) AS active")

PR = f"""prn AS (
  SELECT p_partkey AS _partkey,
    CASE WHEN p_partkey % {X.NULL_PRODUCT_ID} = 0 THEN NULL ELSE concat('P', printf('%06d', p_partkey)) END AS product_id,
    p_name AS product_name, p_type AS category,
    CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(3,1))
         * CASE WHEN p_partkey % {X.NEGATIVE_COST} = 0 THEN -1 ELSE 1 END, 2) AS DECIMAL(12,2)) AS unit_cost,
    CAST(p_retailprice AS DECIMAL(12,2)) AS list_price, true AS active,
    '1999-01-01 00:00:00' AS updated_at
  FROM part),
pr AS (
  SELECT * REPLACE (concat(CAST(unit_cost AS VARCHAR), CASE WHEN _partkey % {X.FINE_COST} = 0 THEN '0001' ELSE '' END) AS unit_cost,
                    {TEXT[1]}, {TEXT[2]}) FROM prn)"""

PR2 = f"""prn2 AS (
  SELECT _partkey, product_id, product_name, category,
    CAST(ABS(unit_cost) AS DECIMAL(12,2)) AS unit_cost,
    CASE WHEN _partkey % {X.PRICE_CHANGE} = 0 THEN CAST(list_price + 1 AS DECIMAL(12,2)) ELSE list_price END AS list_price,
    active, '1999-01-02 00:00:00' AS updated_at
  FROM prn),
pr2 AS (SELECT * REPLACE ({", ".join(TEXT)}) FROM prn2)"""

ORD = f"""ord AS (
  SELECT concat('O', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS order_id,
    CASE WHEN l_orderkey % {X.UNKNOWN_CUSTOMER} = 0 THEN 'C999999' ELSE concat('C', printf('%06d', o_custkey)) END AS customer_id,
    concat('P', printf('%06d', l_partkey)) AS product_id,
    o_orderdate AS ordered_at,
    CASE WHEN l_orderkey % {X.ZERO_QUANTITY} = 0 THEN '0' WHEN l_orderkey % {X.NULL_QUANTITY} = 0 THEN NULL
         WHEN l_orderkey % {X.WORD_QUANTITY} = 0 THEN 'two' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    concat(CAST(CAST(p_retailprice * CASE WHEN l_orderkey % {X.NEGATIVE_PRICE} = 0 THEN -1 ELSE 1 END AS DECIMAL(12,2)) AS VARCHAR),
           CASE WHEN l_orderkey % {X.TENTH_CENTS} = 0 THEN '1' WHEN l_orderkey % {X.FINE_PRICE} = 0 THEN '0001' ELSE '' END) AS unit_price,
    CAST(CAST(l_discount AS DECIMAL(5,4)) AS VARCHAR) AS discount_pct,
    o_orderpriority AS channel, l_returnflag AS status, 'USD' AS currency,
    l_shipdate AS _delivered_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def bronze_cte(name: str, src: str, fields, entity: str, system: str, ts: str, day: str, batch: str) -> str:
    cols = ", ".join(f for f, _ in fields)
    return f"""{name}_h AS (
  SELECT {cols}, '{system}' AS _source_system,
    'landing/{entity}/batch_date={day}/{entity}.part-0' AS _source_file,
    '{batch}' AS _batch_id, {ts} AS _ingested_at, CAST({ts} AS DATE) AS _ingestion_date,
    sha256({json_text(fields)}) AS _record_hash
  FROM {src}),
{name} AS (SELECT *, sha256(concat_ws('||', _source_file, _record_hash)) AS _bronze_record_id FROM {name}_h)"""


BCUST1 = bronze_cte("bcust1", "crm", CUSTOMER_SRC, "customers", "crm_csv", TS1, "1999-01-01", "19990101")
BCUST2 = bronze_cte("bcust2", "crm2", CUSTOMER_SRC, "customers", "crm_csv", TS2, "1999-01-02", "19990102")
BPROD1 = bronze_cte("bprod1", "pr", PRODUCT_SRC, "products", "product_json", TS1, "1999-01-01", "19990101")
BPROD2 = bronze_cte("bprod2", "pr2", PRODUCT_SRC, "products", "product_json", TS2, "1999-01-02", "19990102")
BORD = f"""bord_h AS (
  SELECT {", ".join(f for f, _ in ORDER_SRC)}, 'commerce_csv' AS _source_system,
    concat('landing/orders/batch_date=', strftime(_delivered_at, '%Y-%m-%d'), '/orders.part-0') AS _source_file,
    strftime(_delivered_at, '%Y%m%d') AS _batch_id, _delivered_at AS _ingested_at,
    CAST(_delivered_at AS DATE) AS _ingestion_date,
    sha256({json_text(ORDER_SRC)}) AS _record_hash
  FROM ord),
bord AS (SELECT *, sha256(concat_ws('||', _source_file, _record_hash)) AS _bronze_record_id FROM bord_h),
bord1 AS (SELECT * FROM bord WHERE _ingested_at < {CUTOFF})"""

FIXTURES = [CRM, PR, ORD, BCUST1, BPROD1, BORD]
FIXTURES2 = [CRM2, PR2, BCUST2, BPROD2]

# ----------------------------------------------------------------------------- silver
def exact(column: str, kind: str) -> str:
    """A text column as ``kind`` where that loses nothing."""
    if kind == "BOOLEAN":
        return f"CASE lower(trim({column})) WHEN 'true' THEN true WHEN 'false' THEN false END"
    number = f"TRY_CAST(trim({column}) AS DECIMAL(38,18))"
    return f"CASE WHEN TRY_CAST({number} AS {kind}) = {number} THEN TRY_CAST({number} AS {kind}) END"


def landed(name: str, bronze: str, fields, types: dict[str, str]) -> str:
    """Bronze with its source values as JSON and its numbers typed; ``_unreadable`` names what is not exactly of its type."""
    typed = ", ".join(f"{exact(c, t)} AS {c}" for c, t in types.items())
    bad = ", ".join(f"CASE WHEN trim({c}) <> '' AND ({exact(c, t)}) IS NULL THEN '{c}' END" for c, t in types.items())
    return f"""{name} AS (
  SELECT * REPLACE ({typed}), nullif(concat_ws(',', {bad}), '') AS _unreadable, {json_text(fields)} AS _raw FROM {bronze})"""


PRODUCT_TYPES = {"unit_cost": "DECIMAL(16,4)", "list_price": "DECIMAL(16,4)", "active": "BOOLEAN"}
ORDER_TYPES = {"quantity": "INTEGER", "unit_price": "DECIMAL(16,4)", "discount_pct": "DECIMAL(8,6)"}
LATEST = "ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY _ingested_at DESC NULLS LAST, _record_hash DESC NULLS LAST)"


def customers_ctes(sfx: str, bronze: str) -> list[str]:
    return [
        f"""cn{sfx} AS (
  SELECT upper(trim(customer_id)) AS customer_id, {initcap('trim(full_name)')} AS full_name,
    lower(trim(email)) AS email, {initcap('trim(city)')} AS city, country, segment,
    TRY_CAST(signup_date AS DATE) AS signup_date, TRY_CAST(updated_at AS TIMESTAMP) AS source_updated_at,
    updated_at, _source_file, _batch_id, _ingested_at, _record_hash, {json_text(CUSTOMER_SRC)} AS _raw
  FROM {bronze})""",
        f"""ccl{sfx} AS (
  SELECT *, CASE WHEN COALESCE(customer_id IS NULL OR customer_id = '' OR NOT regexp_matches(email, '{EMAIL}'), false)
    THEN 'INVALID_CUSTOMER_KEY_OR_EMAIL' END AS _quarantine_reason
  FROM cn{sfx})""",
        f"""cinc{sfx} AS (
  SELECT customer_id, full_name, email, city, country, segment, signup_date, source_updated_at,
    sha256({json_text(CUSTOMER_ATTR, keep_nulls=True)}) AS attribute_hash
  FROM (SELECT * FROM ccl{sfx} WHERE _quarantine_reason IS NULL AND customer_id IS NOT NULL
        QUALIFY {LATEST.format(k='customer_id')} = 1))""",
    ]


HIST1 = f"""hist1 AS (
  SELECT *, {TS1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM cinc1)"""


def products_ctes(sfx: str, bronze: str) -> list[str]:
    return [
        landed(f"pty{sfx}", bronze, PRODUCT_SRC, PRODUCT_TYPES),
        f"""pcl{sfx} AS (
  SELECT upper(trim(product_id)) AS product_id, product_name, category, unit_cost, list_price, active, updated_at,
    TRY_CAST(updated_at AS TIMESTAMP) AS source_updated_at, _source_file, _batch_id, _ingested_at, _record_hash, _raw,
    CASE WHEN _unreadable IS NOT NULL THEN 'UNREADABLE_VALUE' WHEN COALESCE(product_id IS NULL OR NOT (unit_cost >= 0) OR NOT (list_price >= 0), true)
      THEN 'INVALID_PRODUCT' END AS _quarantine_reason
  FROM pty{sfx})""",
        f"""prod{sfx} AS (
  SELECT product_id, product_name, category, unit_cost, list_price, active, source_updated_at
  FROM (SELECT * FROM pcl{sfx} WHERE _quarantine_reason IS NULL AND product_id IS NOT NULL
        QUALIFY {LATEST.format(k='product_id')} = 1))""",
    ]


def orders_ctes(sfx: str, bronze: str, hist: str = "hist1", prod: str = "prod1") -> list[str]:
    return [
        f"""olat{sfx} AS (
  SELECT * FROM {bronze}
  QUALIFY {LATEST.format(k="order_id, CASE WHEN order_id IS NULL THEN _bronze_record_id END")} = 1)""",
        landed(f"oty{sfx}", f"olat{sfx}", ORDER_SRC, ORDER_TYPES),
        f"""ofin{sfx} AS (
  SELECT *, CAST(ordered_at AS DATE) AS order_date,
    {money('quantity * unit_price')} AS gross_amount,
    {money('quantity * unit_price * (1 - discount_pct)')} AS net_amount
  FROM oty{sfx})""",
        f"""ochk{sfx} AS (
  SELECT o.*, {money('o.gross_amount - o.net_amount')} AS discount_amount, c._customer_exists, p._product_exists
  FROM ofin{sfx} o
  LEFT JOIN (SELECT DISTINCT customer_id, true AS _customer_exists FROM {hist}
             WHERE is_current AND customer_id IS NOT NULL) c ON o.customer_id = c.customer_id
  LEFT JOIN (SELECT DISTINCT product_id, true AS _product_exists FROM {prod}
             WHERE product_id IS NOT NULL) p ON o.product_id = p.product_id)""",
        f"""ocl{sfx} AS (
  SELECT *, CASE
      WHEN COALESCE(quantity <= 0, false) THEN 'NON_POSITIVE_QUANTITY'
      WHEN COALESCE(unit_price < 0, false) THEN 'NEGATIVE_PRICE'
      WHEN _customer_exists IS NULL THEN 'UNKNOWN_CUSTOMER'
      WHEN _product_exists IS NULL THEN 'UNKNOWN_PRODUCT'
      WHEN order_id IS NULL OR order_id = '' THEN 'INVALID_ORDER_KEY'
      WHEN _unreadable IS NOT NULL THEN 'UNREADABLE_VALUE'
      WHEN quantity IS NULL OR unit_price IS NULL THEN 'MISSING_MEASURE' END AS _quarantine_reason
  FROM ochk{sfx})""",
        f"""sales{sfx} AS (
  SELECT order_id, customer_id, product_id, ordered_at, order_date, quantity, unit_price, discount_pct,
    gross_amount, discount_amount, net_amount, channel, status, currency, _batch_id, _ingested_at
  FROM ocl{sfx} WHERE _quarantine_reason IS NULL)""",
    ]


SILVER = customers_ctes("1", "bcust1") + [HIST1] + products_ctes("1", "bprod1") + orders_ctes("", "bord")

ORDER_PAYLOAD = [("order_id", "str"), ("customer_id", "str"), ("product_id", "str"), ("ordered_at", "ts"),
                 ("order_date", "date"), ("quantity", "num"), ("unit_price", "num"), ("discount_pct", "num"),
                 ("gross_amount", "num"), ("discount_amount", "num"), ("net_amount", "num"), ("channel", "str"),
                 ("status", "str"), ("currency", "str"), ("_source_file", "str"), ("_batch_id", "str"), ("_raw", "str")]
CUSTOMER_PAYLOAD = [("customer_id", "str"), ("full_name", "str"), ("email", "str"), ("city", "str"),
                    ("country", "str"), ("segment", "str"), ("signup_date", "date"), ("source_updated_at", "ts"),
                    ("updated_at", "str"), ("_source_file", "str"), ("_batch_id", "str"), ("_raw", "str")]
PRODUCT_PAYLOAD = [("product_id", "str"), ("product_name", "str"), ("category", "str"), ("unit_cost", "num"),
                   ("list_price", "num"), ("active", "bool"), ("updated_at", "str"), ("_source_file", "str"),
                   ("_batch_id", "str"), ("_raw", "str")]


def quarantine_cte(name: str, src: str, entity: str, payload) -> str:
    return f"""{name}_p AS (
  SELECT '{entity}' AS _entity, _quarantine_reason, {D1} AS _quarantine_date, _source_file,
    {json_text(payload)} AS _payload
  FROM {src} WHERE _quarantine_reason IS NOT NULL),
{name} AS (
  SELECT *, sha256(concat_ws('||', _entity, _quarantine_reason, COALESCE(_source_file, ''), _payload)) AS _quarantine_id
  FROM {name}_p)"""


QUARANTINE = [
    quarantine_cte("qcust", "ccl1", "customer", CUSTOMER_PAYLOAD),
    quarantine_cte("qprod", "pcl1", "product", PRODUCT_PAYLOAD),
    quarantine_cte("qord", "ocl", "order", ORDER_PAYLOAD),
    "qall AS (SELECT * FROM qcust UNION ALL SELECT * FROM qprod UNION ALL SELECT * FROM qord)",
]

# ----------------------------------------------------------------------------- gold
GOLD = [
    """dimc AS (
  SELECT customer_id, full_name, email, city, country, segment, signup_date, valid_from FROM hist1 WHERE is_current)""",
    """dimp AS (SELECT product_id, product_name, category, unit_cost, list_price, active FROM prod1)""",
    f"""fact AS (
  SELECT s.order_id, s.customer_id, s.product_id, s.order_date, s.ordered_at, s.quantity, s.gross_amount,
    s.discount_amount, s.net_amount, {money('s.quantity * p.unit_cost')} AS cost_amount,
    {money(f"s.net_amount - {money('s.quantity * p.unit_cost')}")} AS margin_amount,
    s.channel, s.status, s.currency
  FROM sales s JOIN dimc c ON s.customer_id = c.customer_id JOIN dimp p ON s.product_id = p.product_id)""",
    f"""daily AS (
  SELECT order_date, channel, COUNT(DISTINCT order_id) AS orders, CAST(SUM(quantity) AS BIGINT) AS units,
    CAST(ROUND(SUM(gross_amount), 2) AS DOUBLE) AS gross_revenue,
    CAST(ROUND(SUM(discount_amount), 2) AS DOUBLE) AS discounts,
    CAST(ROUND(SUM(net_amount), 2) AS DOUBLE) AS net_revenue,
    CAST(ROUND(SUM(margin_amount), 2) AS DOUBLE) AS gross_margin,
    {rounded_avg('net_amount')} AS average_order_value
  FROM fact GROUP BY order_date, channel)""",
    f"""c360 AS (
  SELECT a.customer_id, a.lifetime_orders, a.lifetime_value, a.last_order_at, a.average_order_value,
    a.distinct_products, c.full_name, c.email, c.city, c.country, c.segment, c.signup_date, c.valid_from,
    CAST(date_diff('day', CAST(a.last_order_at AS DATE), {D1}) AS INTEGER) AS days_since_last_order,
    CASE WHEN a.lifetime_value >= 1000 THEN 'HIGH' WHEN a.lifetime_value >= 300 THEN 'MEDIUM' ELSE 'LOW' END AS value_band
  FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS lifetime_orders,
          CAST(ROUND(SUM(net_amount), 2) AS DOUBLE) AS lifetime_value, MAX(ordered_at) AS last_order_at,
          {rounded_avg('net_amount')} AS average_order_value, COUNT(DISTINCT product_id) AS distinct_products
        FROM fact GROUP BY customer_id) a JOIN dimc c ON a.customer_id = c.customer_id)""",
    """perf AS (
  SELECT a.product_id, a.orders, a.units_sold, a.net_revenue, a.gross_margin, p.product_name, p.category,
    CAST(p.unit_cost AS DOUBLE) AS unit_cost, CAST(p.list_price AS DOUBLE) AS list_price, p.active,
    CAST(DENSE_RANK() OVER (PARTITION BY p.category ORDER BY a.net_revenue DESC NULLS LAST) AS INTEGER)
      AS revenue_rank_in_category
  FROM (SELECT product_id, COUNT(DISTINCT order_id) AS orders, CAST(SUM(quantity) AS BIGINT) AS units_sold,
          CAST(ROUND(SUM(net_amount), 2) AS DOUBLE) AS net_revenue,
          CAST(ROUND(SUM(margin_amount), 2) AS DOUBLE) AS gross_margin
        FROM fact GROUP BY product_id) a JOIN dimp p ON a.product_id = p.product_id)""",
]

BASE = FIXTURES + SILVER
ALL = BASE + QUARANTINE + GOLD


def _q(ctes: list[str], body: str) -> str:
    return with_(*ctes) + body


def _dbl(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


SALES_SELECT = ("order_id, customer_id, product_id, ordered_at, order_date, quantity, "
                + _dbl(["unit_price", "discount_pct", "gross_amount", "discount_amount", "net_amount"])
                + ", channel, status, currency, _batch_id, _ingested_at")
PRODUCT_SELECT = ("product_id, product_name, category, " + _dbl(["unit_cost", "list_price"])
                  + ", active, source_updated_at")
NORMALIZED = "customer_id, full_name, email, city, country, segment, signup_date, source_updated_at"

# Customers after applying day 2 (SCD2) — shared by the SCD2 queries.
SCD2 = customers_ctes("2", "bcust2") + [
    """cur1 AS (SELECT * FROM hist1 WHERE is_current)""",
    """changed AS (
  SELECT i.* FROM cinc2 i LEFT JOIN cur1 c ON i.customer_id = c.customer_id
  WHERE c.customer_id IS NULL OR i.attribute_hash <> c.attribute_hash)""",
]


def _checks(rows: list[tuple[str, str, str]]) -> str:
    """UNION ALL of (name, actual-SQL, expectation)."""
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS name, ({a}) = 0 AS passed, CAST(({a}) AS BIGINT) AS actual, '{e}' AS expectation"
        for n, a, e in rows
    )


def _dups(table: str, col: str) -> str:
    return f"SELECT COUNT(*) FROM (SELECT {col} FROM {table} GROUP BY {col} HAVING COUNT(*) > 1)"


ORACLE: dict[str, str] = {
    "scan_csv_customers": _q([CRM], f"SELECT customer_id, full_name, email, city, country, segment, signup_date, "
                                    f"updated_at, CAST(NULL AS VARCHAR) AS _corrupt_record, {D1} AS batch_date FROM crm"),
    "scan_json_products": _q(
        [PR, f"""sent AS (SELECT _partkey, * EXCLUDE (_partkey) REPLACE (CAST(unit_cost AS DECIMAL(18,6)) AS unit_cost,
               CAST(list_price AS DECIMAL(18,6)) AS list_price, CAST(active AS BOOLEAN) AS active) FROM pr)""",
         f"lines AS (SELECT *, _partkey % {X.BROKEN_LINE} = 0 AS cut, {json_text(PRODUCT_LINE)} AS line FROM sent)"],
        "SELECT " + ", ".join(f"CASE WHEN NOT cut THEN CAST({c} AS VARCHAR) END AS {c}" for c, _ in PRODUCT_SRC)
        + f", CASE WHEN cut THEN left(line, CAST(length(line) - 7 AS BIGINT)) END AS _corrupt_record, {D1} AS batch_date FROM lines",
    ),
    "scan_csv_orders": _q([ORD], "SELECT order_id, customer_id, product_id, CAST(ordered_at AS VARCHAR) AS ordered_at, "
                                 "quantity, unit_price, discount_pct, channel, status, currency, CAST(NULL AS VARCHAR) AS _corrupt_record, "
                                 "CAST(date_trunc('month', _delivered_at) AS DATE) AS batch_date FROM ord"),
    "ingest_lineage": _q([CRM, BCUST1], "SELECT * EXCLUDE (_record_hash, _bronze_record_id) FROM bcust1"),
    "record_hash": _q([ORD, BORD], "SELECT order_id, _source_file, _record_hash, _bronze_record_id FROM bord"),
    "attribute_hash": _q([CRM, BCUST1] + customers_ctes("1", "bcust1"), "SELECT customer_id, attribute_hash FROM cinc1"),
    "ingest_summary": _q(
        FIXTURES + FIXTURES2,
        """SELECT 'customers' AS entity, CAST(COUNT(*) AS BIGINT) AS rows_seen,
             CAST(COUNT(*) FILTER (WHERE _bronze_record_id NOT IN (SELECT _bronze_record_id FROM bcust1)) AS BIGINT) AS rows_inserted
           FROM (SELECT * FROM bcust1 UNION ALL SELECT * FROM bcust2)
           UNION ALL
           SELECT 'products', COUNT(*), COUNT(*) FILTER (WHERE _bronze_record_id NOT IN (SELECT _bronze_record_id FROM bprod1))
           FROM (SELECT * FROM bprod1 UNION ALL SELECT * FROM bprod2)
           UNION ALL
           SELECT 'orders', COUNT(*), COUNT(*) FILTER (WHERE _bronze_record_id NOT IN (SELECT _bronze_record_id FROM bord1))
           FROM bord""",
    ),
    "merge_insert_only": _q(
        [ORD, BORD],
        """SELECT order_id, _batch_id, _ingested_at, _bronze_record_id FROM bord1
           UNION ALL
           SELECT order_id, _batch_id, _ingested_at, _bronze_record_id FROM bord b
           WHERE NOT EXISTS (SELECT 1 FROM bord1 t WHERE t._bronze_record_id = b._bronze_record_id)""",
    ),
    "latest_per_key": _q(
        [ORD, BORD] + orders_ctes("", "bord")[:1],
        "SELECT order_id, customer_id, product_id, quantity, unit_price, "
        "_ingested_at, _record_hash FROM olat",
    ),
    "merge_upsert_products": _q(
        FIXTURES + FIXTURES2 + products_ctes("1", "bprod1")
        + ["bprod12 AS (SELECT * FROM bprod1 UNION ALL SELECT * FROM bprod2)"] + products_ctes("12", "bprod12"),
        f"""SELECT {PRODUCT_SELECT} FROM prod1 t WHERE NOT EXISTS (SELECT 1 FROM prod12 s WHERE s.product_id = t.product_id)
            UNION ALL SELECT {PRODUCT_SELECT} FROM prod12""",
    ),
    "merge_upsert_sales": _q(
        BASE + orders_ctes("r1", "bord1"),
        f"""SELECT {SALES_SELECT} FROM salesr1 t WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.order_id = t.order_id)
            UNION ALL SELECT {SALES_SELECT} FROM sales""",
    ),
    "set_difference": _q(
        [CRM, BCUST1] + customers_ctes("1", "bcust1")[:2],
        f"SELECT {NORMALIZED} FROM cn1 EXCEPT SELECT {NORMALIZED} FROM ccl1 WHERE _quarantine_reason IS NOT NULL",
    ),
    "scd2_first_load": _q(
        [CRM, BCUST1] + customers_ctes("1", "bcust1") + [HIST1],
        "SELECT customer_id, segment, attribute_hash, valid_from, valid_to, is_current FROM hist1",
    ),
    "scd2_changes": _q(
        FIXTURES + FIXTURES2 + customers_ctes("1", "bcust1") + [HIST1] + SCD2,
        "SELECT customer_id, segment, email, attribute_hash FROM changed",
    ),
    "scd2_expire": _q(
        FIXTURES + FIXTURES2 + customers_ctes("1", "bcust1") + [HIST1] + SCD2,
        f"""SELECT h.customer_id, h.segment, h.valid_from,
              CASE WHEN h.is_current AND k.customer_id IS NOT NULL THEN {TS2} ELSE h.valid_to END AS valid_to,
              CASE WHEN h.is_current AND k.customer_id IS NOT NULL THEN false ELSE h.is_current END AS is_current
            FROM hist1 h LEFT JOIN (SELECT DISTINCT customer_id FROM changed) k ON h.customer_id = k.customer_id""",
    ),
    "scd2_apply": _q(
        FIXTURES + FIXTURES2 + customers_ctes("1", "bcust1") + [HIST1] + SCD2,
        f"""SELECT customer_id, segment, email, signup_date, attribute_hash, valid_from, valid_to, is_current
              FROM hist1 WHERE NOT is_current
            UNION ALL
            SELECT h.customer_id, h.segment, h.email, h.signup_date, h.attribute_hash, h.valid_from,
              CASE WHEN k.customer_id IS NOT NULL THEN {TS2} ELSE h.valid_to END,
              CASE WHEN k.customer_id IS NOT NULL THEN false ELSE true END
              FROM cur1 h LEFT JOIN changed k ON h.customer_id = k.customer_id
            UNION ALL
            SELECT customer_id, segment, email, signup_date, attribute_hash, {TS2}, CAST(NULL AS TIMESTAMP), true
              FROM changed""",
    ),
    "customers_normalized": _q([CRM, BCUST1] + customers_ctes("1", "bcust1")[:1], f"SELECT {NORMALIZED} FROM cn1"),
    "customers_invalid": _q(
        [CRM, BCUST1] + customers_ctes("1", "bcust1")[:2],
        "SELECT customer_id, email, _quarantine_reason FROM ccl1 WHERE _quarantine_reason IS NOT NULL",
    ),
    "customers_valid": _q([CRM, BCUST1] + customers_ctes("1", "bcust1"), f"SELECT {NORMALIZED} FROM cinc1"),
    "customers_quarantine": _q(
        [CRM, BCUST1] + customers_ctes("1", "bcust1")[:2] + [quarantine_cte("qcust", "ccl1", "customer", CUSTOMER_PAYLOAD)],
        "SELECT * FROM qcust",
    ),
    "products_valid": _q([PR, BPROD1] + products_ctes("1", "bprod1"), f"SELECT {PRODUCT_SELECT} FROM prod1"),
    "products_quarantine": _q(
        [PR, BPROD1] + products_ctes("1", "bprod1") + [quarantine_cte("qprod", "pcl1", "product", PRODUCT_PAYLOAD)],
        "SELECT * FROM qprod",
    ),
    "orders_ref_check": _q(BASE, "SELECT order_id, customer_id, product_id, _customer_exists, _product_exists FROM ochk"),
    "orders_valid": _q(BASE, f"SELECT {SALES_SELECT} FROM sales"),
    "orders_quarantine": _q(BASE + QUARANTINE[2:3], "SELECT * FROM qord"),
    "quarantine_counts": _q(
        BASE + QUARANTINE, "SELECT _entity, _quarantine_reason, COUNT(*) AS rows FROM qall GROUP BY ALL"
    ),
    "order_financials": _q(
        [ORD, BORD] + orders_ctes("", "bord")[:3],
        "SELECT order_id, ordered_at, order_date, "
        + _dbl(["gross_amount", "net_amount"])
        + f", CAST({money('gross_amount - net_amount')} AS DOUBLE) AS discount_amount FROM ofin",
    ),
    "dim_customer": _q(ALL, "SELECT * FROM dimc"),
    "dim_product": _q(ALL, "SELECT product_id, product_name, category, "
                           + _dbl(["unit_cost", "list_price"]) + ", active FROM dimp"),
    "fact_sales": _q(
        ALL,
        "SELECT order_id, customer_id, product_id, order_date, ordered_at, quantity, "
        + _dbl(["gross_amount", "discount_amount", "net_amount", "cost_amount", "margin_amount"])
        + ", channel, status, currency FROM fact",
    ),
    "daily_sales": _q(ALL, "SELECT * FROM daily"),
    "customer_360": _q(ALL, "SELECT * FROM c360"),
    "product_performance": _q(ALL, "SELECT * FROM perf"),
    "quality_silver": _q(
        ALL,
        _checks(
            [
                ("order_id_not_null", "SELECT COUNT(*) FROM sales WHERE order_id IS NULL", "0 null rows"),
                ("order_id_unique", _dups("sales", "order_id"), "0 duplicate keys"),
                ("quantity_positive", "SELECT COUNT(*) FROM sales WHERE quantity <= 0", "0 zero/negative rows"),
                ("unit_price_non_negative", "SELECT COUNT(*) FROM sales WHERE unit_price < 0", "0 negative rows"),
                ("customer_id_not_null", "SELECT COUNT(*) FROM hist1 WHERE is_current AND customer_id IS NULL",
                 "0 null rows"),
                ("customer_id_unique", _dups("(SELECT * FROM hist1 WHERE is_current)", "customer_id"),
                 "0 duplicate keys"),
                ("product_id_unique", _dups("prod1", "product_id"), "0 duplicate keys"),
            ]
        ),
    ),
    "quality_raw": _q(
        FIXTURES + FIXTURES2 + customers_ctes("12", "(SELECT * FROM bcust1 UNION ALL SELECT * FROM bcust2)")[:1]
        + [landed("ptyped", "bprod1", PRODUCT_SRC, PRODUCT_TYPES), landed("otyped", "bord", ORDER_SRC, ORDER_TYPES)],
        _checks(
            [
                ("order_id_unique", _dups("otyped", "order_id"), "0 duplicate keys"),
                ("quantity_not_null", "SELECT COUNT(*) FROM otyped WHERE quantity IS NULL", "0 null rows"),
                ("quantity_positive", "SELECT COUNT(*) FROM otyped WHERE quantity <= 0", "0 zero/negative rows"),
                ("unit_price_non_negative", "SELECT COUNT(*) FROM otyped WHERE unit_price < 0", "0 negative rows"),
                ("orders_readable", "SELECT COUNT(*) FROM otyped WHERE _unreadable IS NOT NULL", "0 failing rows"),
                ("customer_id_unique", _dups("cn12", "customer_id"), "0 duplicate keys"),
                ("email_not_null", "SELECT COUNT(*) FROM cn12 WHERE email IS NULL", "0 null rows"),
                ("email_plausible", f"SELECT COUNT(*) FROM cn12 WHERE NOT regexp_matches(email, '{EMAIL}')", "0 failing rows"),
                ("product_id_not_null", "SELECT COUNT(*) FROM ptyped WHERE product_id IS NULL", "0 null rows"),
                ("product_id_unique", _dups("ptyped", "product_id"), "0 duplicate keys"),
                ("unit_cost_non_negative", "SELECT COUNT(*) FROM ptyped WHERE unit_cost < 0", "0 negative rows"),
                ("unit_cost_not_null", "SELECT COUNT(*) FROM ptyped WHERE unit_cost IS NULL", "0 null rows"),
            ]
        ),
    ),
    "quarantine_idempotent": _q(
        BASE + orders_ctes("r1", "bord1") + [quarantine_cte("qr1", "oclr1", "order", ORDER_PAYLOAD)] + QUARANTINE[2:3],
        """SELECT * FROM qr1 UNION ALL
           SELECT * REPLACE (DATE '1999-01-02' AS _quarantine_date) FROM qord
           WHERE _quarantine_id NOT IN (SELECT _quarantine_id FROM qr1)""",
    ),
    "bronze_from_landing": _q(
        [CRM, CRM2, PR, PR2, ORD],
        "SELECT entity, batch_date, _source_system, COUNT(*) AS rows, COUNT(DISTINCT record) AS records, 1::BIGINT AS batches FROM ("
        + " UNION ALL ".join(
            f"SELECT '{e}' AS entity, {day} AS batch_date, '{system}' AS _source_system, {json_text([(c, 'str') for c, _ in cols])} AS record FROM {src}"
            for e, system, src, cols, day in (
                ("customers", "crm_csv", "crm", CUSTOMER_SRC, D1), ("customers", "crm_csv", "crm2", CUSTOMER_SRC, "DATE '1999-01-02'"),
                ("products", "product_json", "pr", PRODUCT_SRC, D1), ("products", "product_json", "pr2", PRODUCT_SRC, "DATE '1999-01-02'"),
                ("orders", "commerce_csv", "(SELECT * REPLACE (CAST(ordered_at AS VARCHAR) AS ordered_at) FROM ord)", ORDER_SRC,
                 "CAST(date_trunc('month', _delivered_at) AS DATE)"),
            )
        )
        + ") GROUP BY entity, batch_date, _source_system",
    ),
    "quality_gold": _q(
        ALL,
        _checks(
            [
                # xxhash64 is total (NULL hashes to the seed), so the surrogate key is never NULL.
                ("sales_key_not_null", "SELECT 0", "0 null rows"),
                ("order_id_unique", _dups("fact", "order_id"), "0 duplicate keys"),
                ("net_amount_non_negative", "SELECT COUNT(*) FROM fact WHERE net_amount < 0", "0 negative rows"),
                # Surrogate keys are a hash of the natural key: duplicates of one are duplicates of the other.
                ("customer_key_unique", _dups("dimc", "customer_id"), "0 duplicate keys"),
                ("product_key_unique", _dups("dimp", "product_id"), "0 duplicate keys"),
            ]
        ),
    ),
    "quarantine_rate": _q(
        BASE,
        """SELECT COUNT(*) AS rows, COUNT(_quarantine_reason) AS quarantined,
             CASE WHEN COUNT(*) > 0 THEN COUNT(_quarantine_reason) / COUNT(*) END AS rate,
             CAST(0.05 AS DOUBLE) AS ceiling, COALESCE(COUNT(_quarantine_reason) / COUNT(*) <= 0.05, true) AS passed
           FROM ocl""",
    ),
    "stage_summary": _q(
        ALL,
        """SELECT 'silver_customer_versions' AS table_name, COUNT(*) AS rows FROM hist1
           UNION ALL SELECT 'silver_products', COUNT(*) FROM prod1
           UNION ALL SELECT 'silver_sales', COUNT(*) FROM sales
           UNION ALL SELECT 'quarantined_customers', COUNT(*) FROM qcust
           UNION ALL SELECT 'quarantined_orders', COUNT(*) FROM qord
           UNION ALL SELECT 'dim_customers', COUNT(*) FROM dimc
           UNION ALL SELECT 'dim_products', COUNT(*) FROM dimp
           UNION ALL SELECT 'fact_sales', COUNT(*) FROM fact
           UNION ALL SELECT 'daily_sales_rows', COUNT(*) FROM daily
           UNION ALL SELECT 'customer_360_rows', COUNT(*) FROM c360
           UNION ALL SELECT 'product_performance_rows', COUNT(*) FROM perf""",
    ),
    "bq_daily_trend": _q(
        ALL,
        "SELECT order_date, CAST(SUM(net_revenue) AS DOUBLE) AS revenue, CAST(SUM(gross_margin) AS DOUBLE) AS margin "
        "FROM (SELECT order_date, ROUND(SUM(net_amount), 2) AS net_revenue, ROUND(SUM(margin_amount), 2) AS gross_margin "
        "FROM fact GROUP BY order_date, channel) GROUP BY order_date ORDER BY order_date",
    ),
    "bq_top_customers": _q(
        ALL,
        "SELECT customer_id, full_name, segment, lifetime_orders, lifetime_value, value_band FROM c360 "
        "ORDER BY lifetime_value DESC, customer_id LIMIT 20",
    ),
    "bq_best_products": _q(
        ALL,
        "SELECT category, product_name, units_sold, net_revenue, gross_margin FROM perf "
        "WHERE revenue_rank_in_category <= 5 ORDER BY category, revenue_rank_in_category, product_name",
    ),
    "bq_channel_mix": _q(
        ALL,
        "SELECT channel, CAST(SUM(orders) AS BIGINT) AS orders, CAST(SUM(net_revenue) AS DOUBLE) AS revenue "
        "FROM (SELECT channel, COUNT(DISTINCT order_id) AS orders, ROUND(SUM(net_amount), 2) AS net_revenue "
        "FROM fact GROUP BY order_date, channel) GROUP BY channel ORDER BY revenue DESC",
    ),
}

# A key is good if it is as distinct as its natural key and never negative; the hash itself has no DuckDB form.
ORACLE["surrogate_keys"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, count(*) AS key_rows, count(DISTINCT {natural}) AS natural_keys, count(DISTINCT {natural}) AS surrogate_keys, "
    f"0::BIGINT AS negative_keys FROM ({ORACLE[table]}) AS t_{kind}"
    for kind, table, natural in (("customer", "dim_customer", "customer_id"), ("product", "dim_product", "product_id"), ("sale", "fact_sales", "order_id"))
)
