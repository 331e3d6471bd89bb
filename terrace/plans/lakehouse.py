"""Stage runner: Bronze → Silver → Gold over a lakehouse folder.

Thin composition of the pure plans with the sinks. Counts come from
``DataFrame.observe`` on the writes (no extra jobs); frames read several times
are cut at a written table in the shared checkpoint folder, so a lost executor
recomputes from that table, not from the landing files.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.operators import quality as Q
from terrace.operators import rules as R
from terrace.operators.lineage import default_batch_id
from terrace.operators.merge import insert_only, upsert
from terrace.operators.scd2 import apply_scd2, first_load
from terrace.plans import bronze as B
from terrace.plans import gold as G
from terrace.plans import questions
from terrace.plans import silver as S
from terrace.session import fresh_path
from terrace.sinks import publish
from terrace.sources.contracts import PARTITION_COLUMN

# Physical layout: partition columns per table. Date-keyed tables are partitioned
# by month: daily partitions over a multi-year history give thousands of
# directories (one or more files each) whatever the data volume, while a month
# of a large history is still split into many files by the rebalancing writer.
LAYOUT = {
    "customers": ["_version_state"],
    "sales": ["order_month"],
    "fact_sales": ["order_month"],
    "daily_sales": ["order_month"],
    "quarantine": ["_quarantine_date"],
}
LAYOUT_COLUMNS = {
    "order_month": lambda: F.trunc(F.col("order_date"), "month"),
    # SCD2 history: closed versions never change, current ones are rewritten each run
    "_version_state": lambda: F.when(F.col("is_current"), F.lit("current")).otherwise(F.lit("closed")),
}


def with_layout(df: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    """Add derived partition columns for ``table``; returns the frame and its partition columns."""
    parts = LAYOUT.get(table, [])
    for col in parts:
        if col in LAYOUT_COLUMNS and col not in df.columns:
            df = df.withColumn(col, LAYOUT_COLUMNS[col]())
    return df, parts


def without_layout(df: DataFrame | None) -> DataFrame | None:
    """Drop derived partition columns after a read."""
    if df is None:
        return None
    return df.drop(*[c for c in LAYOUT_COLUMNS if c in df.columns])


@dataclass(frozen=True)
class SilverChecks:
    """Switches of the Silver gate. The rate ceiling is off by default (declared but
    not enforced in the source configuration); set it to gate on it."""

    require_unique_order_id: bool = True
    require_positive_quantity: bool = True
    require_non_negative_price: bool = True
    max_order_quarantine_rate: float | None = None


@dataclass(frozen=True)
class Lakehouse:
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def view(self, layer: str, table: str) -> str:
        """Catalog name of a table that is replaced whole; lakes of different roots do not share names."""
        return f"lake_{hashlib.sha256(self.root.rstrip('/').encode()).hexdigest()[:12]}_{layer}_{table}"


@dataclass(frozen=True)
class Change:
    """What a run would make of a table (``after``), and how to make it so; nothing has changed before ``publish()``."""

    after: DataFrame
    publish: Callable[[], None]
    changed: bool = True


def _observed_rows(obs: Observation, otherwise: Callable[[], int]) -> int:
    """Rows counted by an observation; ``otherwise()`` where AQE has replaced the observed plan by an empty relation, so
    that the counting node never ran."""
    try:
        return int(obs.get["rows"])
    except Exception:  # noqa: BLE001 - py4j raises a generic error for a missing metrics row
        return otherwise()


def _append_observed(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = (), **how) -> int:
    obs = Observation(name)
    publish.append(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_by, **how)
    return _observed_rows(obs, lambda: 0)  # what is written is observed at its very top: no node, no row


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back (lineage cut)."""
    path = fresh_path(spark, f"stage-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ----------------------------------------------------------------------------- bronze
def run_bronze(
    spark: SparkSession,
    lake: Lakehouse,
    deliveries: Mapping[str, DataFrame],
    partition_by: Mapping[str, Sequence[str]] | None = None,
    dates: Mapping[str, Sequence[str]] | None = None,
    by_file: bool = False,
) -> list[dict]:
    """Insert-only merge of stamped deliveries into Bronze; returns seen/inserted per entity.

    Bronze is partitioned by ``batch_date`` where the delivery has it, unless ``partition_by`` says otherwise;
    ``dates`` are the delivery dates of an entity, where the caller knows them. ``by_file`` says that rows are read from
    files of one ``batch_date`` each: a first load is then written as it is read, with no more files than were delivered
    or tasks read them, and its rows are not shuffled.
    """
    out = []
    for entity, stamped in deliveries.items():
        path = lake.path("bronze", entity)
        parts = (partition_by or {}).get(entity, [PARTITION_COLUMN] if PARTITION_COLUMN in stamped.columns else ())
        seen_obs = Observation(f"seen_{entity}")
        seen = stamped.observe(seen_obs, F.count(F.lit(1)).alias("rows"))
        if publish.exists(spark, path):
            new, first = B.new_records(spark.read.parquet(path), seen, (dates or {}).get(entity), counted=stamped), False
        else:
            new, first = seen, True
        as_read = first and by_file and list(parts) == [PARTITION_COLUMN]
        inserted = _append_observed(new, f"inserted_{entity}", path, parts, compression=B.COMPRESSION, rebalance=not as_read)
        out.append({"entity": entity, "rows_seen": _observed_rows(seen_obs, stamped.count), "rows_inserted": inserted})
    return out


def ingest_landing(
    spark: SparkSession,
    lake: Lakehouse,
    landing_root: str,
    batch_id: str | None = None,
    as_of: _dt.datetime | None = None,
    since: str | _dt.date | None = None,
    entities: Sequence[str] = B.ENTITIES,
) -> list[dict]:
    """All feeds of a landing zone into Bronze in one call: scan, stamp, insert what is new.

    ``batch_id`` defaults to the clock (:func:`terrace.operators.lineage.default_batch_id`); ``since`` leaves out
    older deliveries, in the landing zone and in the Bronze partitions that are looked at.
    """
    batch_id = batch_id or default_batch_id()
    stamped = {e: B.stamped_delivery(spark, landing_root, e, batch_id, as_of, since) for e in entities}
    return run_bronze(spark, lake, stamped, dates={e: B.delivery_dates(spark, landing_root, e, since) for e in entities}, by_file=True)


# ----------------------------------------------------------------------------- silver
def older_versions(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The rows of ``target`` whose key is also incoming.

    Only keys between the least and the greatest incoming one are looked at, a filter that reaches the scan: files and
    row groups whose own range of keys lies outside are not read. Keys that rise with time thus leave out all months but
    those near the delivery's; for keys in no order every month is read, as its range holds them. A NULL key has no
    older version.
    """
    least, greatest = incoming.agg(F.min(key), F.max(key)).first()
    if least is None:
        return target.filter(F.lit(False))
    within = F.col(key).between(F.lit(least), F.lit(greatest))
    return target.filter(within).join(incoming.select(key), key, "left_semi")


def upsert_change(spark: SparkSession, path: str, incoming: DataFrame, key: str, table: str) -> Change:
    """Upsert into a partitioned table by rewriting only the partitions it touches.

    Touched partitions are those of the incoming rows plus those still holding an
    older version of an incoming key (a key may move, e.g. a corrected order
    date). Only their rows are read and merged; the merged rows are staged in the
    checkpoint folder (the live table is never overwritten from itself) and, once
    published, replace exactly those partitions. The touched values are partition values
    (months) — a bounded list, not data. A partition left empty by the merge is
    deleted.
    """
    incoming, parts = with_layout(incoming, table)
    if not publish.exists(spark, path):
        first = stage(spark, incoming, f"{table}-first")
        return Change(without_layout(first), lambda: publish.overwrite(first, path, parts))
    target = spark.read.parquet(path)
    holding = older_versions(target, incoming, key).select(*parts)
    touched = [r[0] for r in incoming.select(*parts).union(holding).distinct().collect()]
    col = parts[0]
    among = F.col(col).isin([v for v in touched if v is not None])
    among = F.coalesce(among, F.lit(None in touched))
    merged = stage(spark, upsert(target.filter(among), incoming, key), f"{table}-merge")
    written = {r[0] for r in merged.select(col).distinct().collect()}  # partition values (bounded), of the staged rows

    def replace() -> None:
        publish.overwrite_partitions(merged, path, parts)
        publish.delete_partitions(spark, path, col, [v for v in touched if v not in written])

    return Change(without_layout(target.filter(~among).unionByName(merged)), replace)


def upsert_partitions(spark: SparkSession, path: str, incoming: DataFrame, key: str, table: str) -> None:
    """:func:`upsert_change`, published at once."""
    upsert_change(spark, path, incoming, key, table).publish()


def _append_quarantine(spark: SparkSession, lake: Lakehouse, rows: DataFrame) -> int:
    """Append the quarantine rows of a run that are not there yet: one look at the table for all entities."""
    path = lake.path("silver", "quarantine")
    if publish.exists(spark, path):
        rows = insert_only(spark.read.parquet(path), rows, "_quarantine_id")
    return _append_observed(rows, "quarantine", path, LAYOUT["quarantine"])


def read_current_versions(spark: SparkSession, path: str) -> DataFrame:
    """Current SCD2 versions only (partition pruning on the version state)."""
    return without_layout(spark.read.parquet(path).filter(F.col("_version_state") == "current"))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return without_layout(spark.read.parquet(path))


def history_change(spark: SparkSession, path: str, incoming: DataFrame, key: str, as_of: _dt.datetime) -> Change:
    """SCD2 change that rewrites only the current versions; ``after`` holds the current versions alone.

    The history table is partitioned by version state. Closed versions never
    change: a run computes the new versions from the current ones with
    :func:`terrace.operators.scd2.apply_scd2`; publishing appends those it closed (insert-only
    on ``(key, valid_from)`` against all closed ones) and replaces the current
    partition. These are two commits; a run that crashes between them is mended by
    the next one, whatever its ``as_of``: a version already closed is not closed again. ``changed`` is False (and
    publishing writes nothing) when the delivery changes nothing (the reference's skip-if-unchanged probe).
    """
    if not publish.exists(spark, path):
        first = stage(spark, first_load(incoming, as_of), "scd2-first")
        laid, parts = with_layout(first, "customers")
        return Change(first, lambda: publish.overwrite(laid, path, parts))
    current = read_current_versions(spark, path)
    # One evaluation of the change join: versions are staged while counting the
    # versions this run opened; none opened means nothing changed.
    versions = stage(spark, apply_scd2(current, incoming, key, as_of, opened_flag="_opened"), "scd2-versions")
    if versions.filter("_opened").isEmpty():
        return Change(current, lambda: None, changed=False)
    versions = versions.drop("_opened")

    def replace() -> None:
        closed_before = without_layout(spark.read.parquet(path).filter(F.col("_version_state") != "current"))
        new_closed = insert_only(closed_before, versions.filter(~F.col("is_current")), [key, "valid_from"])
        laid, parts = with_layout(new_closed, "customers")
        publish.append(laid, path, parts)
        laid_current, _ = with_layout(versions.filter(F.col("is_current")), "customers")
        publish.overwrite_partitions(laid_current, path, parts)

    return Change(versions.filter(F.col("is_current")), replace)


def apply_history(spark: SparkSession, path: str, incoming: DataFrame, key: str, as_of: _dt.datetime) -> bool:
    """:func:`history_change`, published at once; returns whether anything changed."""
    change = history_change(spark, path, incoming, key, as_of)
    change.publish()
    return change.changed


def run_silver(
    spark: SparkSession,
    lake: Lakehouse,
    batch_id: str,
    as_of: _dt.datetime,
    enforce: bool = True,
    checks: SilverChecks = SilverChecks(),
    since: _dt.date | None = None,
) -> dict:
    """One Silver run over Bronze: every table's new rows are staged, then audited, then published.

    A gate that fails leaves every Silver table, the quarantine included, as it was (its evidence file is written).
    By default every Bronze row is re-derived (so an order quarantined for a
    dimension that arrived late is admitted by a later run). With ``since``, only
    Bronze orders ingested on or after that date are read — partition pruning on
    ``_ingestion_date`` — and upserted: the cost follows the increment, at the
    price of not re-examining older quarantined orders.
    """
    qdate = as_of.date()
    # customers: normalise → validate → latest → SCD2. Classification is a projection: two
    # column-pruned scans of Bronze are cheaper than writing a copy of it, so it is not staged.
    c_cls = S.customers_classified(spark.read.parquet(lake.path("bronze", "customers")))
    c_path = lake.path("silver", "customers")
    customers = history_change(spark, c_path, S.customers_incoming(c_cls), "customer_id", as_of)

    # products: validate → latest → upsert
    p_cls = S.products_classified(spark.read.parquet(lake.path("bronze", "products")))
    incoming = S.products_valid(p_cls)
    p_view = lake.view("silver", "products")
    known = publish.read_view(spark, p_view)
    p_path = publish.write_fresh(incoming if known is None else upsert(known, incoming, "product_id"), lake.path("silver", "products"))
    products = spark.read.parquet(p_path)

    # orders: latest → financials → reference flags → classify
    bo = spark.read.parquet(lake.path("bronze", "orders"))
    if since is not None:
        bo = bo.filter(F.col("_ingestion_date") >= F.lit(since))
    # Orders: window + joins, read three times (quarantine, sales, rate) → staged once;
    # the quarantine rate is counted from it.
    o_cls = stage(spark, S.orders_classified(S.orders_checked(bo, customers.after, products)), "orders-classified")
    counted = o_cls.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(R.REASON).isNotNull()).alias("quarantined")).first()
    rows, bad = counted.rows, counted.quarantined
    rate = {"rows": rows, "quarantined": bad, "rate": bad / rows if rows else None,
            "ceiling": checks.max_order_quarantine_rate}
    s_path = lake.path("silver", "sales")
    sales = upsert_change(spark, s_path, S.sales_rows(o_cls), "order_id", "sales")
    sales_checks = [Q.not_null("order_id")]
    sales_checks += [Q.unique("order_id")] if checks.require_unique_order_id else []
    sales_checks += [Q.positive("quantity")] if checks.require_positive_quantity else []
    sales_checks += [Q.non_negative("unit_price")] if checks.require_non_negative_price else []
    results = Q.suite(
        [
            (sales.after, sales_checks),
            (customers.after, [Q.not_null("customer_id"), Q.unique("customer_id")]),
            (products, [Q.unique("product_id")]),
        ]
    )
    evidence = Q.report(results, "silver", as_of)
    evidence["quarantine_rate"] = rate
    if checks.max_order_quarantine_rate is not None:
        within = rate["rate"] is None or rate["rate"] <= checks.max_order_quarantine_rate
        evidence["checks"].append(
            {"name": "order_quarantine_rate", "passed": within, "actual": rate["quarantined"],
             "expectation": f"rate <= {checks.max_order_quarantine_rate}"}
        )
        evidence["passed"] = evidence["passed"] and within
    if enforce:
        Q.gate(spark, evidence, lake.path("quality", f"silver-{batch_id}.json"))
    quarantined = stage(
        spark,
        S.customers_quarantine(c_cls, qdate).unionByName(S.products_quarantine(p_cls, qdate)).unionByName(S.orders_quarantine(o_cls, qdate)),
        "quarantine",
    )
    _append_quarantine(spark, lake, quarantined)
    customers.publish()
    publish.switch(spark, p_view, p_path)
    sales.publish()
    per_entity = {r["_entity"]: r["count"] for r in quarantined.groupBy("_entity").count().collect()}  # three rows
    return {"evidence": evidence, "quarantined_customers": per_entity.get("customer", 0), "quarantined_products": per_entity.get("product", 0),
            "quarantined_orders": per_entity.get("order", 0), "customers": c_path, "customers_changed": customers.changed,
            "products": p_path, "sales": s_path}


# ----------------------------------------------------------------------------- gold
def build_gold(spark: SparkSession, lake: Lakehouse, as_of: _dt.datetime) -> dict[str, DataFrame]:
    customers = read_current_versions(spark, lake.path("silver", "customers"))
    products = publish.read_view(spark, lake.view("silver", "products"))
    sales = without_layout(spark.read.parquet(lake.path("silver", "sales")))
    dim_c = G.dim_customer(customers)
    dim_p = G.dim_product(products)
    fact = stage(spark, G.fact_sales(sales, dim_c, dim_p), "fact-sales")  # read by three marts
    return {
        "dim_customer": dim_c,
        "dim_product": dim_p,
        "fact_sales": fact,
        "daily_sales": G.daily_sales(fact),
        "customer_360": G.customer_360(fact, dim_c, as_of.date()),
        "product_performance": G.product_performance(fact, dim_p),
    }


def run_gold(spark: SparkSession, lake: Lakehouse, as_of: _dt.datetime, enforce: bool = True) -> dict:
    """Write all six Gold tables to fresh folders, audit what was written, then switch their views to it.

    A run that fails in a write or a gate changes no table that is read.
    """
    written, tables = {}, {}
    for name, df in build_gold(spark, lake, as_of).items():
        laid_out, parts = with_layout(df, name)
        written[name] = publish.write_fresh(laid_out, lake.path("gold", name), parts)
        tables[name] = spark.read.parquet(written[name])
    results = Q.suite(
        [
            (tables["fact_sales"], [Q.not_null("sales_key"), Q.unique("order_id"), Q.non_negative("net_amount")]),
            (tables["dim_customer"], [Q.unique("customer_key")]),
            (tables["dim_product"], [Q.unique("product_key")]),
        ]
    )
    evidence = Q.report(results, "gold", as_of)
    if enforce:
        Q.gate(spark, evidence, lake.path("quality", f"gold-{as_of:%Y%m%dT%H%M%SZ}.json"))
    counts = {name: df.count() for name, df in tables.items()}  # from the footers of the written files
    for name, path in written.items():
        publish.switch(spark, lake.view("gold", name), path)
    return {"evidence": evidence, "rows": counts}


def read_gold(spark: SparkSession, lake: Lakehouse, table: str) -> DataFrame | None:
    """A published Gold table, or None before its first run."""
    return without_layout(publish.read_view(spark, lake.view("gold", table)))


def ask(spark: SparkSession, lake: Lakehouse, question: str) -> DataFrame:
    """Answer a business question from the published Gold tables."""
    return questions.ask(question, lambda table: read_gold(spark, lake, table))


def quarantine_summary(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    return R.quarantine_counts(spark.read.parquet(lake.path("silver", "quarantine")))
