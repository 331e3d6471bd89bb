"""terrace — a layered retail lakehouse written as plain Spark DataFrame operators.

Layers:
  * bronze  — contract-checked ingestion with lineage and record identity,
              idempotent insert-only merge;
  * silver  — normalisation, rule validation with reason codes, quarantine,
              latest-per-key dedupe, referential checks, SCD2 history, upserts;
  * gold    — star schema with surrogate keys, daily / customer / product marts;
  * quality — one-pass checks and gates; SQL questions over the gold tables.

Every operator is ``DataFrame -> DataFrame`` built from Catalyst built-ins (no
Python UDFs), so scans keep predicate/column pushdown and stages stay inside
whole-stage codegen. I/O lives only in :mod:`terrace.sources` and
:mod:`terrace.sinks`.
"""

__version__ = "0.1.0"
