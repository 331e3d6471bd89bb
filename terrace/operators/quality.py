"""Data-quality checks evaluated in as few passes as possible, and gates.

Row-predicate checks (not-null, non-negative, positive, custom) on one frame are
one aggregation with a ``count_if`` per check — one scan, partial aggregation on
every task, a single-row result. A uniqueness check needs a group-by on its key
(one shuffle, pre-aggregated map-side, so a hot key costs one row per task); the
row checks ride along on the first of these, so both kinds need one scan together.

Results are a small DataFrame ``(name, passed, actual, expectation)`` — one row
per check — collected only by the gate.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = "name string, passed boolean, actual bigint, expectation string"


@dataclass(frozen=True)
class Check:
    name: str
    kind: str  # "rows" (count rows failing ``failing``) or "unique"
    column: str
    expectation: str
    failing: Column | None = None


def not_null(column: str) -> Check:
    return Check(f"{column}_not_null", "rows", column, "0 null rows", F.col(column).isNull())


def non_negative(column: str) -> Check:
    """NULL passes (a NULL comparison is not a failure)."""
    return Check(f"{column}_non_negative", "rows", column, "0 negative rows", F.col(column) < 0)


def positive(column: str) -> Check:
    """NULL passes."""
    return Check(f"{column}_positive", "rows", column, "0 zero/negative rows", F.col(column) <= 0)


def unique(column: str) -> Check:
    """Counts keys that occur more than once; NULL counts as one key."""
    return Check(f"{column}_unique", "unique", column, "0 duplicate keys")


def row_rule(name: str, failing: Column, expectation: str = "0 failing rows") -> Check:
    return Check(name, "rows", name, expectation, failing)


def _result(name: Column | str, actual: Column, expectation: str) -> list[Column]:
    return [
        (F.lit(name) if isinstance(name, str) else name).alias("name"),
        (actual == 0).alias("passed"),
        actual.cast("bigint").alias("actual"),
        F.lit(expectation).alias("expectation"),
    ]


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate checks on one frame; one row per check with ``_order`` = list position.

    The frame is read once for all row checks and the first uniqueness check, whose groups carry the
    failing rows of the others; each further uniqueness check is a group-by of its own.
    """
    rows = [(i, c) for i, c in enumerate(checks) if c.kind == "rows"]
    unique = [(i, c) for i, c in enumerate(checks) if c.kind == "unique"]
    failing = [F.count_if(c.failing).alias(f"_c{i}") for i, c in rows]
    passes: list[tuple[DataFrame, list[tuple[int, Check]]]] = []
    for n, (i, c) in enumerate(unique):
        groups = df.groupBy(F.col(c.column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *(failing if n == 0 else []))
        with_rows = rows if n == 0 else []
        sums = [F.coalesce(F.sum(f"_c{r}"), F.lit(0)).alias(f"_c{r}") for r, _ in with_rows]
        passes.append((groups.agg(F.count_if(F.col("_n") > 1).alias(f"_c{i}"), *sums), [(i, c), *with_rows]))
    if rows and not unique:
        passes.append((df.agg(*failing), rows))
    parts = [
        agg.select(F.inline(F.array(*[F.struct(*_result(c.name, F.col(f"_c{i}"), c.expectation), F.lit(i).alias("_order")) for i, c in of])))
        for agg, of in passes
    ]
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA + ", _order int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def suite(frames: Sequence[tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """Union of several frames' results in one DataFrame (one job when collected)."""
    out = None
    offset = 0
    for df, checks in frames:
        r = run_checks(df, checks).withColumn("_order", F.col("_order") + F.lit(offset))
        offset += len(checks)
        out = r if out is None else out.unionByName(r)
    return out


def report(results: DataFrame, stage: str, generated_at: _dt.datetime | None = None) -> dict:
    """Collect the (small) result frame into the evidence document."""
    rows = sorted(results.collect(), key=lambda r: r["_order"] if "_order" in r else 0)
    items = [
        {"name": r["name"], "passed": bool(r["passed"]), "actual": int(r["actual"]), "expectation": r["expectation"]}
        for r in rows
    ]
    return {
        "stage": stage,
        "generated_at": (generated_at or _dt.datetime.now(_dt.UTC)).isoformat(),
        "passed": all(i["passed"] for i in items),
        "checks": items,
    }


class QualityGateError(ValueError):
    pass


def write_evidence(spark: SparkSession, evidence: dict, path: str) -> None:
    """Write the evidence document as one JSON file through the Hadoop FileSystem
    API (works on any shared storage the cluster mounts; no Spark job needed)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(json.dumps(evidence, indent=2).encode("utf-8")))
    finally:
        out.close()


def gate(spark: SparkSession, evidence: dict, path: str | None = None) -> dict:
    """Write the evidence (if a path is given), then raise naming failed checks."""
    if path is not None:
        write_evidence(spark, evidence, path)
    if not evidence["passed"]:
        failed = [c["name"] for c in evidence["checks"] if not c["passed"]]
        raise QualityGateError(f"Data quality failed at {evidence['stage']}: {', '.join(failed)}")
    return evidence


def quarantine_rate(classified: DataFrame, ceiling: float = 0.05, reason_col: str = "_quarantine_reason") -> DataFrame:
    """Share of rows with a reason, against a ceiling — one aggregation."""
    total = F.count(F.lit(1))
    bad = F.count_if(F.col(reason_col).isNotNull())
    return classified.agg(
        total.alias("rows"),
        bad.alias("quarantined"),
        F.when(total > 0, bad / total).alias("rate"),
        F.lit(ceiling).alias("ceiling"),
    ).withColumn("passed", F.coalesce(F.col("rate") <= F.col("ceiling"), F.lit(True)))
