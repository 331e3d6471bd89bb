"""Paths and helpers shared by the test modules."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
