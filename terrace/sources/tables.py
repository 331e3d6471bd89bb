"""Table scans: the driver's Parquet tables and published lakehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


_LOADED: dict[tuple[str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``); pruning and pushdown stay with the scan.

    The driver's tables are read-only, so the resolved relation (file listing and
    footer schema) is kept per session instead of being re-listed by every query.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        owner = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. a Spark Connect session)
        owner = str(id(spark))
    key = (owner, path)
    if key not in _LOADED:
        _LOADED[key] = spark.read.parquet(path)
    return _LOADED[key]


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable table (first load vs merge decision)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem is the public way to test a path
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(conf)
    return bool(fs.exists(hpath))


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a Parquet table, or an empty frame of ``schema`` when it does not exist yet."""
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
