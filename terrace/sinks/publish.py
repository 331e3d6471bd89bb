"""Publishing without a table format.

* Bronze and quarantine are **append-only**: only rows that an insert-only merge
  found new are appended; existing files are never rewritten.
* Silver products and the Gold tables are **replaced whole**: a run writes each of
  them to a fresh folder, audits what it has written, and only then points the
  table's view in Spark's catalog to the new folder. A reader sees the old table or
  the new one; a run that dies before leaves nothing but a folder that no view names.
  Views outlive the application where the cluster's catalog does (a metastore); old
  folders are kept for readers that still hold them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem is the portable listing API
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath  # noqa: SLF001


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], rebalance: bool = True):
    """Partitioned writes go through a ``rebalance`` on the partition columns.

    Without it every task writes one file per partition value it holds
    (tasks × values tiny files). ``rebalance`` hash-clusters rows by value and
    lets AQE coalesce small partitions and split a skewed one (a date holding a
    third of the rows is written by several tasks, not one).
    """
    if partition_by:
        return (df.hint("rebalance", *partition_by) if rebalance else df).write.mode(mode).partitionBy(*partition_by)
    return df.write.mode(mode)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str | None = None, rebalance: bool = True) -> None:
    """Append rows; without ``rebalance`` every task writes what it holds, for rows that are read by partition already."""
    writer = _writer(df, "append", partition_by, rebalance)
    (writer.option("compression", compression) if compression else writer).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """First load of a table that is changed by partitions later. The frame must not read ``path`` itself."""
    _writer(df, "overwrite", partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite).

    ``df`` must not read ``path`` (stage it first). Untouched partitions keep their
    files, so the cost is proportional to what changed, not to the table.
    """
    _writer(df, "overwrite", partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)


def delete_partitions(spark: SparkSession, path: str, column: str, values: Sequence) -> None:
    """Remove partition directories ``column=value`` (partitions emptied by a merge; None is Hive's default partition)."""
    for value in values:
        folder = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        fs, p = _fs(spark, f"{path.rstrip('/')}/{column}={folder}")
        if fs.exists(p):
            fs.delete(p, True)


def write_fresh(df: DataFrame, table_root: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` to a new folder under ``table_root``, which nobody reads yet; returns its path."""
    path = f"{table_root.rstrip('/')}/{uuid.uuid4().hex}"
    _writer(df, "errorifexists", partition_by).parquet(path)
    return path


def switch(spark: SparkSession, view: str, path: str) -> None:
    """Make the folder ``path`` the current content of ``view``: one change of the session's catalog."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")


def read_view(spark: SparkSession, view: str) -> DataFrame | None:
    """The current content of ``view``, or None before its first :func:`switch`."""
    return spark.table(view) if spark.catalog.tableExists(view) else None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed: an aborted first write leaves nothing but ``_temporary``."""
    fs, p = _fs(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(p)] if fs.exists(p) else []
    return any(name[0] not in "_." or "=" in name for name in names)  # files, or folders of partitions
