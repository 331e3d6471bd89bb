"""Helpers shared by the operators: staged tables, document keys, folds, hash-bounded samples."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(staged: DataFrame) -> None:
    """Delete the folder of a :func:`stage` that nothing reads any more."""
    spark = staged.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001 - Hadoop FileSystem is the portable way to delete
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def texts_of(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (null becomes empty): extra columns never reach an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def held_out(doc_id: Column) -> Column:
    """The test fold: crc32 of the id as text, modulo 3, is 1 (a null id counts as the empty text: not held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def hash_bounded(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """At most ``bound`` rows, chosen by a hash of ``key``; every row when there are no more than that."""
    h = F.xxhash64(key, F.lit("sample"))
    n = df.count()
    if n <= bound:
        return df
    share = int(2**30 * min(1.0, 1.2 * bound / n))
    return df.filter(F.pmod(h, F.lit(2**30)) < share).orderBy(h).limit(bound)


def unused_name(df: DataFrame) -> str:
    """A column name that no column of ``df`` has."""
    while (name := f"c_{uuid.uuid4().hex}") in df.columns:
        pass
    return name
