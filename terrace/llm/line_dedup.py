"""Line dedup: lines that many documents hold stay in one document only.

Lines are exploded, normalised and hashed; the distinct documents of each hash are counted; lines whose hash is
over the threshold are dropped, and what stays is put together again by position. DataFrame functions only.

A hash is two 64-bit hashes with different seeds. Documents of a hash are counted by ``(hash, document)`` first and
by hash then, both with partial aggregation, so a line that every document holds is spread over all tasks. Texts
are shuffled only to meet the positions of their dropped lines, and not even then where Spark finds these few enough
to broadcast (``spark.sql.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stage, texts_of

MIN_CHARS = 40
MIN_DOCUMENTS = 5
# What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    """The lines of a text, split at every line feed; an empty text is one empty line."""
    return F.split(text, "\n", -1)


def normalised(line: Column) -> Column:
    """A line without blanks at its ends and with A-Z in lower case; other letters stay as they are."""
    key = F.btrim(line, F.lit(BLANKS))
    # lower() changes A-Z only where all characters are ASCII, and is several times faster there
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(F.translate(key, _UPPER, _UPPER.lower()))


def hashed_lines(texts: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, h, at, a, b)``: every line with a key of ``min_chars`` code points or more, its position and hashes.

    ``texts`` has ``doc_id, text, h``.
    """
    lines = texts.select("doc_id", "h", F.posexplode(lines_of(F.col("text"))).alias("at", "line"))
    long = lines.filter(F.length(F.btrim("line", F.lit(BLANKS))) >= min_chars).select("doc_id", "h", "at", normalised(F.col("line")).alias("key"))
    return long.select("doc_id", "h", "at", F.xxhash64("key").alias("a"), F.xxhash64(F.lit("second"), "key").alias("b"))


def frequent_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``(a, b, keeper)``: hashes in at least ``min_documents`` distinct documents, with the largest ``doc_id``."""
    documents = lines.select("a", "b", "doc_id").groupBy("a", "b", "doc_id").agg(F.lit(1).alias("one"))
    return documents.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).filter(F.col("n") >= min_documents).drop("n")


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)``, one row per input row: texts without the lines that others hold too.

    A line whose key has at least ``min_chars`` code points and is in at least ``min_documents`` documents stays only
    in the document with the largest id that holds it, there at all its places. A null text is an empty one, which
    is one empty line; null ids are one document, which comes before all others; rows with the same id are one
    document, and each of them is cleaned; repeated rows stay; an empty table gives no rows; other columns are
    ignored. A text whose lines all go becomes empty.
    """
    texts = texts_of(docs).select("doc_id", "text", F.xxhash64("text").alias("h"))
    lines = stage(hashed_lines(texts, min_chars), "line-hashes")
    frequent = stage(frequent_lines(lines, min_documents), "line-frequent")
    dropped = lines.join(frequent, ["a", "b"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    places = stage(dropped.groupBy("doc_id", "h").agg(F.collect_set("at").alias("gone")), "line-dropped")
    places = places.withColumnsRenamed({"doc_id": "doc", "h": "text_h"})
    met = texts.join(places, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("h") == F.col("text_h")), "left")
    left = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    # one element of an array, so that the lines are bound once and not split anew for every place
    kept = F.transform(F.array(lines_of(F.col("text"))), lambda lines: F.array_join(F.transform(left(lines), lambda i: F.get(lines, i)), "\n"))[0]
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    return met.select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
