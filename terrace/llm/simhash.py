"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh, 2016).

Fingerprints: 64-bit majority vote over the XXH64 (seed 42) of word shingles. Candidates: for radius r, each bit
position gets a non-zero vector of r+1 bits; table v (every non-zero vector of r+1 bits) keeps the positions whose
vector has an odd product with v. Any r positions leave some v orthogonal to all their vectors, so every pair
within r differing bits agrees on all kept positions of at least one of the 2^(r+1)-1 tables.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stage, texts_of, unused_name
from terrace.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
#: Buckets up to this size are compared pair by pair; the members of larger ones meet in half-way points.
PAIRWISE_BUCKET = 48
_CHUNK = 1 << 16


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a whole text; zero when it has no word."""
    w = text.encode("utf-8", "replace").lower().split()  # bytes: lower-cases A-Z only, splits at ASCII white space only
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        m = min(_CHUNK, n - at)
        shingles = map(b" ".join, zip(*(w[at + i : at + i + m] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, m)
        votes += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(m, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _signed_fingerprints(b.column(1), words)], ["doc_id", "fp"])

    return texts_of(docs).mapInArrow(run, "doc_id long, fp long")


def _signed_fingerprints(texts: pa.Array, words: int) -> pa.Array:
    return pa.array(np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64).view(np.int64))


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """One mask per non-zero vector v of radius+1 bits: the positions whose vector has an odd product with v."""
    size = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((i % size + 1) & v).bit_count() & 1) for v in range(1, size + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(classes: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """Edges ``(src, dst)`` whose components are those of all pairs of ``fp`` within ``radius`` bits (1 or 2).

    ``classes`` holds distinct fingerprints. Small buckets give every verified pair. For a larger bucket every
    member is sent to the points at most one bit away from it: two fingerprints at most two bits apart share such a
    point, and all that share one are at most two bits apart, so a star around its smallest member loses no link.
    A point has at most 65 members, hence work stays linear in the size of the bucket.
    """
    if radius not in (1, 2):
        raise ValueError("the half-way points of large buckets serve a radius of 1 or 2")
    keyed = classes.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in covering_masks(radius)])).alias("t", "key"),
    )
    large = stage(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > PAIRWISE_BUCKET), "sim-large")
    flagged = keyed.join(large, ["t", "key"], "left")
    apart = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= radius
    bucket = flagged.filter("n is null").groupBy("t", "key").agg(F.collect_list("fp").alias("m")).filter(F.size("m") > 1)
    small = bucket.select("m", F.explode("m").alias("src")).select(
        "src", F.explode(F.filter("m", lambda x: (x > F.col("src")) & apart(x, F.col("src")))).alias("dst")
    )
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    crowd = flagged.filter("n is not null").select("fp").distinct()
    point = crowd.select("fp", F.explode(near).alias("x")).groupBy("x").agg(F.collect_list("fp").alias("m")).filter(F.size("m") > 1)
    if radius == 1:  # all are one bit away from the point itself, where that is a fingerprint
        point = point.filter("array_contains(m, x)").select("m", F.col("x").alias("src"))
    else:
        point = point.select("m", F.array_min("m").alias("src"))
    star = point.select("src", F.explode("m").alias("dst")).filter("src <> dst")
    return small.select("src", "dst").union(star.select("src", "dst")).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per input row.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most ``radius`` differing bits. Null or
    empty texts have fingerprint zero and link like any other; a null id is a member but never names a component
    (a component of null ids only has a null ``component_id``); repeated rows stay; an empty table gives no rows;
    other columns are ignored. Equal fingerprints are one node from the start, so copies never form pairs.
    """
    fps = stage(fingerprints(docs, words), "sim-fp")
    names = stage(_least_of_component(fps, F.col("doc_id"), radius), "sim-names")
    return fps.join(names, "fp").select("doc_id", "fp", F.col("least").alias("component_id"))


def representatives(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the smallest ``doc_id`` (null ids last).

    Among rows of one id the smallest hash of the text decides; of rows equal in id and text one is kept.
    """

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _signed_fingerprints(b.column(2), words)], ["doc_id", "doc_key", "fp"])

    key = unused_name(docs)
    rows = docs.withColumn(key, F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h")))
    texts = rows.select(F.col(f"{key}.id").alias("doc_id"), F.col(f"{key}.h").alias("doc_key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    fps = stage(texts.mapInArrow(run, "doc_id long, doc_key long, fp long"), "sim-fp")
    least = _least_of_component(fps, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_key"), radius)
    kept = stage(least.select(F.struct(F.col("least.doc_id").alias("id"), F.col("least.doc_key").alias("h")).alias(key)).distinct(), "sim-kept")
    whole = F.coalesce(F.col(f"{key}.id"), F.lit(0)), F.col(f"{key}.id").isNull(), F.col(f"{key}.h")
    names = [unused_name(docs) for _ in whole]
    spread = lambda df: df.select("*", *[c.alias(n) for c, n in zip(whole, names)])
    return spread(rows).join(spread(kept).drop(key), names, "left_semi").dropDuplicates(names).select(*[F.col(f"`{c}`") for c in docs.columns])


def _least_of_component(fps: DataFrame, order: Column, radius: int) -> DataFrame:
    """``(fp, least)``: for every fingerprint the least ``order`` of its component."""
    classes = stage(fps.groupBy("fp").agg(F.min(order).alias("least")), "sim-class")
    roots = connected_components(links(classes.select("fp"), radius))
    placed = stage(classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "sim-root")
    least = stage(placed.groupBy("root").agg(F.min("least").alias("least")), "sim-least")
    return placed.drop("least").join(least, "root").select("fp", "least")
