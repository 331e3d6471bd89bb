"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask names the token positions of a short window that count; the positions between are ignored, so a seed survives
substituted tokens there. Seeds of documents and items are joined on their hash; each hit gives a diagonal (document
position minus item position), along which the tokens of both are compared: an overlap is a run of item tokens of
which at least :data:`SIMILARITY` are equal at the same distance in the document. The masks together lose no overlap:
whichever tokens of a run are substituted, as long as it is one, some mask has a place on those that are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stage, unused_name

#: Counting positions of the masks: of the SQL, whose overlaps are among those of FULL_MASKS; of the operator for items of
#: at least their span, with a place in every run of 12 to 20 tokens that is an overlap; and for shorter items.
MASKS = ((0, 1, 3, 6, 7, 9, 11), (0, 2, 3, 5, 8, 10, 11), (0, 1, 2, 5, 7, 10, 11))
FULL_MASKS = ((0, 1, 2, 3, 8), (0, 1, 2, 5, 8), (0, 3, 5, 7, 8))
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))
#: Tokens of the run that is compared (all of a shorter item), and the least share of them that must be equal.
RUN = 20
SIMILARITY = 0.8
#: Item seeds up to this number (16 bytes each and a row's overhead: about 50 MB) are broadcast, more are shuffled.
BROADCAST_SEEDS = 500_000
#: Documents up to this number (an 8-byte hash each and a row's overhead: about 50 MB) are broadcast, more are shuffled.
BROADCAST_DOCS = 1_000_000


def span(masks: tuple) -> int:
    return 1 + max(max(m) for m in masks)


def token_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased runs of letters and digits of a text."""
    words = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(hashes: Column, masks: tuple) -> Column:
    """Seed hashes in order of position, one per mask at each (null where it ends beyond the text); the seed at index k
    starts at token k div masks."""
    least = 1 + min(max(m) for m in masks)
    starts = F.sequence(F.lit(0), F.size(hashes) - least)
    seed = lambda i, n, m: F.xxhash64(F.lit(n), *[F.get(hashes, i + k) for k in m])
    fits = lambda i, m, found: found if max(m) < least else F.when(i + max(m) < F.size(hashes), found)
    at = lambda i: F.array(*[fits(i, m, seed(i, n, m)) for n, m in enumerate(masks)])
    return F.when(F.size(hashes) >= least, F.flatten(F.transform(starts, at)))


def keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, doc_key, text)``; rows of equal id and text share a key."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key(docs).alias("doc_key"), text.alias("text"))


def doc_key(docs: DataFrame) -> Column:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return F.concat_ws(":", F.coalesce(docs["doc_id"].cast("string"), F.lit("null")), F.hex(F.xxhash64(text)))


def items_of(benchmark: DataFrame) -> DataFrame:
    """``(item_id, item)``: the token hashes of every item."""
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), token_hashes(F.col("text")).alias("item"))


def _hits(texts: DataFrame, items: DataFrame, masks: tuple) -> DataFrame:
    """Distinct ``(doc_key, item_no, diagonal)`` that share a seed."""
    one = items.select("item_no", F.posexplode(seeds(F.col("item"), masks)).alias("k", "seed")).filter("seed is not null")
    one = stage(one.select("item_no", "seed", F.floor(F.col("k") / len(masks)).cast("int").alias("item_at")), "decon-seeds")
    if one.count() <= BROADCAST_SEEDS:
        one = F.broadcast(one)
    found = texts.select("doc_key", token_hashes(F.col("text")).alias("doc")).select("doc_key", F.posexplode(seeds(F.col("doc"), masks)).alias("k", "seed"))
    diagonal = (F.floor(F.col("k") / len(masks)) - F.col("item_at")).cast("int").alias("diagonal")
    return found.join(one, "seed").select("doc_key", "item_no", diagonal).distinct()


def _hashes_of(keys: DataFrame, name: str) -> DataFrame:
    """The distinct hashes, in column ``name``, of the ``doc_key`` of ``keys``: broadcast where their count allows it, so
    that the texts they pick are not shuffled."""
    hashes = stage(keys.select(F.xxhash64("doc_key").alias(name)).distinct(), "decon-keys")
    return F.broadcast(hashes) if hashes.count() <= BROADCAST_DOCS else hashes


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, doc_key, item_id, doc_start, item_start, run, matched)``: the best overlap of each document and item.

    ``run`` is the number of item tokens compared and ``matched`` how many are equal; positions count tokens. Null or
    empty texts match nothing, nor do items of fewer than five tokens; items of five to 20 tokens must overlap as a
    whole. Rows of equal id and text are one document, repeated items are items
    of their own, null ids are kept, other columns are ignored, and an empty table gives no rows.
    """
    items = stage(items_of(benchmark).withColumn("item_no", F.monotonically_increasing_id()), "decon-items")
    texts = keyed(docs)
    long_ = F.size("item") >= span(MASKS)
    hits = _hits(texts, items.filter(long_), FULL_MASKS)
    short = items.filter(~long_ & (F.size("item") >= span(SHORT_MASKS)))
    if not short.isEmpty():
        hits = hits.union(_hits(texts, short, SHORT_MASKS))
    hits = stage(hits, "decon-hits")
    marked = _hashes_of(hits, "key_hash")  # equal hashes of other keys pick a text too many, which no hit joins
    suspects = texts.join(marked, F.xxhash64(texts["doc_key"]) == marked["key_hash"], "left_semi").select("doc_key", "doc_id", token_hashes(F.col("text")).alias("doc"))
    suspects = stage(suspects.dropDuplicates(["doc_key"]), "decon-docs")
    pairs = hits.join(items, "item_no").join(suspects, "doc_key")

    run = F.least(F.lit(RUN), F.size("item"))
    equal = F.transform(F.col("item"), lambda h, j: (h == F.get(F.col("doc"), j + F.col("diagonal"))) & (j + F.col("diagonal") >= 0))
    pairs = pairs.withColumn("equal", F.transform(equal, lambda e: F.coalesce(e, F.lit(False)).cast("int"))).withColumn("run", run)
    sums = F.transform(F.sequence(F.lit(1), F.size("equal") - F.col("run") + 1), lambda s: F.struct(
        F.aggregate(F.slice("equal", s, F.col("run")), F.lit(0), lambda a, x: a + x).alias("matched"), (-s).alias("from")))
    pairs = pairs.withColumn("best", F.array_max(sums)).filter(F.col("best.matched") >= F.ceil(F.lit(SIMILARITY) * F.col("run")))
    rows = pairs.select(
        "doc_id", "doc_key", "item_id", "item_no", (F.col("diagonal") - F.col("best.from") - 1).alias("doc_start"),
        (-F.col("best.from") - 1).alias("item_start"), "run", F.col("best.matched").alias("matched"),
    )
    order = Window.partitionBy("doc_key", "item_no").orderBy(F.desc("matched"), "doc_start", "item_start")
    return rows.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place", "item_no")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, that overlap no item.

    A null or empty text overlaps nothing and stays, null ids and repeated rows too; columns may have any names; without
    items every row stays; an empty table gives no rows.
    """
    found = stage(overlaps(docs, benchmark).select("doc_key").distinct(), "decon-found")
    name = unused_name(docs)
    return docs.withColumn(name, doc_key(docs)).join(found.select(F.col("doc_key").alias(name)), name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
