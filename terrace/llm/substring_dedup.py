"""Repeated passages by paragraph MinHash banding.

A paragraph starts at a sentence and holds the fewest whole sentences with :data:`MIN_WORDS` words, so where it is cut
depends on its own text only: a passage set into another document, in the middle of a line too, has the same paragraphs.
Every sentence with that many words from it on starts one.

Anchored paragraphs are besides those: :data:`MIN_WORDS` words from wherever a run of words has the least hash of all
that start at :data:`ANCHOR` places in a row. Both are set by words of the passage alone, so documents that share
:data:`SHARED_WORDS` words in a row, wherever they stand in sentences, lines or texts, always have an equal paragraph.

Equal paragraphs are one text from the start; anchored ones are only compared as such. Different texts that agree in a short band of their MinHash signature are
dealt again by longer bands; all of a bucket are compared with the least of it, those unlike it with the texts that may
be like them by the rarest of their shingles (an exact prefix filter, no loss), by the exact Jaccard similarity of their
word shingles. What is linked, directly or over others, forms a cluster, of which the first occurrence stays.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import dropped, stage, unused_name
from terrace.llm.components import connected_components
from terrace.llm.tokens import blocks
from terrace.session import shuffles_freed

MIN_WORDS = 25
SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Chance that a pair at the least similarity shares a band, and the rows of a band.
RECALL = 0.97
BAND_ROWS = 3
#: The same for the longer bands that deal the texts found by the first ones.
FINE_RECALL = 0.99
FINE_ROWS = 8
#: Words without a sentence end after which a word's hash may end one.
LONG_SENTENCE = 40
#: Words in a row that two documents cannot share without an equal paragraph, and the starts of which one is an anchor.
SHARED_WORDS = 50
ANCHOR = SHARED_WORDS - MIN_WORDS + 1
#: Documents up to this number (a hash each: 16 MB) are broadcast to find their texts, more are shuffled.
BROADCAST_DOCS = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio, a usual multiplier for hashing
_MOST = np.uint64(2**64 - 1)


def bands(similarity: float = SIMILARITY, rows: int = BAND_ROWS, recall: float = RECALL) -> int:
    """The fewest bands that a pair of this similarity misses with at most 1 - ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)  # fixed value: a multiplier of SplitMix64
    return x ^ (x >> np.uint64(32))


class Paragraphs(NamedTuple):
    """Per paragraph: number of its text in the block, first word, end word, shingle range, identity."""

    text: np.ndarray
    first: np.ndarray
    end: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    identity: np.ndarray
    shingles: np.ndarray  # of the whole block; each paragraph has [start, stop)
    anchored: np.ndarray


def _anchors(h: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The first starts of the least hash among :data:`ANCHOR` starts in a row; ``room`` is the number of starts from each to its text's last."""
    low, width = h, 1
    while width < ANCHOR:
        step = min(width, ANCHOR - width)
        low = np.minimum(low[: max(0, len(low) - step)], low[step:])
        width += step
    windows = np.flatnonzero(room[: len(low)] >= ANCHOR)
    if not len(windows):
        return windows
    least = low[windows]
    at = windows.copy()  # moved on to the first of the least in its window
    while (later := h[at] != least).any():
        at[later] += 1
    return np.unique(at)


def paragraphs(texts: list[str], sentences_only: bool = False) -> Paragraphs:
    """The paragraphs of some texts; words are runs of anything but white space, compared in lower case."""
    words = [t.lower().split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n = int(sizes.sum())
    number = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}  # a word that comes often is hashed once
    word = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, n)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))[word]
    closes = np.fromiter((w[-1] in ".!?" for w in number), bool, len(number))[word]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(n)
    since = at - np.maximum.accumulate(np.where(closes, at, -1)) if n else at
    since = np.minimum(since, at - begin[doc])
    closes |= (since > LONG_SENTENCE) & (h % np.uint64(16) == 0)
    closes[begin[1:][sizes > 0] - 1] = True
    ends = np.flatnonzero(closes) + 1
    starts = np.concatenate([[0], ends[:-1]]) if n else ends
    which = doc[starts] if n else ends
    k = np.searchsorted(ends, starts + MIN_WORDS)
    end = np.where(k < len(ends), ends[np.minimum(k, len(ends) - 1)], n + 1) if n else ends
    fits = end <= begin[which + 1] if n else np.zeros(0, bool)

    sh = np.zeros(n, np.uint64)
    for j in range(SHINGLE_WORDS):
        m = max(0, n - j)
        sh[:m] = sh[:m] * _MIX + h[n - m :]
        if j < SHINGLE_WORDS - 1:
            sh = _mixed(sh)
    sh = _mixed(sh)
    starts, end, which = starts[fits], end[fits], which[fits]
    anchored = np.zeros(len(starts), bool)
    if not sentences_only:
        own = _anchors(sh, begin[doc + 1] - MIN_WORDS + 1 - at)
        own = np.setdiff1d(own, starts[end - starts == MIN_WORDS])
        starts, end, which = np.append(starts, own), np.append(end, own + MIN_WORDS), np.append(which, doc[own])
        anchored = np.append(anchored, np.ones(len(own), bool))
    stop = end - SHINGLE_WORDS + 1
    total = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(sh ^ _MIX), dtype=np.uint64)])
    identity = _mixed((total[stop] - total[starts]) ^ (stop - starts).astype(np.uint64)).view(np.int64)
    return Paragraphs(which, starts - begin[which], end - begin[which], starts, stop, identity, sh, anchored)


def band_keys(p: Paragraphs, n_bands: int, rows: int = BAND_ROWS, seed: int = 0) -> np.ndarray:
    """``(paragraphs that are not anchored, bands)`` of 64-bit keys: MinHash over the shingles, ``rows`` minima to a band."""
    start, stop = p.start[~p.anchored], p.stop[~p.anchored]
    keys = np.zeros((len(start), n_bands), np.uint64)
    if len(start):
        cuts = np.stack([start, stop], 1).ravel()
        for k in range(n_bands * rows):
            values = np.append(_mixed(p.shingles + np.uint64((k + 1 + seed) * int(_MIX) % 2**64)), _MOST)
            low = np.minimum.reduceat(values, cuts)[::2]
            keys[:, k // rows] = _mixed(keys[:, k // rows] * _MIX + low + np.uint64(k // rows))
    return keys.view(np.int64)


_UNIT = "doc_key long, doc_id long, first int, end int, u long"
#: The columns of the band keys.
_KEYS = [f"key{k}" for k in range(bands())]


def doc_key(docs: DataFrame) -> Column:
    """A hash of id and text: rows equal in both are one document."""
    return F.xxhash64(docs["doc_id"].isNull(), docs["doc_id"].cast("long"), F.coalesce(docs["text"].cast("string"), F.lit("")))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_key(docs).alias("doc_key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _units(batches):
    """Paragraphs with their band keys, anchored ones with none."""
    for b in batches:
        at = 0
        for block in blocks(b.column(2).to_pylist(), 1 << 20):
            p = paragraphs(block)
            keys = np.zeros((len(p.text), len(_KEYS)), np.int64)
            keys[~p.anchored] = band_keys(p, len(_KEYS))
            take = pa.array(p.text + at)
            at += len(block)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(p.first, pa.int32()), pa.array(p.end, pa.int32()), pa.array(p.identity),
                 *[pa.array(keys[:, k], mask=p.anchored) for k in range(len(_KEYS))]],
                ["doc_key", "doc_id", "first", "end", "u", *_KEYS],
            )


def _distinct_keys(batches):
    """The distinct pairs of band key and text of a batch, with one of their documents and whether there are others.

    A passage which is everywhere is sent once a batch.
    """
    for b in batches:
        u, d, key = (b.column(k).to_numpy() for k in range(3))
        order = np.lexsort((u, key))
        key, u, d = key[order], u[order], d[order]
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (u[1:] != u[:-1])])) if len(key) else np.zeros(0, int)
        low, high = (f.reduceat(d, new) if len(new) else d for f in (np.minimum, np.maximum))
        yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(u[new]), pa.array(low), pa.array(low != high)], ["key", "u", "doc", "more"])


def _shingle_rows(batches):
    """The sorted distinct shingles of the wanted paragraphs, by identity."""
    for b in batches:
        at = 0
        for block in blocks(b.column(0).to_pylist(), 1 << 20):
            p = paragraphs(block, sentences_only=True)
            found, once = np.unique(p.identity, return_index=True)
            keep = np.isin(found, b.column(1).slice(at, len(block)).flatten().to_numpy(zero_copy_only=False))
            at += len(block)
            sets = [np.unique(p.shingles[p.start[k] : p.stop[k]]).view(np.int64) for k in once[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(found[keep]), pa.array(sets, pa.list_(pa.int64()))], ["u", "shingles"])


def _fine_keys(batches):
    """The keys of the longer bands over given shingle sets."""
    n = bands(rows=FINE_ROWS, recall=FINE_RECALL)
    for b in batches:
        sizes = np.diff(b.column(1).offsets.to_numpy())
        stop = np.cumsum(sizes)
        shingles = b.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        none = np.zeros(0, np.int64)
        keys = band_keys(Paragraphs(none, none, none, stop - sizes, stop, none, shingles, np.zeros(len(stop), bool)), n, FINE_ROWS, seed=1 << 20)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), b.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), n)))], ["key", "u"])


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``(a, b)`` pairs whose shingle sets have at least this Jaccard similarity."""
    both = pairs.join(sets.select(F.col("u").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("u").alias("b"), F.col("shingles").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared >= similarity * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def repeats(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, doc_key, first, end, cluster, keeper_doc_id, n_paragraphs, removed)``: every paragraph with a like one in another document.

    ``first`` and ``end`` (exclusive) count words; ``cluster`` is the identity of one of its texts, ``n_paragraphs`` its
    occurrences, and the one of the least ``(doc_id, doc_key, first)`` stays, the others are ``removed``. Paragraphs that
    one document alone has are not compared with each other. Null or empty texts and those of fewer than 25 words have
    no paragraph; rows of equal id and text are one document and never repeat each other, though each gives its rows;
    null ids come last; other columns are ignored; an empty table gives no rows.
    """
    with shuffles_freed(docs.sparkSession):
        units, named = _clusters(_texts(docs), similarity)
    kept = (F.col("keeper.doc_key") == F.col("doc_key")) & (F.col("keeper.first") == F.col("first"))
    return units.join(named, "u").select(
        "doc_id", "doc_key", "first", "end", "cluster", F.col("keeper.doc_id").alias("keeper_doc_id"), "n_paragraphs", (~kept).alias("removed")
    )


def _clusters(texts: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """All paragraphs, and the identities that are in a cluster over several documents with that cluster."""
    keyed = stage(texts.mapInArrow(_units, f"{_UNIT}, {', '.join(f'{k} long' for k in _KEYS)}"), "sub-keyed")
    wanted = _wanted(keyed)
    units = stage(keyed.select("doc_key", "doc_id", "first", "end", "u", F.col(_KEYS[0]).isNull().alias("anchored")), "sub-units")
    dropped(keyed)
    edges, read = _links(texts, units, wanted, similarity)
    roots = stage(connected_components(edges), "sub-roots")
    for df in read:
        dropped(df)

    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_key", "first")
    low, high = F.min("doc_key").alias("low"), F.max("doc_key").alias("high")
    per_text = units.groupBy("u").agg(F.count("*").alias("n"), F.min(place).alias("keeper"), low, high)
    per_text = per_text.join(roots, per_text.u == roots.node, "left").filter("root is not null or low <> high")
    per_text = stage(per_text.select("u", F.coalesce("root", "u").alias("cluster"), "n", "keeper", "low", "high"), "sub-texts")
    clusters = per_text.groupBy("cluster").agg(F.sum("n").alias("n_paragraphs"), F.min("keeper").alias("keeper"), F.min("low").alias("low"), F.max("high").alias("high"))
    clusters = stage(clusters.filter("low <> high").drop("low", "high"), "sub-clusters")
    return units, stage(per_text.select("u", "cluster").join(clusters, "cluster"), "sub-named")


def _wanted(keyed: DataFrame) -> DataFrame:
    """The texts, some more than once, that share a band key with another text in another document.

    The bands are dealt one after the other, so the shuffle of one is gone when that of the next is made.
    """
    wanted = []
    for band in _KEYS:
        own = keyed.select("u", "doc_key", F.col(band).alias("key")).filter("key is not null")
        own = own.mapInArrow(_distinct_keys, "key long, u long, doc long, more boolean").repartition("key")
        multi = own.groupBy("key").agg(F.min("u").alias("least"), F.max("u").alias("most"), F.min("doc").alias("low"), F.max("doc").alias("high"), F.max("more").alias("more"))
        multi = multi.filter("least <> most and (low <> high or more)").select("key")
        wanted.append(stage(own.join(multi, "key", "left_semi").select("u").distinct(), "sub-wanted"))
    return reduce(DataFrame.union, wanted)


def _links(texts: DataFrame, units: DataFrame, wanted: DataFrame, similarity: float) -> tuple[DataFrame, list[DataFrame]]:
    """Edges ``(src, dst)`` between the identities of different texts that are alike, and the staged frames they are read
    from; anchored paragraphs have none.

    A few short bands over all paragraphs find the texts that may have a like one; more and longer bands over those
    alone deal them into buckets of texts that are nearly alike, which are compared exactly.
    """
    shown = stage(units.filter("not anchored").groupBy("u").agg(F.min("doc_key").alias("doc_key")).join(wanted, "u", "left_semi"), "sub-shown")
    small = shown.count() <= BROADCAST_DOCS
    dropped(wanted)
    by_doc = shown.groupBy("doc_key").agg(F.collect_set("u").alias("wanted"))
    sets = texts.select("doc_key", "text").join(F.broadcast(by_doc) if small else by_doc, "doc_key").select("text", "wanted")
    sets = stage(sets.mapInArrow(_shingle_rows, "u long, shingles array<long>").dropDuplicates(["u"]), "sub-sets")
    dropped(shown)

    fine = sets.mapInArrow(_fine_keys, "key long, u long").repartition("key")
    least = fine.groupBy("key").agg(F.min("u").alias("least"), F.max("u").alias("most")).filter("least <> most").select("key", "least")
    members = stage(fine.join(least, "key").select("key", "u", "least"), "sub-members")
    first = members.filter("u <> least").select(F.col("u").alias("a"), F.col("least").alias("b")).distinct()
    near = stage(_alike(first, sets, similarity), "sub-near")
    # What hangs together over the least of its buckets is of one cluster already: only texts of different ones go on.
    linked = stage(connected_components(near.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "sub-linked")
    found = members
    members = members.join(linked.withColumnRenamed("node", "u"), "u", "left").select("key", "u", F.coalesce("root", "u").alias("label"))
    members = stage(members, "sub-labelled")
    dropped(found)
    mixed = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    mates = members.join(mixed, "key", "left_semi").select("u", "label").distinct()
    mates = stage(sets.join(mates, "u"), "sub-mates")
    rest = _sharing_prefixes(mates, similarity)
    edges = near.union(_alike(rest, sets, similarity)).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return edges, [sets, near, members, mates]


def _sharing_prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """Distinct candidate pairs ``(a, b)`` of ``sets(u, shingles, label)`` of different labels: no pair as similar is missing.

    Exact prefix filter: shingles are put in one order for all texts, rarest first. Two sets that share so much that
    their similarity is reached have a shingle in common among the first few of both, and enough shingles after it;
    what a large group has in common comes last and makes no pairs. Shingles of one text only are counted, not joined.

    A pair of different labels has one that is not the label most texts with its shingle bear. Only these texts look for
    others, so a large group of one label meets what differs from it, never itself.
    """
    every = sets.select("u", F.explode("shingles").alias("shingle"))
    common = stage(every.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1"), "sub-common")
    shared = stage(every.join(common, "shingle"), "sub-shared")
    held = shared.groupBy("u").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("held"))
    held = held.join(sets.select("u", "label", F.size("shingles").alias("size")), "u")
    least = lambda share: F.ceil(share * F.col("size") - 1e-9)
    places = held.select("u", "label", "size", F.posexplode("held").alias("k", "h"), (F.col("size") - F.size("held")).alias("alone"))
    places = places.select("u", "label", "size", F.col("h.shingle").alias("shingle"), (F.col("alone") + F.col("k")).alias("at"))
    places = stage(places.filter(F.col("at") <= F.col("size") - least(similarity)), "sub-prefixes")
    dropped(shared)

    per_label = places.groupBy("shingle", "label").agg(F.count("*").alias("n"))
    main = per_label.groupBy("shingle").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("labels")).filter("labels > 1")
    places = stage(places.join(main.drop("labels"), "shingle").withColumn("minor", F.col("label") != F.col("main")).drop("main"), "sub-mixed")

    both = 2 * similarity / (1 + similarity)  # of the shorter of two sets, what they share at least
    short = F.col("at") <= F.col("size") - least(both)
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    fits = (y("size") < x("size")) | ((y("size") == x("size")) & (y("u") < x("u")))
    enough = F.least(x("size") - x("at"), y("size") - y("at")) >= both / 2 * (x("size") + y("size")) - 1e-9
    other = (x("shingle") == y("shingle")) & (x("label") != y("label"))

    def pairs(of_long: Column, of_short: Column) -> DataFrame:
        long, short_ = places.filter(of_long).alias("x"), places.filter(short & of_short).alias("y")
        met = long.join(short_, other & fits & (y("size") >= similarity * x("size") - 1e-9) & enough)
        return met.select(x("u").alias("a"), y("u").alias("b"))

    minor = F.col("minor")
    return pairs(minor, F.lit(True)).union(pairs(~minor, minor)).distinct()


def cut_out(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the words of its removed paragraphs; rows, columns and untouched texts stay as they are.

    A null text stays null and an empty one empty; repeated rows stay and lose the same words; columns may have any
    names; an empty table, or nothing found, gives ``docs`` again.
    """
    spans = found.filter("removed").groupBy("doc_key").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    key, cut = unused_name(docs), unused_name(docs)

    @F.pandas_udf("string")
    def without(texts, spans):
        return texts.combine(spans, lambda t, s: t if t is None or s is None else _without(t, s))

    spans = spans.select(F.col("doc_key").alias(key), F.col("spans").alias(cut))
    out = docs.withColumn(key, doc_key(docs)).join(spans, key, "left").withColumn("text", without(F.col("text"), F.col(cut)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _without(text: str, spans) -> str:
    gone = {w for s in spans for w in range(s["first"], s["end"])}
    out, at = [], 0
    for k, m in enumerate(re.finditer(r"\S+", text)):
        if k in gone:
            out.append(text[at : m.start()])
            at = m.end()
    return "".join([*out, text[at:]])
