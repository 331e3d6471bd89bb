"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Token-byte incidence matrices A and B (a row per token, a column per byte) are hand-built CSR. Gustavson row
products of A and the transpose of B give the overlap links: the pairs of tokens with common bytes and how many. A
byte offset at which both tokenizers end a token is one where the next overlap link shares neither token with the
link before; these offsets cut the tokens into groups. Group-incidence matrices (a row per token id, a column per
group, valued by occurrences) multiplied alike give the shared-group links of every pair of ids.

Texts are encoded once; what each document links is written in the shared folder. Corpus-wide counts are one
aggregation over those pairs. A bounded table of the most frequent pairs, cut at a count chosen from the histogram
of all counts, is broadcast and judges most links where the documents lie; the pairs outside it are joined with all
counts, so every link is judged by the exact count at every size of corpus.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stage, texts_of
from terrace.llm.tokens import CACHE_CHARS, CACHE_PARTS, WordEncoder, _byte_chars, blocks

#: Most pairs in the broadcast table (24 bytes each); what it holds changes no result.
FREQUENT_PAIRS = 1 << 18
#: Code points aligned at a time: the arrays of so many fit a core's cache.
ALIGN_CHARS = 1 << 16
#: Products expanded at a time.
BLOCK_PRODUCTS = 1 << 22
#: Runs of spaces with their words.
_SPACED = re.compile(r" +[^ ]*").findall


class Csr(NamedTuple):
    """A sparse matrix by rows: row i has columns ``indices[indptr[i]:indptr[i + 1]]`` with the values beside them."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray


def accumulated(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n_rows: int, n_columns: int) -> Csr:
    """The matrix of these entries; entries of one place are added up."""
    key = rows * n_columns + columns
    if np.any(key[1:] < key[:-1]):
        order = np.argsort(key)  # entries of one place are added up, in whatever order
        key, rows, columns, values = key[order], rows[order], columns[order], values[order]
    new = np.r_[True, key[1:] != key[:-1]][: len(key)]
    if not new.all():
        first = np.flatnonzero(new)
        rows, columns, values = rows[first], columns[first], np.add.reduceat(values, first)
    return Csr(np.r_[0, np.cumsum(np.bincount(rows, minlength=n_rows))], columns, values)


def product(a: Csr, b: Csr, n_columns: int, most: int = BLOCK_PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gustavson's product a x b as blocks ``(rows, columns, values)`` in order: each row of a gathers rows of b.

    A block holds whole rows of the product and comes of at most ``most`` single products (or of one row of a).
    """
    n_rows = len(a.indptr) - 1
    width = b.indptr[a.indices + 1] - b.indptr[a.indices]  # single products that each entry of a takes part in
    upto = np.r_[0, np.cumsum(width)][a.indptr]
    at = 0
    while at < n_rows:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
        lo, hi = a.indptr[at], a.indptr[end]
        w = width[lo:hi]
        rows = np.repeat(np.arange(end - at), np.diff(a.indptr[at : end + 1]))
        if np.all(w == 1):  # each entry takes part in one single product
            met, values = b.indptr[a.indices[lo:hi]], a.values[lo:hi]
        else:
            rows, values = np.repeat(rows, w), np.repeat(a.values[lo:hi], w)
            met = np.repeat(b.indptr[a.indices[lo:hi]] - np.cumsum(w) + w, w) + np.arange(len(rows))
        c = accumulated(rows, b.indices[met], values * b.values[met], end - at, n_columns)
        yield np.repeat(np.arange(at, end), np.diff(c.indptr)), c.indices, c.values
        at = end


def _whole(blocks_of: Iterator[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    parts = [*blocks_of] or [(np.zeros(0, np.int64),) * 3]
    return tuple(np.concatenate(p) for p in zip(*parts))


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens of these lengths that follow each other."""
    ends = np.r_[0, np.cumsum(lengths)]
    return Csr(ends, np.arange(ends[-1]), np.ones(ends[-1], np.int64))


def transposed(m: Csr, n_columns: int) -> Csr:
    rows = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    if len(rows) == n_columns and np.all(m.indices[1:] > m.indices[:-1]):  # one entry in each column, in order
        return Csr(np.arange(n_columns + 1), rows, m.values)
    return accumulated(m.indices, rows, m.values, n_columns, len(m.indptr) - 1)


class Alignment(NamedTuple):
    """``overlaps``: token places in A and B and their common bytes, in order; ``group_a`` and ``group_b``: the group of
    each token; ``pairs``: ids of A and B that share a group and the number of their links, by ids."""

    overlaps: tuple[np.ndarray, np.ndarray, np.ndarray]
    group_a: np.ndarray
    group_b: np.ndarray
    pairs: tuple[np.ndarray, np.ndarray, np.ndarray]


def align_tokens(ids_a: np.ndarray, lengths_a: np.ndarray, ids_b: np.ndarray, lengths_b: np.ndarray) -> Alignment:
    """Links of two tokenisations of the same bytes; lengths are in bytes, one at least, and equal in sum."""
    n_bytes, n_b = int(lengths_b.sum()), len(ids_b)
    i, j, shared = _whole(product(incidence(lengths_a), transposed(incidence(lengths_b), n_bytes), n_b))
    cut = np.r_[False, (i[1:] != i[:-1]) & (j[1:] != j[:-1])][: len(i)]
    group = np.cumsum(cut)
    group_a, group_b = np.empty(len(ids_a), np.int64), np.empty(n_b, np.int64)
    group_a[i], group_b[j] = group, group
    n_groups = int(group[-1]) + 1 if len(group) else 0
    a, at_a = np.unique(ids_a, return_inverse=True)
    b, at_b = np.unique(ids_b, return_inverse=True)
    in_a = accumulated(at_a, group_a, np.ones(len(ids_a), np.int64), len(a), n_groups)
    in_b = accumulated(group_b, at_b, np.ones(n_b, np.int64), n_groups, len(b))
    rows, columns, links = _whole(product(in_a, in_b, len(b)))
    return Alignment((i, j, shared), group_a, group_b, (a[rows].astype(np.int64), b[columns].astype(np.int64), links))


def groups_text(found: Alignment, names_a: np.ndarray, names_b: np.ndarray) -> np.ndarray:
    """The names of all tokens as parts that joined read ``a1,a2|b1;a3|b2,b3;``: the tokens of each group in order."""
    n = int(found.group_a[-1]) + 1
    of_a, of_b = np.bincount(found.group_a, minlength=n), np.bincount(found.group_b, minlength=n)
    parts = np.empty(len(names_a) + len(names_b), object)
    for names, group, before in ((names_a, found.group_a, np.cumsum(of_b) - of_b), (names_b, found.group_b, np.cumsum(of_a))):
        parts[np.arange(len(names)) + before[group]] = names
    return parts


def _flat(known: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens after each other, where each starts, and how many it has."""
    lengths = np.array([*map(len, known)], np.int64)
    return np.frombuffer(b"".join(known), np.uint8), np.cumsum(lengths) - lengths, lengths


def _joined(flat: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """The bytes of the tokens ``ids`` after each other."""
    data, starts, lengths = flat
    n = lengths[ids]
    ends = np.cumsum(n)
    return data[np.repeat(starts[ids] - ends + n, n) + np.arange(ends[-1])]


class Pair:
    """A byte-level tokenizer A and a sentencepiece model B, which puts a space before the text: encoded alike."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.a = WordEncoder(path_a)
        self.a.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = {chr(b): b for b in range(256)} | {c: b for b, c in _byte_chars().items()}
        n_a = self.a.tokenizer.get_vocab_size()
        self.bytes_a = [bytes(alphabet[c] for c in self.a.tokenizer.id_to_token(i)) for i in range(n_a)]
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.flat_a, self.flat_b = (_flat(known) for known in (self.bytes_a, self.bytes_b))
        self.lengths_a, self.lengths_b = self.flat_a[2], self.flat_b[2]

        # names of the ids, with what follows them inside a group and at the end of its side
        self.names_a, self.names_b = (
            [np.array([f"{i}{mark}" for i in range(len(known))], object) for mark in (",", end)] for known, end in ((self.bytes_a, "|"), (self.bytes_b, ";"))
        )
        # No piece goes on behind a letter with a space: then merges never cross from a word into the spaces after it.
        self.by_word = not any(re.search("[^\u2581]\u2581", self.b.id_to_piece(i)) for i in range(len(self.bytes_b)))
        self.words: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of both for each text; none of either where a text is empty or its bytes do not come back."""
        spaced = [" " + t for t in texts]
        found = [
            tuple(np.frombuffer(ids, "<u4").astype(np.int64) if ids else np.zeros(0, np.int64) for ids in (a, self.encode_b(text) if len(text) > 1 else b""))
            for text, a in zip(spaced, self.a.encode(spaced))
        ]
        return self._true(found, [t.encode() for t in spaced])

    def _true(self, found: list[tuple[np.ndarray, np.ndarray]], data: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``found``, but no tokens where those of one side are not the bytes of the text: half of the texts, and again
        half of those, are looked at where the bytes or lengths of all together are not the same."""
        if not found:
            return []
        sizes, true = np.array([*map(len, data)], np.int64), all(len(b) for _, b in found)
        for k, flat in enumerate((self.flat_a, self.flat_b)):
            if true:
                ids, n = np.concatenate([t[k] for t in found]), [len(t[k]) for t in found]
                ends = np.r_[0, np.cumsum(flat[2][ids])][np.cumsum(n)]
                true = np.array_equal(ends, np.cumsum(sizes)) and np.array_equal(_joined(flat, ids), np.frombuffer(b"".join(data), np.uint8))
        if true or len(found) == 1:
            return found if true else [(np.zeros(0, np.int64),) * 2]
        half = len(found) // 2
        return self._true(found[:half], data[:half]) + self._true(found[half:], data[half:])

    def encode_b(self, spaced: str) -> bytes:
        """The ids of B, as A's encoder gives them, for a text that has got its space: of each run of spaces with its word, as
        far as these are apart. One space at the end stays with the word before it: alone it would be an empty text, which
        gets no space put before it."""
        if not self.by_word or "\u2581" in spaced:
            return array("I", self.b.encode(spaced[1:])).tobytes()
        parts = _SPACED(spaced)
        if parts[-1] == " " and len(parts) > 1:
            parts[-2:] = [parts[-2] + " "]
        ids = list(map(self.words.get, parts))
        if None in ids:
            ids = [self._word(p) if i is None else i for p, i in zip(parts, ids)]
        return b"".join(ids)

    def _word(self, part: str) -> bytes:
        ids = array("I", self.b.encode(part[1:])).tobytes()
        if len(part) <= CACHE_CHARS:
            if len(self.words) >= CACHE_PARTS:  # the older half of the cache goes
                self.words = dict(islice(self.words.items(), CACHE_PARTS // 2, None))
            self.words[part] = ids
        return ids

    def align(self, tokens: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[tuple], tuple[np.ndarray, ...]]:
        """For each text ``(n_a, n_b, n_groups, groups)``; and ``(text, a, b, links)`` of all linked pairs of ids.

        Texts follow each other in one matrix: the end of a text is an end of tokens in both, so no group crosses it.
        """
        n_a, n_b = (np.array([len(t[k]) for t in tokens], np.int64) for k in (0, 1))
        ids_a, ids_b = (np.concatenate([t[k] for t in tokens]) for k in (0, 1))
        if not len(ids_a):
            return [(0, 0, 0, "")] * len(tokens), (np.zeros(0, np.int64),) * 4
        of_a, of_b, size_a, size_b = np.repeat(np.arange(len(tokens)), n_a), np.repeat(np.arange(len(tokens)), n_b), len(self.bytes_a), len(self.bytes_b)
        found = align_tokens(of_a * size_a + ids_a, self.lengths_a[ids_a], of_b * size_b + ids_b, self.lengths_b[ids_b])
        names = [
            np.where(np.r_[group[1:] != group[:-1], True], last[ids], inner[ids])
            for group, ids, (inner, last) in ((found.group_a, ids_a, self.names_a), (found.group_b, ids_b, self.names_b))
        ]
        parts, ends = groups_text(found, *names).tolist(), np.cumsum(n_a + n_b)
        groups = ["".join(parts[s:t])[:-1] for s, t in zip((ends - n_a - n_b).tolist(), ends.tolist())]
        firsts = found.group_a[np.r_[True, of_a[1:] != of_a[:-1]]]
        n_groups = np.zeros(len(tokens), np.int64)
        n_groups[n_a > 0] = np.diff(np.r_[firsts, found.group_a[-1] + 1])
        a, b, links = found.pairs
        return [*zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), groups)], (a // size_a, a % size_a, b % size_b, links)


@lru_cache(maxsize=4)
def pair_of(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per worker, kept across tasks with the cache of A."""
    return Pair(path_a, path_b)


_COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, links)``: the alignment of every whole text.

    ``groups`` lists the ids of each group, ``a1,a2|b1;a3|b2,b3`` (empty without tokens); ``pairs`` has id of A x size of B's vocabulary + id of B
    for every pair of ids that shares a group, ascending, and ``links`` the number of their links.
    """

    def run(batches):
        two = pair_of(path_a, path_b)
        for batch in batches:
            ids, at = batch.column(0), 0
            for block in blocks(batch.column(1).to_pylist(), ALIGN_CHARS):
                counted, (of, a, b, links) = two.align(two.encode(block))
                n = np.bincount(of, links, len(block)).astype(np.int64)
                ends = pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=len(block)))], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (a * len(two.bytes_b) + b, links)]
                n_a, n_b, n_groups, groups = (pa.array(c) for c in zip(*counted))
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(block)), n_a, n_b, n_groups, pa.array(n), groups, *lists], [*_names(_COUNTED), "pairs", "links"])
                at += len(block)

    return texts_of(docs).mapInArrow(run, f"{_COUNTED}, pairs array<long>, links array<long>")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def pair_counts(rows: DataFrame, path_b: str) -> DataFrame:
    """``(pair, n, best)``: how many rows of :func:`linked` hold each pair, and whether its A id has none with more."""
    import sentencepiece

    size = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = stage(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "align-counts")
    id_a = F.expr(f"pair div {size}")
    most = stage(counts.groupBy(id_a.alias("a")).agg(F.max("n").alias("most")), "align-most")  # at most A's vocabulary
    return stage(counts.join(most, id_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align-judged")


def frequent_pairs(counts: DataFrame, most: int = FREQUENT_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, counts and best flags of all pairs from a count on that at most ``most`` pairs reach, sorted by pair."""
    level = F.floor(F.log2("n")).cast("int")
    least, held = 63, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):  # 64 rows at most
        if (held := held + r["count"]) > most:
            break
        least = r["level"]
    got = counts.filter(level >= least).toPandas().sort_values("pair")
    return got["pair"].to_numpy(np.int64), got["n"].to_numpy(np.int64), got["best"].to_numpy(bool)


def align(docs: DataFrame, path_a: str, path_b: str, keep: Callable[[Column], Column] = lambda groups: groups, frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum)``, one row per input row.

    A encodes a space and the text, B the text; special strings inside texts are plain text. ``groups`` lists the ids
    of each group (see :func:`linked`; ``keep`` may make it shorter before it is stored). The count of a pair of ids
    is the number of rows that link it; ``n_best`` counts the links whose count is the highest of their A id (ties
    included), ``count_sum`` adds up the counts of all links. Null and empty texts, and texts whose bytes one of the
    tokenizers does not give back, have no tokens: zeros and empty groups. A null id stays null; repeated rows stay, each a
    document of its own; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    found = linked(docs, path_a, path_b).withColumn("groups", F.when(F.col("n_a") > 0, keep(F.col("groups"))).otherwise(F.lit("")))
    rows = stage(found.withColumn("row", F.monotonically_increasing_id()), "align-rows")
    counts = pair_counts(rows, path_b)
    table = spark.sparkContext.broadcast(frequent_pairs(counts, frequent))

    def judge(batches):
        known, n_of, best_of = table.value
        for batch in batches:
            pairs, links = batch.column("pairs"), batch.column("links").flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(pairs.offsets.to_numpy())
            of, code = np.repeat(np.arange(len(pairs)), lengths), pairs.flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(known, code)
            hit = at < len(known)
            hit[hit] = known[at[hit]] == code[hit]
            at, weight = at[hit], links[hit]
            n_best, count_sum = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            np.add.at(n_best, of[hit], weight * best_of[at])
            np.add.at(count_sum, of[hit], weight * n_of[at])
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(of[~hit], minlength=len(pairs)))], pa.int32())
            rest = [pa.ListArray.from_arrays(ends, pa.array(x[~hit], pa.int64())) for x in (code, links)]
            kept = [batch.column(c) for c in (*_names(_COUNTED), "row")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best), pa.array(count_sum), *rest], names)

    names = [*_names(_COUNTED), "row", "n_best", "count_sum", "pairs", "links"]
    judged = stage(rows.mapInArrow(judge, f"{_COUNTED}, row long, n_best long, count_sum long, pairs array<long>, links array<long>"), "align-judged-rows")
    rare = judged.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", "x.pairs", "x.links")
    rest = rare.join(counts, F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum")
    )
    sums = [(F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return judged.drop("pairs", "links").join(rest, "row", "left").select(*_names(_COUNTED), *sums)
