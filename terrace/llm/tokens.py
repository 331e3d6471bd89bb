"""Exact tokenisation of whole texts with caches of what words encode to, and token counts.

A public tokenizer encodes each pre-token by itself, so what a text encodes to can be put together from its
pre-tokens. :class:`WordEncoder` cuts a text at places where a pre-token must end and looks the parts up: first in
a broadcast table of frequent parts, then in a cache of the worker; only parts in neither reach the library.
Nothing is shuffled. Texts outside a plain set of characters, with special strings, or of another kind of tokenizer
go to the library whole; the result is the library's in every case.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import Counter
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import hash_bounded, texts_of

#: Frequent parts in the broadcast table, and the documents looked at to choose them (what a cache holds changes no
#: result).
FREQUENT_PARTS = 40_000
FREQUENT_DOCS = 2_000
#: Parts that a worker keeps, and the longest that it keeps.
CACHE_PARTS = 500_000
CACHE_CHARS = 40
#: Code points encoded at a time.
BLOCK_CHARS = 1 << 18

#: Characters for which every Unicode version agrees on letter, number and white space; all are in normal form.
_OTHER = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xff]")
_TWO_SPACES = re.compile(r"[\t\n\r ][\t\n\r ]")

# The split patterns by which the two kinds of tokenizer are known.
_GPT_LIKE = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same patterns over the plain characters.
_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PRETOKENS = {
    "gpt": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\t\n\r {_L}{_N}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+",
    "lower": rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t\n\r {_L}{_N}]+",
}
_PARTS = re.compile(r"[\t\n\r]| ?[^\t\n\r ]+| ").findall


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ... in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_CHARS = _byte_chars()


class WordEncoder:
    """Encodes texts with the tokenizer in ``path``; ``frequent`` maps parts to their ids as little-endian bytes.

    A part that neither the frequent ones nor the cache hold is split into its pre-tokens, which are looked up in
    turn; only an unknown pre-token is merged by the tokenizer's model.
    """

    def __init__(self, path: str, frequent: dict[str, bytes] | None = None, cache_parts: int = CACHE_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = _kind(spec)
        self.special = tuple(t["content"] for t in spec.get("added_tokens") or ())
        self.frequent, self.table, self.cache_parts = frequent or {}, dict(frequent or {}), cache_parts
        self.pretokens = re.compile(_PRETOKENS.get(self.kind, "")).findall
        self.merge, self.get = self.tokenizer.model.tokenize, self.table.get

    def plain(self, text: str) -> bool:
        """Whether the text can be cut into parts."""
        if self.kind == "whole" or _OTHER.search(text) or any(s in text for s in self.special):
            return False
        if self.kind == "lower":  # a special string must not arise by lower-casing
            return "<|" not in text
        return not _TWO_SPACES.search(text)

    def parts(self, text: str) -> list[str]:
        """Parts of a plain text whose ids follow each other in the ids of the text."""
        if self.kind == "lower":
            return text.lower().split()
        return _PARTS(text)  # white space stands alone here, so a line end is a part and a space opens one

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [self.parts(t) if self.plain(t) else None for t in texts]
        whole = iter(self._library([t for t, c in zip(texts, cut) if c is None]))
        out = []
        for c in cut:
            if c is None:
                out.append(next(whole))
                continue
            ids = list(map(self.get, c))
            if None in ids:
                ids = [self._part(p) if i is None else i for p, i in zip(c, ids)]
            out.append(b"".join(ids))
        return out

    def counts(self, texts: list[str]) -> list[int]:
        """The number of ids of each text."""
        return [len(b) // 4 for b in self.encode(texts)]

    def _part(self, part: str) -> bytes:
        pre = self.pretokens(part)
        if len(pre) == 1:
            ids = array("I", [t.id for t in self.merge(pre[0].encode().decode("latin-1").translate(_BYTE_CHARS))]).tobytes()
        else:
            ids = b"".join([self.get(p) or self._part(p) for p in pre])
        if len(part) <= CACHE_CHARS:
            if len(self.table) >= self.cache_parts + len(self.frequent):  # the older half of the cache goes
                self.table = self.frequent | dict(islice(self.table.items(), len(self.frequent) + self.cache_parts // 2, None))
                self.get = self.table.get
            self.table[part] = ids
        return ids

    def _library(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for block in blocks(texts):
            got = self.tokenizer.encode_batch_fast(block, add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in got]
        return out


def _kind(spec: dict) -> str:
    """gpt: byte-level with a leading space; lower: lower-cased words, white space dropped; whole: any other."""
    pre, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    simple = all(not t.get(k) for t in spec.get("added_tokens") or () for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if spec["model"]["type"] != "BPE" or spec["model"].get("dropout") or spec.get("truncation") or spec.get("padding") or not simple:
        return "whole"
    if normal is None and all(pre.get(k) == v for k, v in _GPT_LIKE.items()):
        return "gpt"
    steps = [(n["type"], n.get("content")) for n in (normal or {}).get("normalizers", [])]
    cuts = pre.get("pretokenizers", [])
    if (
        steps == [("NFC", None), ("Replace", " "), ("Lowercase", None)]
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"].get("Regex") == _WORD_SPLIT
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
    ):
        return "lower"
    return "whole"


def blocks(texts: list[str], most: int = BLOCK_CHARS):
    """Runs of texts of at most ``most`` code points together (or one longer text)."""
    block, n = [], 0
    for t in texts:
        if block and n + len(t) > most:
            yield block
            block, n = [], 0
        block.append(t)
        n += len(t)
    if block:
        yield block


def frequent_parts(docs: DataFrame, path: str, parts: int = FREQUENT_PARTS) -> dict[str, bytes]:
    """The table for the first tier: the most frequent parts of a bounded, hash-chosen set of documents, encoded."""

    def count(batches):
        enc, seen = encoder(path), Counter()
        for b in batches:
            for t in b.column(0):
                if enc.plain(text := t.as_py()):
                    seen.update(p for p in enc.parts(text) if len(p) <= CACHE_CHARS)
        top = seen.most_common(parts)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array(enc.encode([p for p, _ in top]), pa.binary())], ["part", "ids"])

    some = hash_bounded(texts_of(docs), F.xxhash64("doc_id", F.length("text")), FREQUENT_DOCS).select("text").coalesce(1)
    return {part: bytes(ids) for part, ids in some.mapInArrow(count, "part string, ids binary").limit(parts).collect()}


@lru_cache(maxsize=4)
def _encoder(path: str, frequent) -> WordEncoder:
    """One encoder per worker, tokenizer and broadcast table, kept across tasks with its cache."""
    return WordEncoder(path, frequent.value if frequent is not None else None)


def encoder(path: str, frequent=None) -> WordEncoder:
    return _encoder(path, frequent)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every whole text, one row per input row.

    A null or empty text has no byte and no token; a null id stays null; repeated rows stay; an empty table gives no
    rows; other columns are ignored. Special strings inside texts count as the library counts them by default.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_parts(docs, path))

    def run(batches):
        enc = encoder(path, frequent)
        for b in batches:
            n = [c for block in blocks(b.column(2).to_pylist()) for c in enc.counts(block)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    texts = texts_of(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
