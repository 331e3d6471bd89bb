"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training documents by the executors (a fixed number of hash buckets). The
weights are fitted by follow-the-regularised-leader (FTRL-proximal) with an elastic net on a bounded, hash-chosen set
per language (:data:`FIT_PER_LANGUAGE`), a fifth of which is kept apart to calibrate one temperature.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import held_out, texts_of

#: Hash buckets, longest n-gram, training documents per language at most, distinct languages at most.
BITS = 16
LONGEST = 3
FIT_PER_LANGUAGE = 1_000
MOST_LANGUAGES = 512
EPOCHS = 3
# FTRL-proximal: step size, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.01
#: Code points looked at together.
CHUNK = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio, a usual multiplier for hashing


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """``(buckets, counts)`` of the n-grams of a whole text; runs of anything but letters count as one space."""
    total = np.zeros(1 << BITS, np.int64) if len(text) > CHUNK else None
    found, carry = None, np.array([32], np.uint64)
    for at in range(0, len(text), CHUNK):
        code = np.frombuffer(text[at : at + CHUNK].lower().encode("utf-32-le", "replace"), np.uint32)
        code = np.where(_letters()[code], code, 32).astype(np.uint64)
        code = np.concatenate([carry, code, np.array([32] if at + CHUNK >= len(text) else [], np.uint64)])
        code = code[np.concatenate([[True], (code[1:] != 32) | (code[:-1] != 32)])]
        start = len(carry) if at else 0
        parts = []
        h = np.zeros(len(code), np.uint64)
        for n in range(1, LONGEST + 1):  # h[i]: hash of the n code points that end at i
            h = np.concatenate([np.zeros(1, np.uint64), h[:-1]]) * _MIX + code + np.uint64(n)
            ends = h[max(n - 1, start) :]
            if n == 1:
                ends = ends[code[max(n - 1, start) :] != 32]
            parts.append(((ends * _MIX) >> np.uint64(64 - BITS)).astype(np.int64))
        found = np.concatenate(parts)
        carry = code[-(LONGEST - 1) :]
        if total is not None:
            total += np.bincount(found, minlength=1 << BITS)
    if total is not None:
        buckets = np.flatnonzero(total)
        return buckets, total[buckets]
    if found is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(found, return_counts=True)


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (buckets + 1, languages); the last row is the bias
    temperature: float

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return tf_idf(buckets, counts, self.idf) @ self.weights[buckets] + self.weights[-1]

    def predict(self, text: str) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` without any letter or any learned language."""
        if not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0
        p = softmax(self.logits(*grams(text)) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def tf_idf(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf[buckets]
    return x / max(1e-12, float(np.sqrt(x @ x)))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Model:
    """The model for rows of ``(language, buckets, counts)``."""
    languages = sorted({r[0] for r in rows})
    k = len(languages)
    rng = np.random.default_rng(seed)
    size = len(idf) + 1
    z, n = np.zeros((size, k)), np.zeros((size, k))

    def weights(at):
        zi, ni = z[at], n[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    data = [(languages.index(r[0]), np.append(r[1], size - 1), np.append(tf_idf(r[1], r[2], idf), 1.0)) for r in rows]
    order = rng.permutation(len(data))
    kept, shown = order[: len(order) // 5], order[len(order) // 5 :]
    for _ in range(epochs if k > 1 else 0):
        for i in rng.permutation(shown):
            y, at, x = data[i]
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(slice(None))
    logits = np.array([data[i][2] @ w[data[i][1]] for i in kept]).reshape(len(kept), k)
    labels = np.array([data[i][0] for i in kept], int)
    return Model(languages, idf, w.astype(np.float32), temperature(logits, labels))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the held-back labels are likeliest, between 1/4 and 20."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _gram_rows(batches):
    for b in batches:
        got = [grams(t.as_py()) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.list_(pa.int64())), pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["lang", "at", "n"])


def _document_frequencies(batches):
    total, docs = np.zeros(1 << BITS, np.int64), 0
    for b in batches:
        for t in b.column(0):
            total[grams(t.as_py())[0]] += 1
            docs += 1
    buckets = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(buckets, -1)), pa.array(np.append(total[buckets], docs))], ["bucket", "n"])


def train(docs: DataFrame, per_language: int = FIT_PER_LANGUAGE) -> Model:
    """Learn from text and language of rows with both, whose id has a crc32 modulo 3 other than 1."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("lang is not null and text is not null").filter(~held_out(F.col("doc_id")))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counted = rows.select("text").mapInArrow(_document_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = np.zeros((1 << BITS) + 1, np.int64)
    for r in counted.collect():  # at most one row per bucket
        df[r.bucket] = r.n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    if not sizes:
        return Model([], idf, np.zeros((len(idf) + 1, 0), np.float32), 1.0)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(2**30 * min(1.0, per_language / n)))])
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(2**30)) < share[F.col("lang")])
    chosen = chosen.orderBy(F.xxhash64("doc_id", "text")).limit(2 * per_language * len(sizes)).select("lang", "text")
    fed = chosen.mapInArrow(_gram_rows, "lang string, at array<long>, n array<long>").collect()
    data = sorted(((r.lang, tuple(r.at), tuple(r.n)) for r in fed))
    return fit([(lang, np.array(at, np.int64), np.array(n, np.int64)) for lang, at, n in data], idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per input row.

    A text that is null or has no letter is ``und`` with score 0; without any learned language every text is. A null
    id stays null and is not held out; repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            got = [m.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    found = texts_of(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
