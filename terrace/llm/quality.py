"""Quality classifier: a factorisation machine over hashed words, structure statistics and text metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): the pairwise interactions in time
linear in the words, by the sum-of-squares identity. Only text is an input. The machine is fitted by mini-batch Adam on
a bounded, hash-chosen set of labelled rows (:data:`FIT_ROWS`); their features are built by the executors.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import hash_bounded, held_out, texts_of, unused_name

#: Labelled rows to fit on at most, hash buckets for words, rank of the interactions.
FIT_ROWS = 6_000
BUCKETS = 1 << 14
RANK = 8
EPOCHS = 12
BATCH = 64
RATE = 0.01
DECAY = 1e-4
#: Words counted at a time, so that memory stays bounded for any text.
CHUNK_WORDS = 1 << 17

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "distinct_share", "top_share", "repeat_share", "upper_share", "digit_share",
    "mark_share", "bang_share", "symbol_share", "lines_per_word", "short_share", "long_share", "words_per_sentence",
)
_MARKS = re.compile(r"[!?]")
_SYMBOLS = re.compile(r"[|#*_~^<>{}\[\]\\=+/@$%&]")
_ENDS = re.compile(r"[.!?](?=\s|$)")


def features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, values, statistics)`` of a whole text; values are log counts of hashed words, of length one."""
    words = text.split()
    counts: dict[str, int] = {}
    repeated, previous = 0, None
    for w in words:
        counts[w] = counts.get(w, 0) + 1
        repeated += w == previous
        previous = w
    n, chars = max(1, len(words)), max(1, len(text))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stats = np.array([
        np.log1p(len(text.encode())), np.log1p(len(words)), lengths.mean() if len(words) else 0.0, len(counts) / n,
        max(counts.values(), default=0) / n, repeated / n, sum(map(str.isupper, text)) / chars,
        sum(map(str.isdigit, text)) / chars, sum(text.count(c) for c in ".,;:") / chars, len(_MARKS.findall(text)) / n,
        len(_SYMBOLS.findall(text)) / n, text.count("\n") / n, (lengths <= 2).mean() if len(words) else 0.0,
        (lengths >= 12).mean() if len(words) else 0.0, len(words) / (1 + len(_ENDS.findall(text))),
    ])
    hashed: dict[int, int] = {}
    for w, c in counts.items():
        b = zlib.crc32(w.lower().encode()) % BUCKETS
        hashed[b] = hashed.get(b, 0) + c
    at = np.fromiter(hashed, np.int64, len(hashed))
    x = np.log1p(np.fromiter(hashed.values(), float, len(hashed)))
    return at, x / max(1e-9, np.sqrt(x @ x)), stats


class Machine(NamedTuple):
    w0: float
    w: np.ndarray  # BUCKETS + statistics
    v: np.ndarray  # (BUCKETS + statistics, RANK)
    mean: np.ndarray
    spread: np.ndarray

    def inputs(self, at: np.ndarray, x: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((stats - self.mean) / self.spread, -4, 4) / np.sqrt(len(stats))
        return np.concatenate([at, BUCKETS + np.arange(len(stats))]), np.concatenate([x, z])

    def score(self, at: np.ndarray, x: np.ndarray, stats: np.ndarray) -> float:
        i, x = self.inputs(at, x, stats)
        vx = self.v[i] * x[:, None]
        s = self.w0 + self.w[i] @ x + 0.5 * float((vx.sum(0) ** 2 - (vx**2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(s, -30, 30))))


def fit(rows: list[tuple], rank: int = RANK, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """The machine for rows of ``(label, buckets, values, statistics)``; without rows, or with one label only, a constant."""
    size = BUCKETS + len(STATISTICS)
    rng = np.random.default_rng(seed)
    y = np.array([r[0] for r in rows], float)
    stats = np.array([r[3] for r in rows], float).reshape(len(rows), len(STATISTICS))
    mean = stats.mean(0) if len(rows) else np.zeros(len(STATISTICS))
    spread = np.maximum(stats.std(0), 1e-6) if len(rows) else np.ones(len(STATISTICS))
    share = (y.sum() + 1) / (len(y) + 2)
    p = {"w0": np.array([np.log(share / (1 - share))]), "w": np.zeros(size), "v": rng.normal(0, 0.05, (size, rank))}
    if 0 < y.sum() < len(y):
        shell = Machine(0.0, p["w"], p["v"], mean, spread)
        inputs = [shell.inputs(np.asarray(r[1], np.int64), np.asarray(r[2], float), s) for r, s in zip(rows, stats)]
        moment = {k: (np.zeros_like(a), np.zeros_like(a)) for k, a in p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for batch in (order[k : k + BATCH] for k in range(0, len(order), BATCH)):
                step += 1
                i = np.concatenate([inputs[k][0] for k in batch])
                x = np.concatenate([inputs[k][1] for k in batch])
                row = np.repeat(np.arange(len(batch)), [len(inputs[k][0]) for k in batch])
                first = np.searchsorted(row, np.arange(len(batch)))
                vx = p["v"][i] * x[:, None]
                total = np.add.reduceat(vx, first)
                s = p["w0"] + np.add.reduceat(p["w"][i] * x, first) + 0.5 * (total**2 - np.add.reduceat(vx**2, first)).sum(1)
                d = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y[batch]) / len(batch)
                used, inverse = np.unique(i, return_inverse=True)
                gw, gv = np.zeros(len(used)), np.zeros((len(used), rank))
                np.add.at(gw, inverse, d[row] * x)
                np.add.at(gv, inverse, (d[row] * x)[:, None] * (total[row] - vx))
                for name, at, g in (("w0", slice(None), np.array([d.sum()])), ("w", used, gw), ("v", used, gv)):
                    a, (m, q) = p[name], moment[name]
                    g = g + (0 if name == "w0" else DECAY) * a[at]
                    m[at] = 0.9 * m[at] + 0.1 * g
                    q[at] = 0.999 * q[at] + 0.001 * g * g
                    a[at] -= RATE * (m[at] / (1 - 0.9**step)) / (np.sqrt(q[at] / (1 - 0.999**step)) + 1e-8)
    return Machine(float(p["w0"][0]), p["w"], p["v"], mean, spread)


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Machine:
    """Fit on at most ``rows`` labelled documents of the training fold (ids whose crc32 modulo 3 is not 1).

    Labels other than 0 and 1, null ids and labels without a document are left out; a document with several labels
    is several rows.
    """
    learn = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    learn = hash_bounded(learn.filter("label_id is not null and quality in (0, 1)").filter(~held_out(F.col("label_id"))), F.col("label_id"), rows)
    shown = texts_of(docs).join(F.broadcast(learn), F.col("doc_id") == F.col("label_id")).select("label_id", "quality", "text")  # at most `rows` small rows

    def build(batches):
        for b in batches:
            got = [features(t.as_py()) for t in b.column(2)]
            columns = [pa.array([g[0] for g in got], pa.list_(pa.int64())), pa.array([g[1] for g in got], pa.list_(pa.float64())), pa.array([g[2] for g in got], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], ["label_id", "quality", "at", "x", "stats"])

    fed = shown.mapInArrow(build, "label_id long, quality int, at array<long>, x array<double>, stats array<double>")
    fed = hash_bounded(fed, F.xxhash64("label_id", "quality", "at"), rows)  # repeated documents stay within the bound
    return fit([(r.quality, r.at, r.x, r.stats) for r in sorted(fed.collect(), key=lambda r: (r.label_id, r.quality, r.at))])


def scorer(docs: DataFrame, machine: Machine):
    """A column function: the score of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts):
        m = shared.value
        return texts.map(lambda t: m.score(*features(t or "")))

    return score


def classify(docs: DataFrame, machine: Machine) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    Null and empty texts get a score like any other; a null id stays null and is not held out; repeated rows stay; an
    empty table gives no rows; other columns are ignored.
    """
    scored = texts_of(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(docs, machine)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, machine: Machine, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, whose score is at least ``least``."""
    name = unused_name(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn(name, scorer(docs, machine)(text)).filter(F.col(name) >= least).drop(name)
