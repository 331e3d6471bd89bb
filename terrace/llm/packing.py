"""Best-fit packing of token pieces into sequences by a configuration linear program.

Only the histogram over piece lengths (at most ``capacity`` numbers) decides which lengths share a sequence. The
program "cover the histogram with as few configurations as possible" is solved by multiplicative weights: lengths
that are behind weigh more, and a knapsack dynamic program prices the best configuration for the current weights.
The fractional solution is rounded down without covering any length twice; what remains is filled best fit, many
equal sequences at a time. Pieces then take their places by their rank within their length, which is counted in
hash buckets so that no length, however frequent, is ordered by one task.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stage, texts_of
from terrace.llm.tokens import blocks, encoder, frequent_parts

CAPACITY = 2048
END_ID = 0
#: Rounds of multiplicative weights, how strongly an open need raises a weight, how far below the best price a
#: configuration may be, and the share of the open need that it buys.
ROUNDS = 32
STEP = 1.0
NEARLY = 0.2
SHARE = 0.8
#: Pieces that one bucket of a length holds at most, about.
BUCKET_PIECES = 100_000
MIN_BUCKETS = 256


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the ids of every whole text and an end id, cut only where too long.

    ``ids`` are little-endian unsigned 32-bit numbers. A null or empty text is the end id alone; a null id stays null;
    repeated rows each give their pieces; an empty table gives no rows; other columns are ignored.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_parts(docs, path))
    end = int(END_ID).to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches):
        enc = encoder(path, frequent)
        for b in batches:
            at = 0
            for block in blocks(b.column(1).to_pylist()):
                out: list[list] = [[], [], [], [], []]
                for doc, ids in zip(b.column(0)[at : at + len(block)].to_pylist(), enc.encode(block)):
                    ids += end
                    for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[s : s + 4 * capacity]
                        for column, value in zip(out, (doc, k, s // 4, len(part) // 4, part)):
                            column.append(value)
                at += len(block)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return texts_of(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def price(weights: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: for each room the most weight that fits, and the piece taken last."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            value = best[c - lengths[: fits[c]]] + weights[: fits[c]]
            k = value.argmax()
            if value[k] > best[c]:
                best[c], took[c] = value[k], k
    return best, took


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """``(configuration, how many sequences)`` that hold the whole histogram, each piece exactly once.

    A round prices with the current weights and lets every length buy its best configuration, if that is nearly the
    best of all, for a share of what its lengths still need. Lengths that fall behind gain weight by the exponential of
    the share of their need that is open; a length whose need is met is worth nothing.
    """
    left = {length: n for length, n in histogram.items() if n > 0 and length < capacity}
    plan = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    lengths = np.array(sorted(left), dtype=np.int64)
    if len(lengths) > 1:
        need = np.array([left[int(x)] for x in lengths], dtype=float)
        open_, total = need.copy(), {}
        for _ in range(rounds):
            weights = np.where(open_ > 0.01, lengths / capacity * np.exp(STEP * open_ / need), 0.0)
            best, took = price(weights, lengths, capacity)
            worth = weights + best[capacity - lengths]
            for i in np.flatnonzero((open_ > 0.01) & (worth >= (1 - NEARLY) * best[capacity]))[::-1]:
                config, room = [int(i)], int(capacity - lengths[i])
                while room > 0:
                    if took[room] < 0:
                        room -= 1
                    else:
                        config.append(int(took[room]))
                        room -= int(lengths[took[room]])
                counts = Counter(config)
                x = SHARE * min(open_[k] / a for k, a in counts.items())
                if x > 0:
                    key = tuple(sorted(counts.items(), reverse=True))
                    total[key] = total.get(key, 0.0) + x
                    for k, a in counts.items():
                        open_[k] -= a * x
        for key, x in sorted(total.items(), key=lambda kv: -kv[1]):
            counts = {int(lengths[k]): a for k, a in key}
            n = min([round(x), *(left[length] // a for length, a in counts.items())])
            if n > 0:
                plan.append((counts, n))
                for length, a in counts.items():
                    left[length] -= n * a
    plan += fill({k: v for k, v in left.items() if v}, capacity)
    return plan


def fill(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit over a histogram: the longest piece, then the subset of the rest that fills the room best."""
    left, plan = dict(left), []
    while left:
        first = max(left)
        config, room = {first: 1}, capacity - first
        while room:
            fits = [x for x in left if x <= room and left[x] > config.get(x, 0)]
            if not fits:
                break
            pair = _closest_pair(fits, left, config, room)
            for x in pair:
                config[x] = config.get(x, 0) + 1
                room -= x
        n = min(left[x] // a for x, a in config.items())
        plan.append((config, n))
        for x, a in config.items():
            left[x] -= n * a
            if not left[x]:
                del left[x]
    return plan


def _closest_pair(fits: list[int], left: dict[int, int], config: dict[int, int], room: int) -> tuple[int, ...]:
    """The longest piece that fits, or two that leave less room."""
    longest = max(fits)
    if longest == room:
        return (longest,)
    open_ = {x: left[x] - config.get(x, 0) for x in fits}
    best: tuple[int, ...] = (longest,)
    for a in sorted(fits, reverse=True):
        b = room - a
        if b > a:
            break
        if open_.get(b, 0) > (a == b):
            return (a, b)
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece has one place, without gaps from offset 0.

    ``pieces`` has ``length`` from 1 to ``capacity`` (any other length is an error, raised by the solver's caller) and
    any further columns, which stay; an input ``sequence_id`` or ``offset`` is replaced. Equal pieces are told apart
    by their order of reading. An empty input gives no rows.
    """
    spark = pieces.sparkSession
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = stage(pieces.select(F.struct(*keep).alias("row"), F.col("length").cast("long").alias("len"), F.monotonically_increasing_id().alias("at")), "pack-pieces")
    histogram = {r.len: r.n for r in rows.groupBy("len").agg(F.count("*").alias("n")).limit(capacity + 1).collect()}
    if any(not (x and 1 <= x <= capacity) for x in histogram):
        raise ValueError(f"piece lengths must be between 1 and {capacity}")
    plan = solve(histogram, capacity, rounds)
    runs, sequence = [], 0  # one run: pieces of one length that one configuration takes
    taken: dict[int, int] = {}
    for config, n in plan:
        offset = 0
        for length, a in sorted(config.items(), reverse=True):
            runs.append((length, taken.get(length, 0), sequence, a, offset))
            taken[length] = taken.get(length, 0) + n * a
            offset += a * length
        sequence += n
    assert taken == histogram, "the plan must hold every piece"
    table = spark.sparkContext.broadcast(_run_table(runs))

    most = max(histogram.values(), default=0)
    buckets = max(MIN_BUCKETS, -(-most // BUCKET_PIECES))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("at"), F.lit(buckets)))
    before = (
        rows.groupBy("len", "bucket").agg(F.count("*").alias("n"))
        .select("len", "bucket", (F.sum("n").over(Window.partitionBy("len").orderBy("bucket")) - F.col("n")).alias("before"))
    )
    local = rows.withColumn("rank", F.row_number().over(Window.partitionBy("len", "bucket").orderBy("at")) - 1)
    ranked = local.join(stage(before, "pack-before"), ["len", "bucket"]).select("row", "len", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches):
        start, length, first, seq, copies, offset = table.value
        for b in batches:
            size, rank = b.column(1).to_numpy(), b.column(2).to_numpy()
            k = np.searchsorted(start, size * _RANKS + rank, "right") - 1
            nth = rank - first[k]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(seq[k] + nth // copies[k]), pa.array(offset[k] + nth % copies[k] * length[k])],
                schema=pa.schema([b.schema.field(0), ("sequence_id", pa.int64()), ("offset", pa.int64())]),
            )

    schema = ranked.select("row").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema).select("row.*", "sequence_id", "offset")


#: Ranks within a length are below this.
_RANKS = 1 << 48


def _run_table(runs: list[tuple]) -> tuple[np.ndarray, ...]:
    """The runs by length and first rank; the first array is one sorted key of both."""
    a = np.array(sorted(runs) or np.zeros((0, 5)), dtype=np.int64).reshape(-1, 5)
    return (a[:, 0] * _RANKS + a[:, 1], a[:, 0], a[:, 1], a[:, 2], a[:, 3], a[:, 4])


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences themselves, of a frame that still has ``ids``."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(held.alias("held")).select(
        "sequence_id", F.aggregate("held", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )
