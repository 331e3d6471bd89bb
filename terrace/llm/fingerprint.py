"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in numpy within Arrow batches.

A paragraph is a line with a character other than white space; a document is the set of its paragraphs' digests. Lines
may be cut further, at sentence ends or into words (:func:`sentences`, what the registered query does), so
that documents of one or few long lines share digests with an edited text too. A
sketch has :data:`TABLES` x :data:`CELLS` cells; each digest is added to one cell of every table: the cell counts it and
takes it in by exclusive or. Subtracting the sketches of two versions leaves the digests in only one of them; cells with
a single one of those show it (its low bits check its high bits), and taking it out of its other cells may show more.
If this peeling gets stuck, the difference is too large for the sketch, and the pair is sketched again four times as
large, until it peels. The counts left in the cells tell about how large the difference is, and so which retry comes first.

Every document meets the next one in a range partitioning by id: a task reads its rows in order and holds one document
besides the batch it reads. Only the documents at the ends of partitions meet in a join, one row a partition.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stage, texts_of

TABLES = 3
CELLS = 16
#: Characters of a piece between sentence ends from which on its words are paragraphs.
LONG_PIECE = 200
#: Rounds of peeling within one sketch (each takes out all digests that show), and retries, each four times as large.
ROUNDS = 64
RETRIES = 10
#: Digests of the expected difference for each block of cells of the first retry.
LOAD = 24
_CHECK_BITS = np.uint64(24)
_CHECK = np.uint64((1 << 24) - 1)
_END = re.compile(r"[.!?;:。！？][ \t]|[。！？]")
_WORD = re.compile(r"(?<=[ \t])")


def lines(text: str) -> list[str]:
    return text.split("\n")


def sentences(text: str) -> list[str]:
    """The lines, cut further behind a sentence end and the blank after it, and into words where that leaves a long piece."""
    out = []
    for piece in _END.sub("\\g<0>\n", text).split("\n"):
        if len(piece) > LONG_PIECE:
            out += _WORD.split(piece)
        else:
            out.append(piece)
    return out


def _mixed(v: np.ndarray, salt: int) -> np.ndarray:
    """Well mixed 64 bits of each value: two multiplications with shifts between."""
    v = (v ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    v = (v ^ (v >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return v ^ (v >> np.uint64(29))


def _with_check(high: np.ndarray) -> np.ndarray:
    return high << _CHECK_BITS | _mixed(high, 1) & _CHECK


def digests(text: str, parts=lines) -> np.ndarray:
    """The distinct digests of a text's paragraphs, in order: 40 bits of hash above 24 bits that check them."""
    hashes = {xxhash.xxh64_intdigest(p) for p in parts(text) if p.strip(" \t\r\x0b\x0c")}
    return np.unique(_with_check(np.fromiter(hashes, np.uint64, len(hashes)) >> _CHECK_BITS))


class Sketch(NamedTuple):
    """The counts and contents of the cells, block after block, in each block table after table."""

    n: np.ndarray
    x: np.ndarray


def _places(found: np.ndarray, level: int) -> np.ndarray:
    """The cell of each digest in every table, a row a table; every level deals anew."""
    h = _mixed(found, level + 2)
    block = (h >> np.uint64(32)) & np.uint64(4**level - 1)
    cell = [h >> np.uint64(8 * t) & np.uint64(CELLS - 1) for t in range(TABLES)]
    return np.stack([(block * np.uint64(TABLES) + np.uint64(t)) * np.uint64(CELLS) + c for t, c in enumerate(cell)]).astype(np.int64)


def sketch(found: np.ndarray, level: int = 0) -> Sketch:
    size, at = 4**level * TABLES * CELLS, _places(found, level)
    x = np.zeros(size, np.uint64)
    for table in at:
        np.bitwise_xor.at(x, table, found)
    return Sketch(np.bincount(at.ravel(), minlength=size), x)


def subtract(a: Sketch, b: Sketch) -> Sketch:
    return Sketch(a.n - b.n, a.x ^ b.x)


def peel(cells: Sketch, level: int = 0) -> int | None:
    """How many digests only one version has, by taking them out of the cells one round after the other; None if it gets stuck."""
    n, x, only = cells.n.copy(), cells.x.copy(), 0
    for _ in range(ROUNDS):
        single = np.flatnonzero(np.abs(n) == 1)
        single = single[_with_check(x[single] >> _CHECK_BITS) == x[single]]
        if not len(single):
            break
        shown, first = np.unique(x[single], return_index=True)
        sign = n[single[first]]
        for table in _places(shown, level):
            np.subtract.at(n, table, sign)
            np.bitwise_xor.at(x, table, shown)
        only += len(shown)
    return None if n.any() or x.any() else only


def _expected(cells: Sketch, apart: int) -> float:
    """About how many digests a difference has that got stuck: of random signs, the squares of a table's counts sum up to it."""
    squares = float((cells.n.astype(np.float64) ** 2).sum()) / TABLES
    return max(squares - apart * apart / CELLS, abs(apart), 1.0)


def only_in_one(a: np.ndarray, b: np.ndarray, sa: Sketch, sb: Sketch) -> int:
    """How many digests only one of two versions has.

    Their sketches are subtracted and peeled; where that gets stuck they are sketched again, first for the difference that
    the counts tell, then four times as large each time. A pair stuck after the last retry is compared digest by digest.
    """
    rest = subtract(sa, sb)
    only = peel(rest)
    if only is None:
        level = 1
        while level < RETRIES and 4**level * LOAD < _expected(rest, len(a) - len(b)):
            level += 1
        while only is None and level <= RETRIES:
            only = peel(subtract(sketch(a, level), sketch(b, level)), level)
            level += 1
    return len(np.setxor1d(a, b)) if only is None else only


def text_of(cells: Sketch, count: int) -> str:
    """A fingerprint as text: the number of digests, a colon, and the counts and the contents of the cells, comma-joined."""
    return f"{count}:{','.join(map(str, cells.n.tolist()))}:{','.join(map(str, cells.x.tolist()))}"


def likeness(first: int, second: int, only: int) -> float:
    """Jaccard similarity from both numbers of digests and the number found in one only; two empty sets are alike."""
    return 1.0 if first + second == 0 else (first + second - only) / (first + second + only)


class _Document:
    """A text with its digests and their sketch."""

    def __init__(self, text: str, parts):
        self.text = text
        self.digests = digests(text, parts)
        self.sketch = sketch(self.digests)

    def like(self, other: _Document) -> float:
        return likeness(len(self.digests), len(other.digests), only_in_one(self.digests, other.digests, self.sketch, other.sketch))

    def fingerprint(self) -> str:
        return text_of(self.sketch, len(self.digests))


_RESULT = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_RESULT_ARROW = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_NAMES = [n for n, _ in _RESULT_ARROW]
# Besides results: the first (end 0) and the last (end 1) document of a partition, the latter with the number of its rows.
_ROWS = _RESULT + ", part int, end int, end_text string, copies long"
_ROWS_ARROW = pa.schema([*_RESULT_ARROW, ("part", pa.int32()), ("end", pa.int32()), ("end_text", pa.string()), ("copies", pa.int64())])
#: Characters of results that a task gathers before it hands them on.
_BATCH_CHARS = 4_000_000


def _result(doc_id: int | None, doc: _Document, after: _Document, keep, parts) -> tuple:
    need = len(doc.text) // 3
    edited = _Document(doc.text[: len(doc.text) - need] + after.text[:need], parts)
    return doc_id, len(doc.text), keep(edited.text), doc.fingerprint(), edited.fingerprint(), doc.like(edited), doc.like(after)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if chars >= _BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _along(rows: Iterator[tuple], keep, parts) -> Iterator[tuple]:
    """Results of ``(doc_id, text, part)`` in order, each against the next that differs; the first and the last document besides."""
    now = doc = None
    copies = part = 0
    none = (None,) * (len(_NAMES) - 1)
    for doc_id, text, part in rows:
        if now is not None and (doc_id, text) == (now[0], doc.text):
            copies += 1
            continue
        after = _Document(text, parts)
        if now is None:
            yield (doc_id, *none, part, 0, text, None)
        else:
            result = (*_result(now[0], doc, after, keep, parts), part, None, None, None)
            for _ in range(copies):
                yield result
        now, doc, copies = (doc_id,), after, 1
    if now is not None:
        yield (now[0], *none, part, 1, doc.text, copies)


def fingerprints(docs: DataFrame, keep: Callable[[str], str] = str, parts=lines) -> DataFrame:
    """``(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next)``, one row per input row.

    The edited text has its last third replaced by as much of the next document's start, descending ``doc_id`` (after the
    last: the first); ``keep`` says what of it is returned (all of it, or a function of it), ``parts`` how texts are cut
    into paragraphs. A null text counts as empty; null ids come last, rows of equal id
    stand in the order of a hash of their texts, and rows equal in both share one place but each give a row; a single
    document is its own next. Other columns are ignored. An empty table gives no rows.
    """

    def along(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        return _batches(_along(rows, keep, parts), _ROWS_ARROW)

    def meet(batches):
        def rows():
            for b in batches:
                for doc_id, text, copies, after in zip(*(c.to_pylist() for c in b.columns)):
                    result = _result(doc_id, _Document(text, parts), _Document(after, parts), keep, parts)
                    for _ in range(copies):
                        yield result

        return _batches(rows(), pa.schema(_RESULT_ARROW))

    texts = texts_of(docs)
    n = max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [F.desc_nulls_last("doc_id"), F.asc(F.xxhash64("text"))]  # no text: the driver samples these for the ranges
    ordered = texts.repartitionByRange(n, *by).sortWithinPartitions(*by, F.asc("text"))
    rows = stage(ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(along, _ROWS), "fp-rows")
    # One row a partition: each that has documents, and the next such partition (after the last: the first).
    first, last = rows.filter("end = 0"), rows.filter("end = 1").select("doc_id", "end_text", "copies", "part")
    one = Window.orderBy("part")
    follow = first.select("part", F.coalesce(F.lead("part").over(one), F.first("part").over(one)).alias("next"))
    heads = first.select(F.col("part").alias("next"), F.col("end_text").alias("after"))
    ends = last.join(follow, "part").join(heads, "next").select("doc_id", "end_text", "copies", "after")
    return rows.filter("end is null").select(*_NAMES).union(ends.mapInArrow(meet, _RESULT))
