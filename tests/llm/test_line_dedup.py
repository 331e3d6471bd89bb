"""Line dedup against a plain brute force, with its defined results for odd input."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from terrace.llm import line_dedup, queries

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, at int, line string, gone string, keeper long"


def brute(rows, min_chars=40, min_documents=5):
    """``rows`` of (doc_id, text): kept text, lines and dropped lines of each, in order."""
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    keeper = {k: max(v, key=lambda i: (i is not None, i or 0)) for k, v in holders.items() if len(v) >= min_documents}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [line for line in lines if keeper.get(key(line), i) == i]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def got(df, **bounds):
    return sorted(map(tuple, line_dedup.dedup(df, **bounds).collect()), key=str)


def random_rows(seed, documents, share):
    """Texts that draw lines from a common pool, in other cases and with other blanks around."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["Alpha", "béta", "ГАММА", "İota", "delta", "ÉPSILON", "zeta", "中文"])
    pool = [" ".join(word() for _ in range(rng.randint(3, 14))) for _ in range(30)]
    rows = []
    for i in range(documents):
        lines = []
        for _ in range(rng.randint(0, 30)):
            line = max(pool, key=len) if rng.random() < share else rng.choice(pool) if rng.random() < 0.5 else " ".join(word() for _ in range(9)) + str(rng.random())
            line = line.swapcase().translate(LOWER) if rng.random() < 0.1 else line.translate(LOWER) if rng.random() < 0.3 else line
            lines.append(rng.choice(["", " ", "\t\x0b", "\x0c "]) + line + rng.choice(["", "\r", "  ", "\xa0"]))
        rows.append((i, "\n".join(lines)))
    return rows


def test_lines_equal_brute_force(spark):
    for seed, share in ((1, 0.0), (2, 0.3), (3, 0.9)):
        rows = random_rows(seed, 60, share)
        want = brute(rows)
        assert sum(n for *_, n in want) > 50
        assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == sorted(want, key=str)
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), min_chars=1, min_documents=2) == sorted(brute(rows, 1, 2), key=str)


def test_bounds_are_40_code_points_and_5_documents(spark):
    long, short = "é" * 40, "é" * 39
    rows = [(i, f"{long}\n{short}\nown {i}") for i in range(5)] + [(9, "x" * 40), (10, "x" * 40), (11, "x" * 40), (12, "X" * 40)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(
        [(i, f"{short}\nown {i}", 3, 1) for i in range(4)] + [(4, rows[4][1], 3, 0)] + [(i, t, 1, 0) for i, t in rows[5:]], key=str
    )


def test_the_largest_document_keeps_all_places_and_others_lose_all(spark):
    line = "The same line of boilerplate that every document here holds."
    rows = [(i, "\n".join([line, "", line.upper(), f"own {i}", line])) for i in range(6)]
    out = dict((r[0], r[1:]) for r in got(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[5] == (rows[5][1], 5, 0) and out[0] == ("\nown 0", 5, 3)


def test_odd_rows(spark):
    line, end = "a line of more than forty code points, of many documents", ("x", None, 3, 1, 2, "l", "g", 7)
    rows = [(None, None), (1, None), (2, ""), (3, "\n"), (None, f"{line}\nof no id"), (4, line), (5, line), (5, line), (5, f"{line}\nagain"), (6, line.title()),
            (7, f"  {line}  "), (7, f"  {line}  "), (8, "\n".join([line, "z" * 50] * 20_000)), (-3, line)]
    df = spark.createDataFrame([(*r, *end) for r in rows], SCHEMA)
    assert got(df) == sorted(brute(rows), key=str)
    assert got(df.filter("false")) == []
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(line).alias("text"))
    assert [r for r in got(hot) if r[3] == 0] == [(2999, line, 1, 0)]


def test_query_has_the_digest_of_the_kept_text(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute(rows))
    assert sorted(map(tuple, queries.QUERIES["op11_line_dedup"](spark, sf).collect())) == want and any(d for _, _, d, _ in want)


def test_no_python_runs(spark):
    df = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    plan = line_dedup.dedup(df)._jdf.queryExecution().toString()  # noqa: SLF001
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
