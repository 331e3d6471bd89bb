"""The prefix trie against a plain tree of dictionaries, with its defined results for odd input."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from terrace.llm import prefix_trie, queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    """Rows of the contract from (conv_id, turn, role, text) with distinct turns in each conversation."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
        convs = {c: convs.get(c - c % 5, [])[: h[c]] + v[h[c] :] for c, v in convs.items()}
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        cost = (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += cost
    ends = lambda node, m: ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(node))))
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node], saved[node], hashlib.sha256(ends(node, m).encode()).hexdigest())
        for node, m in members.items()
    )


def got(df):
    return sorted(map(tuple, df.collect()))


def random_rows(seed, conversations, longest, texts):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            rows.append((c * rng.choice([1, 1, 7]), None if t == 3 else t * 2, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    seen = {}
    for r in rows:  # distinct turns in each conversation
        seen.setdefault(r[:2], r)
    rows = list(seen.values())
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, conversations, longest", [(1, 40, 6), (2, 60, 9), (3, 30, 40)])
def test_trie_equals_brute_force(spark, seed, conversations, longest):
    rows = random_rows(seed, conversations, longest, ["a", "é", "", None])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(prefix_trie.prefix_trie(df)) == brute(rows)


def test_long_conversations_and_small_segments(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    base = [("user" if t % 2 else "assistant", f"turn {t}") for t in range(150)]
    rows = [(c, t, r, x if t != 20 * c else "other") for c in range(1, 7) for t, (r, x) in enumerate(base[: 150 - (c % 3)])] + [(c, 0, "user", "turn 0") for c in range(11, 30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie.prefix_trie(df)) == brute(rows)
    assert got(prefix_trie.trie(prefix_trie.turns_of(df))) == brute(rows, rebuild=False)


def test_query_equals_brute_force_on_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = queries.QUERIES["op13_conversation_prefix_trie"](spark, SMALL)
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    assert got(out) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (0, None, None, None), (3, 1, "user", "long " * 50_000), (3, None, "user", ""), (-7, 1, "user", "x"), (4, 5, "a", "b"), (9, 1, "ab", "c"), (14, 1, "a", "bc")]
    end = (1, 2, "p", 3, 4)
    df = spark.createDataFrame([(*r, *end) for r in rows], SCHEMA + ", block long, at long, prior string, x long, n long")
    assert got(prefix_trie.prefix_trie(df)) == brute(rows)
    assert got(prefix_trie.prefix_trie(df.filter("false"))) == [] and got(prefix_trie.prefix_trie(df.filter("conv_id is null"))) == []
    twice = spark.createDataFrame([(0, 1, "user", "x")] * 2 + [(5, 1, "user", "x")], SCHEMA)
    assert [r[:5] for r in got(prefix_trie.trie(prefix_trie.turns_of(twice)))] == [(0, 0, None, 2, 1), (0, 1, 0, 2, 1), (0, 2, 0, 1, 0)]


def test_one_conversation_with_most_rows_is_numbered_by_many_tasks(spark):
    rows = [(5, t, "user", f"t{t}") for t in range(3000)] + [(c, 0, "user", "x") for c in range(100, 130)] + [(7, 1, "user", "same")] * 40
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA)).collect()
    places = defaultdict(list)
    for r in turns:
        places[r["conv_id"]].append(r["at"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in places.values()) and len(turns) == len(rows)
