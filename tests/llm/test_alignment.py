"""Cross-tokenizer alignment against token lists matched by hand, with its defined results for odd input."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from terrace.llm import alignment, queries

SMALL = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  two", "a", "<s> </s> <|endoftext|> <0x41>", "a▁b", "\x00\t\n\r x", "日本語 und Ёжик", "ﬁ İ Ǻ", "a" * 5000, "é" * 300, "​", "😀" * 50]


def brute(texts):
    """Contract columns without doc_id, from lists and dictionaries only."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(x): x for x in printable} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in printable)}
    docs = []
    for text in texts:
        groups = []
        if text:
            ia, ib, data = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
            ta = [bytes(chars[c] for c in a.id_to_token(i)) for i in ia]
            tb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
            if b"".join(ta) == data == b"".join(tb):
                ends = [np.cumsum([*map(len, t)]).tolist() for t in (ta, tb)]
                both = sorted({*ends[0]} & {*ends[1]})
                groups = [([], []) for _ in both]
                for side, ids in enumerate((ia, ib)):
                    g = 0
                    for i, end in zip(ids, ends[side]):
                        groups[g][side].append(i)
                        g += end == both[g]
        docs.append(groups)
    count = Counter(p for groups in docs for p in {(x, y) for ga, gb in groups for x in ga for y in gb})
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for groups in docs:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        told = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        out.append((sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), len(links), told,
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links)))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(120).collect()] + [(1000 + i, t) for i, t in enumerate(ODD)]


@pytest.mark.parametrize("frequent", [0, 200, alignment.FREQUENT_PAIRS])
def test_alignment_equals_brute_force(spark, rows, frequent):
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), A, B, frequent=frequent).collect()
    assert sorted(map(tuple, got)) == sorted((i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows])))


def test_query_returns_the_digest_of_the_groups(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_cross_tokenizer_alignment"](spark, SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    told = [(i, *r[:4], hashlib.sha256(r[4].encode()).hexdigest() if r[0] else "", *r[5:]) for (i, _), r in zip(docs, brute([t for _, t in docs]))]
    assert sorted(map(tuple, got.collect())) == sorted(told)


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, row long, pairs string, links string, n long, best string"
    rows = [(None, "same text", None, 1, "p", "l", 2, "b"), (None, None, "x", 1, "p", "l", 2, "b"), (3, "same text", "x", None, None, None, None, None), (3, "same text", "x", None, None, None, None, None)]
    got = sorted(map(tuple, alignment.align(spark.createDataFrame(rows, schema), A, B).collect()), key=str)
    assert got == sorted([(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows]))], key=str)
    assert alignment.align(spark.createDataFrame([], schema), A, B).collect() == []
    assert alignment.align(spark.createDataFrame([(1, None)], "doc_id long, text string"), A, B).collect()[0][:6] == (1, 0, 0, 0, 0, "")


def test_texts_with_one_space_at_the_end(spark):
    texts = ["a ", "two words ", "two  words ", " a ", "a  ", "a \n", "a\n ", "日 ", "two", "two words \n "]
    got = alignment.align(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), A, B).collect()
    assert sorted(map(tuple, got)) == [(i, *r) for i, r in enumerate(brute(texts))]
    assert min(r.n_a for r in got) > 0


def test_products_equal_dense_ones_in_blocks_of_any_size():
    rng = np.random.default_rng(5)
    for n, k, m in ((1, 1, 1), (7, 5, 9), (30, 40, 20), (5, 1, 5)):
        a, b = rng.integers(0, 3, (n, k)) * rng.integers(0, 2, (n, k)), rng.integers(0, 3, (k, m)) * rng.integers(0, 2, (k, m))
        sparse = [alignment.accumulated(*np.nonzero(x), x[np.nonzero(x)], *x.shape) for x in (a, b)]
        for most in (1, 7, 1 << 20):
            dense = np.zeros((n, m), int)
            for rows, columns, values in alignment.product(*sparse, m, most):
                np.add.at(dense, (rows, columns), values)
            assert (dense == a @ b).all()


def test_overlaps_are_the_common_bytes():
    rng = random.Random(3)
    for _ in range(50):
        n = rng.randint(1, 60)
        cuts = [sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n))}) for _ in range(2)]
        lengths = [np.diff([0, *c]) for c in cuts]
        found = alignment.align_tokens(np.arange(len(cuts[0])), lengths[0], np.arange(len(cuts[1])), lengths[1])
        owner = [np.repeat(np.arange(len(x)), x).tolist() for x in lengths]
        assert Counter(zip(*owner)) == {(i, j): s for i, j, s in zip(*(x.tolist() for x in found.overlaps))}
        assert int(found.group_a[-1]) + 1 == len({*cuts[0]} & {*cuts[1]})


def test_products_of_entries_that_meet_one_row_or_many_are_those_of_dense_matrices():
    rng = np.random.default_rng(3)
    for wide in (False, True):
        for most in (1, 7, 1 << 20):
            x = rng.integers(0, 3, (9, 6)) * rng.integers(1, 5, (9, 6))
            y = rng.integers(0, 3, (6, 8)) if wide else np.eye(6, 8, dtype=int)[rng.permutation(6)] * 4
            sparse = [alignment.accumulated(*np.nonzero(m), m[np.nonzero(m)], *m.shape) for m in (x, y)]
            got = np.zeros((9, 8), int)
            for rows, columns, values in alignment.product(*sparse, 8, most):
                assert not got[rows, columns].any()
                got[rows, columns] = values
            assert (got == x @ y).all()
