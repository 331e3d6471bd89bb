"""Every sentence that has enough words from it on starts a paragraph."""

import os
import random

from terrace.llm import substring_dedup


def _starts(words: list[str]) -> list[tuple[int, int]]:
    ends = [k + 1 for k, w in enumerate(words) if w[-1] in ".!?" or k == len(words) - 1]
    found = []
    for start in [0, *ends[:-1]]:
        end = next((e for e in ends if e >= start + substring_dedup.MIN_WORDS), None)
        if end:
            found.append((start, end))
    return found


def test_every_sentence_start_is_a_paragraph():
    r = random.Random(3)
    texts = []
    for _ in range(40):
        words = []
        for _ in range(r.randrange(30)):
            words += [f"w{r.randrange(50)}" for _ in range(r.randrange(1, 20))]
            words[-1] += r.choice(".!?")
        texts.append(" ".join(words + ["loose", "end"][: r.randrange(3)]))
    texts += ["", " ", "one two three.", " ".join(f"w{k}" for k in range(25))]
    p = substring_dedup.paragraphs(texts, sentences_only=True)
    got = [[] for _ in texts]
    for t, first, end in zip(p.text.tolist(), p.first.tolist(), p.end.tolist()):
        got[t].append((first, end))
    assert got == [_starts(t.split()) for t in texts] and sum(map(len, got)) > 200


def test_a_passage_of_one_paragraph_is_found(spark):
    """Two sentences of 26 words, too short for an anchor of its own, between other sentences."""
    r = random.Random(8)
    sentence = lambda n: [f"w{r.randrange(5000)}" for _ in range(n - 1)] + [f"w{r.randrange(5000)}."]
    rows, pairs = [], 40
    for k in range(pairs):
        passage = sentence(13) + sentence(13)
        for side in range(2):
            around = [w for _ in range(6) for w in sentence(r.randrange(5, 15))], [w for _ in range(6) for w in sentence(r.randrange(5, 15))]
            rows.append((2 * k + side, " ".join(around[0] + passage + around[1])))
    found = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id for x in found} == set(range(2 * pairs)) and sum(x.removed for x in found) >= pairs


def test_a_dropped_frame_leaves_no_files(spark):
    from terrace.llm.common import dropped, stage

    held = stage(spark.range(5), "held").union(stage(spark.range(5), "held"))
    files = held.inputFiles()
    assert held.count() == 10
    dropped(held)
    assert files and not any(os.path.exists(os.path.dirname(f.removeprefix("file://"))) for f in files)
