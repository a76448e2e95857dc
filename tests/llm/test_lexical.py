"""Ranked lexical search against scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from reclake.llm.lexical import rank_documents

TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERMS.findall((text or "").translate(A_TO_Z))


def _by_hand(docs, items, top):
    vectors = [(key, Counter(_terms(text))) for key, text in docs if _terms(text)]
    total, documents = sum(sum(v.values()) for _, v in vectors), len(vectors)
    df = Counter(term for _, v in vectors for term in v)
    answers = []
    for item, text in sorted(set((item, text) for item, text in items if text is not None), key=str):
        scored = []
        for key, v in vectors:
            m = 100 - 50 + 50 * sum(v.values()) * documents // total
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[term] + 1))) * (1_000_000_000 * v[term] // (1000 * v[term] + 20 * m))
                for term in set(_terms(text)) if term in v)
            if score > 0:
                scored.append((-score, key is None, key))
        for rank, (score, _, key) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:top], 1):
            answers.append((item, rank, key, -score))
    return sorted(answers, key=str)


def _corpus(seed, size):
    draw = random.Random(seed)
    words = [f"w{at}" for at in range(60)] + ["ÄÖ", "straße", "日本", "İx"]
    weights = [1 / (at + 1) for at in range(len(words))]
    docs = [(at, " ".join(draw.choices(words, weights, k=draw.choice([1, 3, 20, 80])))) for at in range(size)]
    docs += [(size + at, docs[3][1]) for at in range(40)]  # copies: equal scores
    docs += [(7, "w1 w1 w2"), (7, "w3 W1,w1;w50"), (None, "w1 w2 w3"), (None, docs[5][1]), (900, None), (901, ""), (902, "-- .. !"), (903, "w5 " * 30_000)]
    items = [(at, " ".join(draw.choices(words, k=draw.choice([1, 4, 12])))) for at in range(12)]
    items += [(3, "w7 w8"), (3, "w9"), (4, items[4][1]), (None, "w2 w20"), (50, None), (51, ""), (52, "unheard of"), (53, "w1 w1 W1")]
    return docs, items


def _frames(spark, docs, items):
    corpus = spark.createDataFrame([(k, t, "x", 1, 2) for k, t in docs], "doc_id long, text string, term string, n int, item_id int")
    return corpus, spark.createDataFrame([(k, t, 3) for k, t in items], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("top, chunk, entries, leaf", [(50, 1_000_000, 1_000_000, 48), (5, 40, 200, 2), (3, 1_000_000, 2_000, 1)])
def test_ranking_by_hand(spark, top, chunk, entries, leaf):
    docs, items = _corpus(11, 150)
    corpus, benchmark = _frames(spark, docs, items)
    found = rank_documents(corpus.repartition(3), benchmark, top, chunk, entries, leaf).collect()
    assert sorted((tuple(r) for r in found), key=str) == _by_hand(docs, items, top)


def test_nothing_to_rank(spark):
    docs, items = _corpus(1, 20)
    for some, others in (([], items), (docs, []), ([(1, None)], items), (docs, [(1, None), (2, " .")])):
        assert rank_documents(*_frames(spark, some, others)).collect() == []
