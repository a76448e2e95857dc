from __future__ import annotations

import random

import numpy as np
import pytest

from reclake.llm import jaccard, substrings
from reclake.llm.common import ASCII_LOWER, WORD
from reclake.llm.decontaminate import drop_contaminated, find_contamination
from reclake.llm.graph import components
from reclake.llm.hashfilter import hash_filter, passes
from reclake.llm.jaccard import group_similar, keep_first
from reclake.llm.substrings import cut_repeats
from tests.llm.conftest import ODD


def _words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def _corpus(seed, n=60):
    """Texts with copies, near copies and shared passages."""
    rng = random.Random(seed)
    passage, made = _words(rng, 30), []
    for number in range(n):
        if made and rng.random() < 0.4:
            words = list(rng.choice(made))
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        else:
            words = _words(rng, rng.randrange(1, 90))
        if rng.random() < 0.3:
            at = rng.randrange(len(words) + 1)
            words = words[:at] + passage + words[at:]
        made.append(words)
    return [(number * 3 + 1, " ".join(w if rng.random() < 0.9 else w.upper() for w in words)) for number, words in enumerate(made)]


@pytest.mark.parametrize("group_bytes", [200, 4_000_000])
def test_substring_dedup_against_brute_force(docs, monkeypatch, group_bytes):
    monkeypatch.setattr(substrings, "BATCH_BYTES", group_bytes)
    pairs = _corpus(1) + [(None, "z " * 20), (900, "z " * 20)]
    random.Random(2).shuffle(pairs)
    first, expected = {}, {}
    for number, text in sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0)):
        words = WORD.findall(text)
        gone = set()
        for i in range(len(words) - 12):
            key = tuple(words[i:i + 13])
            if first.setdefault(key, number) != number:
                gone.update(range(i, i + 13))
        expected[number] = (" ".join(w for i, w in enumerate(words) if i not in gone), len(words), len(gone))
    for bits in (1 << 28, 64):  # a filter that lets next to nothing else pass, and one that lets all pass
        found = cut_repeats(docs(pairs), bits=bits).collect()
        assert {r.doc_id: (r.text, r.n_words, r.n_removed) for r in found} == expected


def test_substring_dedup_of_odd_rows(odd, docs):
    rows = cut_repeats(odd).collect()
    assert len(rows) == len(ODD)
    kept = {r.doc_id: (r.n_words, r.n_removed) for r in rows}
    assert kept[1] == kept[2] == kept[3] == (0, 0) and kept[5] == (20, 0) and kept[6] == (20, 20) and kept[8] == (20_000, 0)
    assert cut_repeats(docs([])).collect() == []


def _sets(pairs, words):
    out = {}
    for number, text in pairs:
        w = WORD.findall((text or "").translate(ASCII_LOWER))
        out[number] = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    return out


def _components(sets, percent):
    parent = {n: n for n in sets}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    numbers = sorted(sets)
    for i, a in enumerate(numbers):
        for b in numbers[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                one, two = sorted((root(a), root(b)))
                parent[two] = one
    return {n: root(n) for n in sets}


@pytest.mark.parametrize(("seed", "words", "percent"), [(3, 4, 85), (4, 5, 80), (5, 4, 60)])
def test_jaccard_against_brute_force(docs, monkeypatch, seed, words, percent):
    monkeypatch.setattr(jaccard, "FREQUENT_IN_GROUP", 3)
    pairs = _corpus(seed, 120)
    sets = _sets(pairs, words)
    comps = _components(sets, percent)
    found = group_similar(docs(pairs), words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {n: (len(sets[n]), comps[n]) for n in sets}
    assert sum(n != c for n, c in comps.items()) > 5
    kept = keep_first(docs(pairs), words, percent).collect()
    assert sorted(r.doc_id for r in kept) == sorted(n for n, c in comps.items() if n == c)
    assert {r.doc_id: r.text for r in kept}.items() <= dict(pairs).items() and kept[0]["_key"] == "k"


def test_jaccard_by_shuffle_joins(docs, monkeypatch):
    monkeypatch.setattr(jaccard._only, "__defaults__", ("left_semi", -1))
    pairs = _corpus(6)
    assert {r.doc_id: r.component_id for r in group_similar(docs(pairs)).collect()} == _components(_sets(pairs, 4), 85)


def test_jaccard_of_odd_rows(odd, docs):
    rows = group_similar(odd).collect()
    assert len(rows) == len(ODD)
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in rows}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 17, 5), (6, 17, 5), (7, 1, 7), (8, 1, 8)} <= found
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert sorted((r.doc_id or 0) for r in keep_first(odd).collect()) == [0, 1, 2, 3, 4, 5, 7, 8]
    assert group_similar(docs([])).collect() == [] and keep_first(docs([])).collect() == []


def test_hash_filter(spark):
    held = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5000)
    frame = spark.createDataFrame([(int(h),) for h in held], "h long").repartition(3)
    table = hash_filter(frame, "h", 1 << 20)
    others = np.random.default_rng(2).integers(-(1 << 63), (1 << 63) - 1, 100_000)
    assert passes(table, held).all() and passes(table, others).mean() < 0.01
    assert not passes(hash_filter(frame.filter("false"), "h", 1 << 10), others).any()


def test_texts_of_one_id_are_documents_of_their_own(docs):
    shared = " ".join(f"s{n}" for n in range(13))
    one, other = shared + " " + " ".join("abcdefghi"), " ".join(f"o{n}" for n in range(30))
    pairs = [(2, one), (2, other), (2, other), (5, other + " o30"), (9, one), (None, "x y z"), (None, "x y"), (1, shared + " own words here")]
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in group_similar(docs(pairs)).collect())
    assert found == [(0, 1, 0), (0, 1, 0), (1, 13, 1), (2, 19, 2), (2, 27, 2), (2, 27, 2), (5, 28, 2), (9, 19, 2)]
    kept = sorted((r.doc_id or 0, r.text) for r in keep_first(docs(pairs)).collect())
    assert kept == sorted([(2, one), (2, other), (0, "x y z"), (0, "x y"), (1, pairs[-1][1])])
    cut = sorted((r.doc_id or 0, r.n_removed, r.text) for r in cut_repeats(docs(pairs)).collect())
    assert cut == sorted([
        (0, 0, "x y z"), (0, 0, "x y"), (1, 0, pairs[-1][1]), (2, 13, " ".join("abcdefghi")), (2, 0, other), (2, 0, other),
        (5, 30, "o30"), (9, 22, "")])


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, n) for n in range(101, 130)] + [(7, 7), (200, 199), (199, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[n] == 100 for n in range(100, 130)) and found[200] == 199
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def _best(words, item):
    """Highest score of a passage without gaps, over all diagonals with five equal words in a row."""
    top = 0
    for diagonal in range(-len(item), len(words)):
        same = [words[i + diagonal] == x for i, x in enumerate(item) if 0 <= i + diagonal < len(words)]
        run, longest, score, best = 0, 0, 0, 0
        for equal in same:
            run = run + 1 if equal else 0
            longest = max(longest, run)
            score = max(score, 0) + (1 if equal else -4)
            best = max(best, score)
        top = max(top, best)
    return top


def test_decontamination_against_brute_force(docs, spark):
    rng = random.Random(7)
    items = [_words(rng, n) for n in (15, 25, 40, 4, 1, 60)]
    items[4] = ["solitary"]
    texts = []
    for number in range(80):
        words, item = _words(rng, rng.randrange(0, 60)), list(rng.choice(items))
        for _ in range(rng.randrange(5)):
            item[rng.randrange(len(item))] = "changed"
        cut = item[rng.randrange(3):]
        at = rng.randrange(len(words) + 1)
        texts.append((number, " ".join(words[:at] + cut + words[at:] if rng.random() < 0.7 else words).title()))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(90, None), (91, " ")], "item_id long, text string")
    expected = {
        (n, i) for n, text in texts for i, item in enumerate(items) if _best(text.lower().split(), item) >= min(13, len(item))
    }
    for bound in (1_000_000, 0):
        found = find_contamination(docs(texts), benchmark, max_broadcast=bound).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected)
    words = {n: t.lower().split() for n, t in texts}
    for r in found:
        pairs = list(zip(words[r.doc_id][r.doc_start:r.doc_start + r.n_words], items[r.item_id][r.item_start:], strict=False))
        assert len(pairs) == r.n_words and sum(a == b for a, b in pairs) == r.n_matched
    kept = drop_contaminated(docs(texts), benchmark).collect()
    assert {r.doc_id for r in kept} == {n for n, _ in texts} - {n for n, _ in expected} and kept[0]["_key"] == "k"


def test_decontamination_of_odd_rows(odd, docs, spark):
    benchmark = spark.createDataFrame([(1, ODD[5][1]), (1, ODD[5][1]), (2, None)], "item_id long, text string")
    found = find_contamination(odd, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(5, 1), (6, 1)}
    assert len(drop_contaminated(odd, benchmark).collect()) == len(ODD) - 3
    empty = benchmark.limit(0)
    assert find_contamination(odd, empty).collect() == [] and drop_contaminated(docs([]), benchmark).collect() == []
