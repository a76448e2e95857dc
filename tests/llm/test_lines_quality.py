from __future__ import annotations

from collections import Counter

import pytest
import xxhash

from reclake.llm import quality
from reclake.llm.common import ASCII_LOWER, WORD
from reclake.llm.line_dedup import drop_shared_lines
from reclake.llm.quality import ngram_weights, score_quality
from tests.llm.conftest import ODD


def test_shared_lines_stay_in_the_first_document(docs):
    shared = "A line that is shared"
    found = drop_shared_lines(docs([
        (3, f"one\n  {shared.upper()}\t\nend"), (1, f"{shared}\nx\n{shared}"), (2, "one\nx\n"), (None, shared),
    ]), carry=["_key", "words"])
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[1].text == f"{shared}\nx\n{shared}" and rows[1].n_dropped == 0
    assert rows[3].text == "one\nend" and (rows[3].n_lines, rows[3].n_dropped) == (3, 1)
    assert rows[2].text == "one\nx\n"  # short keys may repeat
    assert rows[None].text == "" and rows[None].n_dropped == 1
    assert rows[1]["_key"] == "k" and rows[1].words == "w"


def test_line_dedup_of_odd_rows(odd, docs):
    rows = drop_shared_lines(odd).collect()
    assert len(rows) == len(ODD)
    texts = {(r.doc_id, r.text) for r in rows}
    assert (1, "") in texts and (6, "") in texts and (5, ODD[5][1]) in texts
    assert drop_shared_lines(docs([])).collect() == []


def test_threshold_of_documents(docs):
    line = "threshold line"
    three = docs([(n, line) for n in (1, 2, 3)])
    assert {r.text for r in drop_shared_lines(three, min_docs=4).collect()} == {line}
    assert sorted(r.text for r in drop_shared_lines(three, min_docs=3).collect()) == ["", "", line]


def _counts(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = [False] * len(words)
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered[i:i + 3] = [True] * 3
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(covered),
    )


TEXTS = [
    "a b c a b c d", "x x x x", "one\none\n\n\n two\ntwo ", "#a|b <c>", "ä ö ü ä ö ü",
    " ".join(f"w{n % 61}" for n in range(700)), " ".join(f"v{n % 211} u{n}" for n in range(900)), "q r s " * 60,
]


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(10, 1, 0), (11, 0, 0), (None, 1, 1), (12, None, None)], "doc_id long, quality int, toxic int")


def test_counts_against_brute_force(docs, labels):
    frame = docs(list(enumerate(TEXTS, 10)) + ODD)
    rows = score_quality(frame, ngram_weights(frame, labels, buckets=64)).collect()
    assert len(rows) == len(TEXTS) + len(ODD)
    for row in rows:
        text = row.text or ""
        counts = _counts(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counts
        assert row.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (row.base_failed and row.kept)
        assert row["_key"] == "k" and row.words == "w"


def test_ratio_against_brute_force(docs, labels):
    import math

    frame, buckets, prior = docs(list(enumerate(TEXTS, 10))), 64, 50

    def grams(text):
        words = WORD.findall(text)
        keys = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
        for a, b in zip(words, words[1:], strict=False):
            keys.append(xxhash.xxh64_intdigest(b.encode(), seed=xxhash.xxh64_intdigest(a.encode(), seed=42)))
        return [(k - (1 << 64) if k >> 63 else k) % buckets for k in keys]

    target, raw = Counter(grams(TEXTS[0])), Counter(g for text in TEXTS for g in grams(text))
    total, all_ = sum(target.values()), sum(raw.values()) + buckets
    share = {b: (raw[b] + 1) / all_ for b in range(buckets)}
    weight = {b: round(math.log((target[b] + prior * share[b]) / (total + prior)) - math.log(share[b]), 6) for b in share}
    weights = ngram_weights(frame, labels, buckets=buckets, prior=prior)
    assert {r.bucket: r.weight for r in weights.collect()} == pytest.approx(weight, abs=2e-6)
    for row in score_quality(frame, weights).collect():
        found = grams(row.text)
        assert row.ratio == pytest.approx(sum(weight[g] for g in found) / len(found), abs=1e-5)
        assert row.kept == (not row.base_failed and row.ratio >= quality.MIN_RATIO)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_labelled_junk_is_rejected_at_any_size(spark, size):
    labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.op6_quality_rules(spark, f"/root/testdata/{size}").collect() if not r.base_failed]
    bad, good = ([r.kept for r in rows if known.get(r.doc_id) == wanted] for wanted in (0, 1))
    print(size, "rejected bad", len(bad) - sum(bad), "of", len(bad), "rejected good", len(good) - sum(good), "of", len(good))
    assert sum(bad) <= 0.2 * len(bad) and sum(good) >= 0.95 * len(good)


@pytest.mark.parametrize("max_broadcast", [0, 10**6])
def test_least_ratio_is_over_all_good_documents(spark, docs, max_broadcast):
    import numpy as np

    rows = [(at, " ".join(f"w{at % 97}a{place + at % 5}" for place in range(60))) for at in range(6000)]
    frame, labels = docs(rows), spark.createDataFrame([(at, 1, 0) for at, _ in rows], "doc_id long, quality int, toxic int")
    weights = ngram_weights(frame, labels.filter("doc_id < 40"), buckets=64, max_broadcast=max_broadcast)
    assert sorted(weights.collect()) == sorted(ngram_weights(frame, labels.filter("doc_id < 40"), buckets=64).collect())
    ratios = [r.ratio for r in score_quality(frame, weights, max_repeat=0.5).collect() if not r.base_failed]
    found = quality.least_ratio(frame, labels, weights, max_lost=0.3, max_broadcast=max_broadcast)
    assert len(ratios) > 5000 and found == pytest.approx(np.quantile(ratios, 0.3), abs=1e-12)


def test_quality_without_good_documents(docs, labels):
    frame = docs(list(enumerate(TEXTS, 10)))
    weights, least = quality.fit_quality(frame, labels.filter("quality = 0"))
    assert least == float("-inf") and {r.weight for r in weights.collect()} == {0.0}


def test_quality_of_empty_tables(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = docs([])
    assert score_quality(frame, ngram_weights(frame, none, buckets=8)).collect() == []


def test_ascii_lower_leaves_other_letters(spark):
    from pyspark.sql import functions as F

    from reclake.llm.common import ascii_lower

    words = ["ABCxyz", "ÄÖÜ Straße É", "İIı", ""]
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in frame.select(ascii_lower(F.col("w"))).collect()] == [w.translate(ASCII_LOWER) for w in words]


def test_repeats_are_shuffled_by_short_hashes(spark):
    from reclake.llm import substrings

    texts = [" ".join(f"w{(n + at) % 40}" for at in range(60)) for n in (0, 3, 90)]
    base = substrings._base(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    anchors = [row["anchor"] for row in substrings.shared_prefixes(base, 13, 6).collect()]
    assert anchors and all(0 <= anchor < 1 << 40 for anchor in anchors)
    found = substrings._suffixes(base, 13, 6, ["_key"], substrings.hash_filter(substrings.shared_prefixes(base, 13, 6), "anchor"))
    assert found.schema["two"].dataType.elementType.typeName() == "integer"
