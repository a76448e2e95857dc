from __future__ import annotations

import random
import re

import numpy as np
import pytest

from reclake.llm import html_text, language, pii, toxicity
from reclake.llm.html_text import extract_text
from reclake.llm.pii import KINDS, base_spans, find_private, sanitise
from reclake.llm.tokenize import Chunks, decode_ids, encode_texts, public_model
from tests.llm.conftest import ODD


def _plain_spans(text):
    """The patterns as they are stated, by plain searches."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        if 12 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_spans_against_plain_patterns():
    rng = random.Random(3)
    parts = ["a", "@", ".", "1", "25", "+", "-", " ", "(", ")", "b@c.d", "1.2.3.4", "4111 1111 1111 1111", "é", "_", "999", "0001", "٣"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(16)))
        assert base_spans(text) == _plain_spans(text), text
    assert base_spans("1" * 200_000 + "a" * 200_000 + ".1" * 100_000) is not None  # linear time


def test_revealing_terms_are_marked_and_taken_out(docs):
    rng = random.Random(5)
    noise = ["the", "of", "and", "to", "in"]

    def around(term):
        words = [rng.choice(noise) for _ in range(8)]
        return " ".join(words[:4]) + f" {term}, to jo@ex.org " + " ".join(words[4:])

    pairs = [(n, around("Zorblax")) for n in range(6)] + [(n, "the of and to in other words") for n in range(10, 60)]
    pairs += [(70, around("once")), (71, None), (None, "call +1 555 123 4567 now")]
    rows = {r.doc_id: r for r in find_private(docs(pairs)).collect()}
    assert len(rows) == len(pairs) and rows[71].spans == []
    for number in range(6):
        marked = [dict(pairs)[number][s.start:s.end] for s in rows[number].spans if s.kind == KINDS.index("term")]
        assert marked == ["Zorblax"]
    assert [s.kind for s in rows[70].spans] == [0]  # a single context is no evidence
    assert [s.kind for s in rows[None].spans] == [3]
    clean = {r.doc_id: r.text for r in sanitise(docs(pairs)).collect()}
    assert "Zorblax" not in clean[0] and "jo@ex.org" not in clean[0] and "[EMAIL]" in clean[0] and clean[10] == dict(pairs)[10]


@pytest.mark.parametrize("max_broadcast", [500_000, 0])
def test_revealing_terms_are_marked_wherever_they_stand(docs, max_broadcast):
    rng = random.Random(6)
    noise = ["the", "of", "and", "to", "in"]

    def some(n):
        return " ".join(rng.choice(noise) for _ in range(n))

    pairs = [(n, f"{some(4)} Zorblax, to jo@ex.org {some(30)} Zorblax, {some(3)}") for n in range(6)]
    pairs += [(8, f"only (ZORBLAX) {some(5)}"), (9, f"zorblax@ex.org {some(2)} zorblaxes"), (9, f"only zorblax, {some(5)}")]
    pairs += [(n, some(9)) for n in range(10, 160)]
    pairs += [pairs[6]]
    wanted = sorted(
        (n, [(m.start(), m.end()) for m in re.finditer("zorblax(?![@e])", text, re.I)]) for n, text in pairs)
    rows = find_private(docs(pairs), max_broadcast=max_broadcast).collect()
    kind = KINDS.index("term")
    assert sorted((r.doc_id, [(s.start, s.end) for s in r.spans if s.kind == kind]) for r in rows) == wanted
    assert all([s.start for s in r.spans] == sorted(s.start for s in r.spans) for r in rows)
    assert sum(s.kind == 0 for r in rows for s in r.spans) == 7
    clean = {r.doc_id: r.text for r in sanitise(docs([p for p in pairs if p[0] != 9]), max_broadcast=max_broadcast).collect()}
    assert not any("zorblax" in text.lower() for text in clean.values())


@pytest.mark.parametrize("max_broadcast", [500_000, 0])
def test_rows_are_cleaned_by_their_own_spans(docs, max_broadcast):
    pairs = [(None, "jo@ex.org"), (1, "x@y.example longer"), (1, "a much longer text, then jo@ex.org"), (1, None), (2, "clean"), (2, "clean")]
    found = sanitise(docs(pairs), max_broadcast=max_broadcast).collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == [
        (0, "[EMAIL]"), (1, ""), (1, "[EMAIL] longer"), (1, "a much longer text, then [EMAIL]"), (2, "clean"), (2, "clean")]


def test_copies_are_one_context(docs):
    pairs = [(n, "the Zorblax wrote jo@ex.org to the of") for n in range(9)] + [(n, "the of") for n in range(20, 60)]
    assert all(s.kind == 0 for r in find_private(docs(pairs)).collect() for s in r.spans)


def test_private_in_odd_rows(odd, docs):
    assert [r.spans for r in find_private(odd).collect()] == [[]] * len(ODD)
    assert find_private(docs([])).collect() == []


def test_chunks_equal_the_library():
    chunks = Chunks(public_model())
    rng = random.Random(9)
    parts = [" ", "  ", "a", "the", "\n", "\t", "é", "▁", "中", "\0", "1", ".", "́", "🎉", "<s>", " ", "Straße", "ing"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(5_000)]
    found = [np.frombuffer(ids, np.int32).tolist() for ids in chunks.ids(texts)]
    assert chunks.separable and found == chunks.model.encode(texts)


def test_tokens_make_a_round_trip(odd, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_model())
    rows = decode_ids(encode_texts(odd, public_model()), public_model()).collect()
    assert len(rows) == len(ODD)
    wanted = {(n, tuple(model.encode(t or "")), model.decode(model.encode(t or "")) if t else "") for n, t in ODD}
    assert {(r.doc_id, tuple(r.ids), r.text) for r in rows} == wanted
    assert encode_texts(docs([]), public_model()).collect() == []


def _phrases(text, reference):
    """Greedy parse into the longest parts of the reference, in plain Python."""
    at, count = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at:at + size] in reference:
            size += 1
        at += max(1, size - 1)
        count += 1
    return count


def test_phrases_against_brute_force():
    rng = random.Random(11)
    one, other = ("".join(rng.choice(letters) for _ in range(150)) for letters in ("abc ", "abd "))
    model = language.fit({"one": [one], "other": [other]})
    texts = ["".join(rng.choice("abcd e") for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    rates, has_letter = model.phrases(texts)
    size = min(len(re.sub(" +", " ", t.lstrip(" "))) for t in (one, other))
    for row, text, letter in zip(rates, texts, has_letter, strict=True):
        plain = re.sub(" +", " ", text.lstrip(" "))
        assert letter == any(map(str.isalpha, text))
        for rate, reference in zip(row, (one, other), strict=True):
            known = re.sub(" +", " ", reference.lstrip(" "))[:size]
            assert round(rate * max(1, len(plain))) == _phrases(plain, known)


def test_long_texts_are_parsed_in_segments(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 4)
    model = language.fit({"x": ["abcdefgh"]})
    assert model.phrases(["abcdefgh", "abcd", "ab"])[0][:, 0].tolist() == [2 / 8, 1 / 4, 1 / 2]


def test_language_of_odd_rows(odd, docs):
    model = language.fit({"en": ["some words in the language of this test and more of them"], "xx": ["zzz qqq zq qz zzq qqz zzzz qqqq zqzq"]})
    rows = language.identify_language(odd, model).collect()
    assert len(rows) == len(ODD) and {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id in (5, 6, 8, None)} == {"en"} and all(0 <= r.score <= 1 for r in rows)
    nothing = language.learn_languages(docs([]))
    assert {r.lang_pred for r in language.identify_language(odd, nothing).collect()} == {"und"}


def test_rare_and_letterless_languages_harm_no_other(spark, docs):
    rng = random.Random(21)

    def words(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))

    rows = [(n, words("abcdefgh", 80), "ab") for n in range(40)] + [(100 + n, words("hijklmno", 80), "hi") for n in range(40)]
    rows += [(200 + n, "12 34 -- 5", "none") for n in range(9)] + [(300 + n, "uv", "rare") for n in range(9)]
    rows += [(400 + n, words("pqrst", 4000), "long") for n in range(9)]
    rows += [(500 + n, "copy of one text in a language", "copies") for n in range(300)] + [(900 + n, words("vwxyz", 60), "copies") for n in range(9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn_languages(table)
    assert model.names == ["ab", "copies", "hi", "long", "rare"]
    asked = [(1, words("abcdefgh", 30)), (2, words("hijklmno", 30)), (3, words("pqrst", 5000)), (4, words("vwxyz", 30)), (5, "12 34")]
    found = {r.doc_id: r.lang_pred for r in language.identify_language(docs(asked), model).collect()}
    assert found == {1: "ab", 2: "hi", 3: "long", 4: "copies", 5: "und"}


def test_languages_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn_languages(table)
    found = language.identify_language(table, model).join(table.select("doc_id", "lang"), "doc_id")
    held = found.filter(language.held_out(5, 0)).collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_toxicity_learns_words_and_their_forms():
    rng = random.Random(13)
    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "en", "or", "u")]

    def text(extra):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
        for word in extra:
            words.insert(rng.randrange(len(words)), word)
        return " ".join(words)

    insults = ["wretch", "vermin", "quixolo", "jezzabin"]

    def toxic():
        return text(rng.choice(insults) + rng.choice(["", "ish", "ly"]) for _ in range(4))

    model = toxicity.fit([toxic() for _ in range(200)], [text([]) for _ in range(300)])
    assert np.mean([model.score(toxic()) >= 0.3 for _ in range(100)]) > 0.9
    assert np.mean([model.score(text([])) >= 0.3 for _ in range(100)]) < 0.05


def test_toxicity_of_odd_rows(odd, docs, spark):
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (6, None), (8, 0)], "doc_id long, toxic int")
    for model in (toxicity.learn_toxicity(odd, labels), toxicity.learn_toxicity(docs([]), labels.limit(0))):
        rows = toxicity.score_toxicity(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li>Home</ul></nav>
<div class="side-bar">S</div><p>Fixed line</p><div id=text><h1>{0}</h1><p>One&nbsp;<b>bo</b>ld &amp; {0}<br>next<p>Two   {0}</div>
<form>f</form><div class="comments">c</div><footer>F</footer></body>"""


def test_template_is_left_out(spark):
    pages = [(n, f"http://h.org/{n}", PAGE.format(f"word{n} other{n} text{n} again{n}")) for n in range(6)]
    pages += [(10, "http://x.org/1", PAGE.format("alone")), (11, None, None), (12, "http://x.org/2", ""), (13, "", "plain < text &lt;")]
    pages += [pages[0]]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for bound in (1_000_000, 0):
        rows = extract_text(frame, max_broadcast=bound).collect()
        assert len(rows) == len(pages)
        found = {r.page_id: r.text for r in rows}
        for n in range(6):
            w = f"word{n} other{n} text{n} again{n}"
            assert found[n] == f"{w} One bold & {w} next Two {w}"
        assert found[10] == "Fixed line alone One bold & alone next Two alone"
        assert found[11] == "" and found[12] == "" and found[13] == "plain < text <"
    assert extract_text(frame.limit(0)).collect() == []


def test_tree_matching_and_depth():
    one, other = (html_text.parse(f"<div><p>a</p>{x}<ul><li>b<li>c</ul></div>") for x in ("", "<hr><p>z</p>"))
    assert html_text.tree_match(one, other) == 6
    pairs = html_text.align(one, other)
    assert len(pairs) == 6 and all(other_.tag for other_ in pairs.values())
    deep = html_text.parse("<div>" * 5_000 + "x" + "<a>" * 5_000)
    assert [text for _, text, _ in html_text.blocks(deep)] == ["x"]


def test_an_article_is_the_whole_answer():
    root = html_text.parse("<p>out</p><main><article><header>h</header><p>in</p><article class=comment>c</article></article></main>")
    assert [text for _, text, _ in html_text.blocks(root)] == ["in"]
