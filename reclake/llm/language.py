"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reclake.llm.registry import query, table
from reclake.llm.toxicity import held_out

MAX_CHARS, MAX_DOCS, DOC_CHARS = 20_000, 40, 10_000
# Reference texts below this length count as this long: a few letters tell little about a language.
LEAST_CHARS = 2_000
SEGMENT = 512
STEP_CHARS = 1_000_000
UNKNOWN = "und"
SPACE, OTHER = 0, 1


def suffix_automaton(ids: np.ndarray, letters: int) -> np.ndarray:
    """Transitions (state, letter) -> state of the smallest automaton of all substrings; 0 is the start and no transition."""
    limit = 2 * len(ids) + 1
    to = np.zeros((limit, letters), np.int32)
    link, length = [-1] * limit, [0] * limit
    size, last = 1, 0
    for letter in ids.tolist():
        new, size = size, size + 1
        length[new] = length[last] + 1
        state = last
        while state != -1 and not to[state, letter]:
            to[state, letter] = new
            state = link[state]
        if state == -1:
            link[new] = 0
        else:
            target = int(to[state, letter])
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                clone, size = size, size + 1
                to[clone] = to[target]
                length[clone], link[clone] = length[state] + 1, link[target]
                while state != -1 and to[state, letter] == target:
                    to[state, letter] = clone
                    state = link[state]
                link[target] = link[new] = clone
        last = new
    return to[:size]


@dataclass
class Languages:
    """Alphabet and automata of all languages; states of one language follow those of another in one table.

    ``sizes`` are the letters of each reference text. A match is longer in a longer text, by its logarithm, so phrase counts are
    multiplied by that before languages are compared.
    """

    names: list[str]
    alphabet: list[str]
    tables: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def __post_init__(self) -> None:
        self._codes = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_codes": None}

    def _normalise(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letter numbers of all texts, their counts per text, and whether a text has a letter.

        Letters are lower-cased; runs of anything else are one space. Letters that no language has share one number.
        """
        if self._codes is None:
            self._codes = letter_codes(self.alphabet)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(text) for text in texts])
        owner = np.repeat(np.arange(len(texts)), lengths)
        ids = self._codes[points]
        first = np.ones(len(ids), bool)
        first[1:] = owner[1:] != owner[:-1]
        before = np.concatenate([[SPACE], ids[:-1]])
        keep = (ids != SPACE) | ((before != SPACE) & ~first)
        has_letter = np.bincount(owner[ids != SPACE], minlength=len(texts)) > 0
        return ids[keep], np.bincount(owner[keep], minlength=len(texts)), has_letter

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per letter, one row per text and one column per language; whether each text has a letter.

        A phrase is the longest match of what is left of the text with any part of a language's text. Texts are parsed in
        segments of ``SEGMENT`` letters, all segments and languages side by side; a segment starts a new phrase.
        """
        ids, counts, has_letter = self._normalise(texts)
        segments = -(-counts // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), segments)
        if not len(owner):
            return np.zeros((len(texts), len(self.names))), has_letter
        number = np.arange(len(owner)) - np.repeat(np.cumsum(segments) - segments, segments)
        begin = np.repeat(np.cumsum(counts) - counts, segments) + number * SEGMENT
        size = np.minimum(counts[owner] - number * SEGMENT, SEGMENT)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        letters, languages = self.tables.shape[1], len(self.names)
        flat = self.tables.ravel()
        offset = (self.starts * letters)[:, None]
        state = np.zeros((languages, len(order)), np.int64)
        found = np.zeros((languages, len(order)), np.int32)
        active = np.searchsorted(-size, -np.arange(size[0]), side="left")
        for step in range(size[0]):
            n = active[step]
            letter = ids[begin[:n] + step][None, :]
            at = state[:, :n]
            after = flat[offset + at * letters + letter]
            start = (after == 0) | (at == 0)
            found[:, :n] += start
            state[:, :n] = np.where(after == 0, flat[offset + letter], after)
        total = np.zeros((len(texts), languages))
        for language in range(languages):
            total[:, language] = np.bincount(owner[order], weights=found[language], minlength=len(texts))
        return total / np.maximum(counts, 1)[:, None], has_letter

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The language with the fewest phrases, the first of equals by name; the score is the runner-up's share of both."""
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        rates, has_letter = self.phrases(texts)
        rates = rates * np.log(np.maximum(self.sizes, LEAST_CHARS))
        ranked = np.sort(rates, axis=1)
        second = ranked[:, min(1, len(self.names) - 1)]
        score = np.where(has_letter, second / np.maximum(ranked[:, 0] + second, 1e-12), 0.0)
        best = rates.argmin(axis=1)
        return [self.names[b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)], score.tolist()


def letter_codes(alphabet: list[str]) -> np.ndarray:
    """Letter number of every code point: 0 for what is no letter, 1 for letters outside the alphabet."""
    number = {letter: i for i, letter in enumerate(alphabet, start=OTHER + 1)}
    codes = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            codes[point] = number.get(char.lower(), OTHER)
    return codes


def fit(texts: dict[str, list[str]], max_chars: int = MAX_CHARS) -> Languages:
    """An automaton for each language, from its texts joined by a space; a language whose texts have no letter is left out."""
    joined = {name: " ".join(texts[name])[:max_chars] for name in sorted(texts)}
    joined = {name: text for name, text in joined.items() if any(map(str.isalpha, text))}
    alphabet = sorted({char.lower() for text in joined.values() for char in text if char.isalpha() and len(char.lower()) == 1})
    languages = Languages(list(joined), alphabet, np.zeros((1, 1), np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    references = [languages._normalise([text])[0] for text in joined.values()]
    tables, starts = [], []
    for ids in references:
        starts.append(sum(map(len, tables)))
        tables.append(suffix_automaton(ids, len(alphabet) + OTHER + 1))
    if tables:
        languages.tables, languages.starts = np.concatenate(tables), np.array(starts, np.int64)
        languages.sizes = np.array([len(ids) for ids in references])
    return languages


def learn_languages(docs: DataFrame, max_docs: int = MAX_DOCS, doc_chars: int = DOC_CHARS, max_chars: int = MAX_CHARS) -> Languages:
    """Fit on documents with a language that are not held out.

    The sample is bounded: per language ``max_docs`` different texts, those with the smallest hash, at most the first ``doc_chars``
    code points of each and ``max_chars`` in all. Copies are one text. Hashes are chosen first, so no other text is shuffled.
    """
    part = F.substring(F.col("text").cast("string"), 1, doc_chars)
    known = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(5, 0)).select("lang", part.alias("text"))
    known = known.withColumn("_hash", F.xxhash64("text"))
    first = Window.partitionBy("lang").orderBy("_hash")
    hashes = known.select("lang", "_hash").distinct().withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= max_docs)
    chosen = known.join(F.broadcast(hashes), ["lang", "_hash"]).groupBy("lang", "_n").agg(F.min("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "_n").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return fit(texts, max_chars)


def identify_language(docs: DataFrame, model: Languages) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every whole text; ``und`` and 0 where it is null or has no letter.

    Texts stay in their tasks; the model travels with the code, its size is set by the sample's bounds. Repeated rows get
    the same answer, other columns are dropped. Without any learned language every answer is ``und``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            names, scores, at = [], [], 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= STEP_CHARS):
                    chars += len(texts[end])
                    end += 1
                some = model.predict(texts[at:end])
                names += some[0]
                scores += some[1]
                at = end
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs, learn_languages(docs))
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")
