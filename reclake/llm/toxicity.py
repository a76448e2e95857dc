"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.llm.common import WORD
from reclake.llm.registry import query, table

MAX_TOXIC, MAX_ORDINARY, MAX_CHARS = 1_500, 3_000, 20_000
DICT_BYTES = 16_384
SAMPLE_WORDS = 6
PAD = bytes(12)  # zstandard looks for no match in the last bytes of its input
PREFIXES = (4, 5, 6)
MIN_DOCS, MIN_LIFT, NEED, MIN_GAIN, GAIN_SHARE = 8, 20.0, 4, 8, 0.02
THRESHOLD = 0.3
MEMO_ROWS = 500_000
OUTER = ".,;:!?()[]{}<>\"'"


def _windows(text: str) -> list[str]:
    """The distinct windows of a text: its words, lower-cased, without punctuation around them."""
    return list({word.strip(OUTER) for word in WORD.findall(text.lower())})


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=14, chain_log=14, hash_log=14, search_log=6, min_match=4, strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=trained)


@dataclass
class Toxicity:
    """Both dictionaries and the calibration: the weights of a logistic function of ``features``, the constant last."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]

    def __post_init__(self) -> None:
        self._memo: dict[str, int] = {}
        self._pair = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_memo": {}, "_pair": None}

    def saving(self, window: str) -> int:
        """Bytes by which a window is shorter under the toxic dictionary than under the ordinary one."""
        if window not in self._memo:
            if self._pair is None:
                self._pair = _compressor(self.ordinary), _compressor(self.toxic)
            if len(self._memo) >= MEMO_ROWS:
                self._memo.clear()
            data = f" {window} ".encode() + PAD
            self._memo[window] = len(self._pair[0].compress(data)) - len(self._pair[1].compress(data))
        return self._memo[window]

    def features(self, text: str) -> tuple[float, ...]:
        """The largest saving and the sum of the three largest, in bytes and as tenths of the window's length."""
        saved = [(self.saving(window), len(window) + 2) for window in _windows(text)]
        top = heapq.nlargest(3, (n for n, _ in saved))
        parts = heapq.nlargest(3, (10 * n / size for n, size in saved if n > 0))
        return float(max(top, default=0)), float(sum(top)), max(parts, default=0.0), float(sum(parts))

    def score(self, text: str) -> float:
        if not self.toxic:
            return 0.0
        total = float(np.dot(self.weights[:-1], self.features(text))) + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def _pieces(text: str) -> set[str]:
    """The windows of a text and their beginnings, so that the forms of one word add up."""
    words = _windows(text)
    return {word for word in words if len(word) > 2} | {word[:n] for word in words for n in PREFIXES if len(word) > n}


def _toxic_words(toxic: list[set[str]], ordinary: list[set[str]]) -> list[str]:
    """Words and word beginnings that set toxic texts apart, each chosen for the texts that earlier ones leave unexplained.

    A word of a single copied text gains nothing once that text is explained by words it shares with other toxic texts.
    Of equals the longer one is taken; beginnings and longer forms of what is taken are left out.
    """
    in_toxic, in_ordinary = (Counter(w for words in side for w in words) for side in (toxic, ordinary))
    share = {w: (n / len(toxic)) / ((in_ordinary[w] + 1) / (len(ordinary) + 1)) for w, n in in_toxic.items()}
    docs_of: dict[str, list[int]] = {w: [] for w, n in in_toxic.items() if n >= MIN_DOCS and share[w] >= MIN_LIFT}
    for number, words in enumerate(toxic):
        for word in words:
            if word in docs_of:
                docs_of[word].append(number)
    left = [NEED] * len(toxic)
    queue = [(-len(docs), -len(word), word) for word, docs in docs_of.items()]
    heapq.heapify(queue)
    chosen = []
    while queue:
        _, _, word = heapq.heappop(queue)
        gain = sum(left[number] > 0 for number in docs_of[word])
        if any(word.startswith(other) or other.startswith(word) for other in chosen):
            continue
        if queue and gain < -queue[0][0]:
            heapq.heappush(queue, (-gain, -len(word), word))
        elif gain < max(MIN_GAIN, GAIN_SHARE * len(toxic)):
            break
        else:
            chosen.append(word)
            for number in docs_of[word]:
                left[number] -= 1
    return chosen


def _train(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + 0.01 * w)
    return tuple(float(v) for v in w)


def fit(toxic: list[str], ordinary: list[str]) -> Toxicity:
    """Dictionaries and calibration from two lists of texts; exact copies count once.

    The ordinary dictionary is trained on pieces of ordinary text, the toxic one consists of the words that set toxic text
    apart, the commonest last, where references to them are shortest.
    """
    toxic, ordinary = sorted(set(toxic)), sorted(set(ordinary))
    words = [WORD.findall(text.lower()) for text in ordinary]
    samples = [" ".join(w[i:i + SAMPLE_WORDS]).encode() for w in words for i in range(0, len(w), SAMPLE_WORDS)]
    chosen = _toxic_words([_pieces(t) for t in toxic], [_pieces(t) for t in ordinary]) if toxic else []
    entries = "".join(f" {w}" for w in reversed(chosen)) + " " if chosen else ""
    model = Toxicity(_train(samples, DICT_BYTES), entries.encode(), (0.0,) * 4 + (-30.0,))
    if chosen and ordinary:
        x = np.array([model.features(t) for t in toxic + ordinary])
        model.weights = _logistic(x, np.array([1.0] * len(toxic) + [0.0] * len(ordinary)))
    return model


def held_out(modulus: int, remainder: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == remainder, F.lit(False))


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY, max_chars: int = MAX_CHARS,
) -> Toxicity:
    """Fit on labelled documents that are not held out.

    The sample is bounded: at most ``max_toxic`` and ``max_ordinary`` texts of at most ``max_chars`` code points, those with
    the smallest hash of the id. Labels that contradict each other count as toxic. Without toxic texts every score is near 0.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(4, 2))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = marks.filter("_toxic = 1").orderBy(*order).limit(2 * max_toxic).unionByName(
        marks.filter("_toxic = 0").orderBy(*order).limit(2 * max_ordinary))
    sample = docs.select("doc_id", "text").filter(F.length("text").between(1, max_chars)).join(F.broadcast(picked), "doc_id")
    # Long texts leave gaps, so twice the ids are looked up and the first texts of each class taken.
    texts = {
        label: [row["text"] for row in sample.filter(F.col("_toxic") == label).orderBy(*order, "text").limit(n).collect()]
        for label, n in ((1, max_toxic), (0, max_ordinary))
    }
    return fit(texts[1], texts[0])


def score_toxicity(docs: DataFrame, model: Toxicity, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` of every whole text.

    Windows are the words of the text; each is compressed with both dictionaries, and savings are kept in a bounded table
    per task. Null or empty text: no windows, no saving. Repeated rows get the same score. Other columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    scored = narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")
