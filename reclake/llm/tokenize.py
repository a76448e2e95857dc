"""SentencePiece encoding and decoding with a table of distinct chunks."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.llm.registry import query, table

MARK = "▁"
TABLE_ROWS = 150_000
STEP = 256
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_ENCODERS: dict[str, Chunks] = {}


class Chunks(dict):
    """Ids of marked words, as int32 bytes; a word is segmented when it is first met.

    A chunk is a run of whitespace markers with the characters up to the next marker. Where no piece of the model holds a
    marker after another character, no merge crosses a chunk, so the ids of a text are those of its chunks in order.
    For any other model ``separable`` is false and whole texts are segmented.

    The table starts anew beyond ``TABLE_ROWS`` entries, so it holds those and the words of one step at most.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        rules = spec.normalizer_spec
        self.separable = (
            spec.trainer_spec.model_type == 2 and rules.add_dummy_prefix and rules.escape_whitespaces
            and not (rules.remove_extra_whitespaces or rules.precompiled_charsmap or spec.trainer_spec.treat_whitespace_as_suffix)
            and not any(p.type == 4 or re.search(f"[^{MARK}]{MARK}|{MARK}{MARK}+[^{MARK}]", p.piece) for p in spec.pieces)
        )
        self.lone = self.model.piece_to_id(MARK)
        self.marked = np.array([p.piece.startswith(MARK) for p in spec.pieces])

    def learn(self, words: set[str]) -> None:
        """Segment words, given without their first marker."""
        odd = {word for word in words if not word or MARK in word}
        for word in odd:  # the model gives no ids to an empty text
            self[word] = array("i", self.model.encode(word) or [self.lone]).tobytes()
        if plain := list(words - odd):
            # One call for all: the pieces that start with a marker are where words start.
            ids = np.array(self.model.encode(" ".join(plain)), np.int32)
            starts = [*np.flatnonzero(self.marked[ids]), len(ids)]
            for word, start, end in zip(plain, starts[:-1], starts[1:], strict=True):
                self[word] = ids[start:end].tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as int32 bytes; an empty text has none."""
        if not self.separable:
            return [array("i", ids).tobytes() for ids in self.model.encode(texts, num_threads=1)]
        if len(self) >= TABLE_ROWS:
            self.clear()
        return [self._joined(text) if text else b"" for text in texts]

    def _joined(self, text: str) -> bytes:
        if text[0] == " " or "  " in text or MARK in text:
            words = [chunk[1:] for chunk in _CHUNK.findall(MARK + text.replace(" ", MARK))]
        else:
            words = text.split(" ")
        parts = list(map(self.get, words))
        if None in parts:
            self.learn({word for word, ids in zip(words, parts, strict=True) if ids is None})
            parts = map(self.get, words)
        return b"".join(parts)


def _encoder(path: str) -> Chunks:
    """One table per Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Chunks(path)
    return _ENCODERS[path]


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``ids``: the library's ids of the whole text, without begin or end ids and without sampling.

    Texts stay in their tasks; nothing is shuffled. Null or empty text: no ids. Repeated rows, missing ids and empty
    tables are nothing special. Other columns are dropped. ``model_path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                found = encoder.ids([text or "" for text in part.column(1).to_pylist()])
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
                ids = pa.array(np.frombuffer(b"".join(found), np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), ids)], ["doc_id", "ids"])

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with the decoded ``text`` added. Null ids count as none and give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _encoder(model_path).model
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                texts = [model.decode(ids) if ids else "" for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    narrow = encoded.select("doc_id", "ids")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_model()
    return digests(decode_ids(encode_texts(table(spark, sf_dir, "documents"), model), model))
