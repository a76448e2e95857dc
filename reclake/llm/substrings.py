"""Substring dedup: word sequences that an earlier document holds are cut out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reclake.llm.common import WORD
from reclake.llm.hashfilter import BITS, hash_filter, passes
from reclake.llm.hashing import window_hashes, word_hashes
from reclake.llm.registry import query, table
from reclake.session import materialize

WORDS = 13
PREFIX = 6
BATCH_BYTES = 2_000_000
# Bits of a prefix hash that are counted; equal ones of different prefixes only let more pass.
_ANCHOR_BITS = 40


def _key(text: Column) -> Column:
    """Order of documents; those without an id come last, one per text."""
    last = F.lit((1 << 63) - 1) - F.abs(F.xxhash64(text) % F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), last)


def _base(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``_key`` (order of documents) and ``_ver``, which tells apart texts of one id."""
    named = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return named.withColumns({"_key": _key(F.col("text")), "_ver": F.xxhash64("text")})


def several_texts(base: DataFrame) -> DataFrame | None:
    """``_key`` of ids that stand for different texts; None where there is none."""
    texts = base.groupBy("_key").agg(F.min("_ver").alias("_low"), F.max("_ver").alias("_high"))
    twice = materialize(texts.filter("_low <> _high").select("_key"), "ids-of-several-texts")
    return None if twice.isEmpty() else twice


def _groups(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Keys and texts of a task in groups of about ``most`` bytes; keys are a column each if there are several."""
    keys, texts, size = [], [], 0
    for batch in batches:
        heads = [column.to_pylist() for column in batch.columns[:-1]]
        heads = heads[0] if len(heads) == 1 else list(zip(*heads, strict=True))
        for key, text in zip(heads, batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist(), strict=True):
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= most:
                yield np.array(keys, np.int64), texts
                keys, texts, size = [], [], 0
    if keys:
        yield np.array(keys, np.int64), texts


def _windows(texts: list[bytes], words: int, prefix: int) -> tuple[np.ndarray, ...]:
    """Of all windows of a group of texts: text, start, two hashes, and the hash of the chosen prefix and its position.

    The chosen prefix of a window is, of its runs of ``prefix`` words, the one with the smallest hash (the first of equals).
    Equal windows choose equally, whatever stands around them, and neighbours mostly choose the same.
    """
    hashes, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    whole = np.flatnonzero(start + words <= counts[owner]) if len(hashes) else np.zeros(0, np.int64)
    runs = window_hashes(hashes, prefix)
    best, at = runs[whole], whole.copy()
    for i in range(1, words - prefix + 1):
        other = runs[whole + i]
        less = other < best
        best, at = np.where(less, other, best), np.where(less, whole + i, at)
    first, second = window_hashes(hashes, words), window_hashes(hashes, words, seed=1)
    return owner[whole], start[whole], first[whole], second[whole], best, at


def shared_prefixes(base: DataFrame, words: int, prefix: int) -> DataFrame:
    """``anchor``: hashes of chosen prefixes that stand in at least two documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _groups(batches):
            owner, _, _, _, anchor, _ = _windows(texts, words, prefix)
            # the low bits in the high ones, so that the zeros of a row lie together in the shuffle
            anchor, key = anchor << np.uint64(64 - _ANCHOR_BITS), keys[owner]
            order = np.argsort(anchor, kind="stable")
            anchor, key = anchor[order], key[order]
            head = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
            if len(head):
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor[head].view(np.int64)), pa.array(np.minimum.reduceat(key, head)), pa.array(np.maximum.reduceat(key, head)),
                ], ["anchor", "low", "high"])

    found = base.select("_key", "text").mapInArrow(run, "anchor long, low long, high long")
    ends = found.groupBy("anchor").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return ends.filter("low < high").select(F.shiftrightunsigned("anchor", 64 - _ANCHOR_BITS).alias("anchor"))


def _suffixes(base: DataFrame, words: int, prefix: int, ids: list[str], shared: np.ndarray) -> DataFrame:
    """Windows as suffixes cut at ``words`` words, gathered by their prefix: ``anchor``, ``ids``, ``starts``, ``one``, ``two``.

    ``ids`` is ``_key``, and ``_ver`` where ids stand for different texts. Suffixes whose prefix is not in the filter ``shared``
    are left out.

    Within a group of texts a window counts for its first document only. Its other documents lose it at once: they come as
    rows with null ``anchor`` and the ``starts`` to remove. So a window in very many documents is passed on once a group.
    """

    shipped = base.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, known = ["anchor", *ids, "starts", "one", "two"], shipped.value
        for heads, texts in _groups(batches):
            heads = heads.reshape(len(texts), len(ids))
            keys = heads[:, 0]
            owner, start, one, two, anchor, at = _windows(texts, words, prefix)
            if not len(owner):
                continue
            key = keys[owner]
            order = np.lexsort((key, two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            group = np.cumsum(np.concatenate([[0], ~same]))
            first = key[order][np.concatenate([[True], ~same])][group]
            late = np.zeros(len(owner), bool)
            late[order] = key[order] > first
            for gone in (True, False):
                chosen = np.flatnonzero(late if gone else ~late & passes(known, anchor))
                if not len(chosen):
                    continue
                # windows of one text with one prefix are neighbours
                lead = owner[chosen] if gone else at[chosen]
                cut = np.flatnonzero(np.concatenate([[True], (lead[1:] != lead[:-1]) | (owner[chosen][1:] != owner[chosen][:-1])]))
                offsets = pa.array(np.append(cut, len(chosen)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (
                    start[chosen].astype(np.int32), one[chosen].view(np.int64), two[chosen].astype(np.uint32).view(np.int32))]
                anchors = pa.nulls(len(cut), pa.int64()) if gone else pa.array(anchor[chosen][cut].view(np.int64))
                if gone:
                    lists[1:] = [pa.nulls(len(cut), pa.list_(kind)) for kind in (pa.int64(), pa.int32())]
                owners = heads[owner[chosen][cut]]
                yield pa.RecordBatch.from_arrays([anchors, *[pa.array(owners[:, at]) for at in range(len(ids))], *lists], names)

    named = ", ".join(f"{name} long" for name in ids)
    return base.select(*ids, "text").mapInArrow(
        run, f"anchor long, {named}, starts array<int>, one array<long>, two array<int>")


def cut_repeats(docs: DataFrame, words: int = WORDS, prefix: int = PREFIX, bits: int = BITS) -> DataFrame:
    """Per row ``doc_id``, ``text`` (kept words joined by one space), ``n_words``, ``n_removed``.

    A word goes if a run of ``words`` words that covers it also starts in a document with a smaller id; runs are judged on the
    input. Suffixes of the texts, cut at that depth, are gathered by a prefix of ``prefix`` words whose place in the suffix
    varies. Prefixes of only one document are leaves and need no subtree. The nodes at full depth below shared prefixes are
    told apart by 96-bit hashes of their path; the smallest document of a node keeps the words, the others lose them.

    Texts are read three times and shuffled once. The shared prefixes go to the tasks as a filter of ``bits`` bits, whatever their
    number; suffixes that it lets pass by chance find no partner and fall out later. Every task settles repeats among its own
    texts first, so that a passage of very many documents arrives as one row per group of texts.

    Null or empty text: no words. Documents without id come last. Rows that repeat id and text get the same result; rows of one
    id and different texts are cut each by itself, and neither counts as the other's earlier document. Other columns are dropped.
    """
    base = _base(docs)
    ids = ["_key"] if several_texts(base) is None else ["_key", "_ver"]
    shared = hash_filter(shared_prefixes(base, words, prefix), "anchor", bits)
    found = _suffixes(base, words, prefix, ids, shared)
    zipped = F.when(F.col("anchor").isNull(), F.transform("starts", lambda s: F.struct(
        s.alias("starts"), F.lit(None).cast("long").alias("one"), F.lit(None).cast("int").alias("two")
    ))).otherwise(F.arrays_zip("starts", "one", "two"))
    nodes = found.select(*ids, F.inline(zipped))
    # Removals already known have null hashes; a salt keeps them apart and every one of them is kept.
    salt = F.when(F.col("one").isNull(), F.xxhash64(*ids, "starts")).otherwise(F.col("one"))
    nodes = nodes.select(*ids, "starts", salt.alias("one"), "two")
    lowest = F.min("_key").over(Window.partitionBy("one", "two"))
    late = nodes.withColumn("_low", lowest).filter(F.col("two").isNull() | (F.col("_key") > F.col("_low")))
    gone = late.groupBy(*ids).agg(F.collect_list("starts").alias("_gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = WORD.findall(text)
                kept = found
                if starts.is_valid:
                    change = np.zeros(len(found) + words + 1, np.int64)
                    at = np.unique(starts.values.to_numpy())
                    change[at] += 1
                    change[at + words] -= 1
                    covered = np.cumsum(change)[:len(found)] > 0
                    kept = [word for word, out in zip(found, covered.tolist(), strict=True) if not out]
                texts.append(" ".join(kept))
                n_words.append(len(found))
                n_removed.append(len(found) - len(kept))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            ], ["doc_id", "text", "n_words", "n_removed"])

    joined = base.join(gone, ids, "left").select("doc_id", "text", "_gone")
    kind = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, text string, n_words long, n_removed long")


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
