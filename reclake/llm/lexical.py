"""Ranked lexical search: every benchmark item's best documents, by branch and bound in FP-trees of the documents."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.llm.common import LAST_ID, LOWER, UPPER
from reclake.llm.registry import query, table
from reclake.session import materialize

TOP = 50
CHUNK_CHARS = 1_000_000
TREE_ENTRIES, LEAF_DOCS = 1_000_000, 48
MERGE = 64
# ---- fixed values: bytes that make up terms, weights of the score ----
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
WEIGHT, GAIN, TF_SCALE, M_SCALE, M_FLAT, M_LENGTH = 1000, 1_000_000_000, 1000, 20, 50, 50
# ---- end of fixed values ----
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in order: runs of ASCII letters, digits and all other characters beyond ASCII; A-Z lower-cased."""
    return TERM.findall((text or "").encode().translate(_LOWER))


@dataclass(frozen=True)
class Items:
    """Benchmark items of a chunk: the distinct pairs of id and text, and per item the numbers of its terms."""

    ids: list[int | None]
    names: dict[bytes, int]
    terms: list[np.ndarray]


def number_terms(rows: list[tuple[int | None, str]]) -> Items:
    names: dict[bytes, int] = {}
    terms = [np.array(sorted({names.setdefault(term, len(names)) for term in terms_of(text)}), np.int64) for _, text in rows]
    return Items([key for key, _ in rows], names, terms)


def restricted_vectors(docs: DataFrame, names: dict[bytes, int]) -> DataFrame:
    """Per document with a term: ``doc_id``, ``n`` (all its terms) and the items' terms among them, ``terms`` with their ``tfs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            keys, sizes, terms, tfs = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms_of(text.as_py())
                if found:
                    counts = [(known[term], tf) for term, tf in Counter(found).items() if term in known]
                    keys.append(key)
                    sizes.append(len(found))
                    terms.append([term for term, _ in counts])
                    tfs.append([tf for _, tf in counts])
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64())),
            ], ["doc_id", "n", "terms", "tfs"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def gains(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """What a term adds per weight: grows with ``tf``, falls with ``m``."""
    return GAIN * tf // (TF_SCALE * tf + M_SCALE * m)


class DocumentTree:
    """FP-tree of some documents: their vectors, most frequent term first, share the paths from the root.

    Documents lie in the order of their vectors, so a subtree is a range of them. A node keeps the terms below it with their
    greatest ``tf`` and the least ``m``, as the ``gains`` that no document of the subtree exceeds. Paths without a branch are
    one node; a subtree of few documents, or of equal vectors, is a leaf that is scored as a whole.
    """

    def __init__(self, keys: np.ndarray, m: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], size: int, leaf: int) -> None:
        ordered = []
        for term, tf in zip(terms, tfs, strict=True):
            by_place = np.argsort(term)
            ordered.append((term[by_place], tf[by_place]))
        paths = [term.tolist() for term, _ in ordered]
        order = sorted(range(len(paths)), key=lambda at: (paths[at], keys[at]))
        self.paths = [paths[at] for at in order]
        self.keys, self.m = keys[order], m[order]
        lengths = np.array([len(path) for path in self.paths])
        self.start = np.concatenate([[0], np.cumsum(lengths)])
        self.terms = np.concatenate([ordered[at][0] for at in order] or [np.zeros(0, np.int64)])
        self.tf = np.concatenate([ordered[at][1] for at in order] or [np.zeros(0, np.int64)])
        self.gain = gains(self.tf, np.repeat(self.m, lengths))
        self.size, self.leaf = size, leaf
        self.known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, int]] = {}
        self.below: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def bound(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Terms of the subtree, the most each can add per weight, and the smallest document."""
        if (low, high) not in self.known:
            part = slice(self.start[low], self.start[high])
            order = np.argsort(self.terms[part], kind="stable")
            terms, tf = self.terms[part][order], self.tf[part][order]
            new = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
            most = np.maximum.reduceat(tf, new) if len(new) else tf
            self.known[low, high] = terms[new], gains(most, int(self.m[low:high].min())), int(self.keys[low:high].min())
        return self.known[low, high]

    def children(self, low: int, high: int) -> list[tuple[int, int]]:
        """Ranges of the next branches below the path that all documents of the range share; none for a leaf."""
        if (low, high) not in self.below:
            first, last = self.paths[low], self.paths[high - 1]
            shared = next((at for at, (a, b) in enumerate(zip(first, last, strict=False)) if a != b), min(len(first), len(last)))
            cuts = [low]
            if high - low > self.leaf and first != last:
                for at in range(low + 1, high):
                    if self.paths[at][shared:shared + 1] != self.paths[at - 1][shared:shared + 1]:
                        cuts.append(at)
            self.below[low, high] = list(zip(cuts, [*cuts[1:], high], strict=True)) if len(cuts) > 1 else []
        return self.below[low, high]

    def search(self, weights: np.ndarray, best: list[tuple[int, int]], top: int) -> None:
        """Depth first, the most promising branch first; ``best`` is a heap of the ``top`` highest (score, -document)."""
        stack = [(self._most(weights, 0, len(self.keys)), 0, len(self.keys))] if len(self.keys) else []
        while stack:
            most, low, high = stack.pop()
            if not self._open(most, low, high, best, top):
                continue
            branches = self.children(low, high)
            if branches:
                found = [(self._most(weights, *branch), *branch) for branch in branches]
                stack += sorted(branch for branch in found if self._open(*branch, best, top))
                continue
            part = slice(self.start[low], self.start[high])
            total = np.concatenate([[0], np.cumsum(weights[self.terms[part]] * self.gain[part])])
            cut = self.start[low:high + 1] - self.start[low]
            scores = total[cut[1:]] - total[cut[:-1]]
            floor = best[0][0] if len(best) == top else 1
            for at in np.flatnonzero(scores >= floor):
                entry = (int(scores[at]), -int(self.keys[low + at]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)

    def _most(self, weights: np.ndarray, low: int, high: int) -> int:
        terms, gain, _ = self.bound(low, high)
        return int((weights[terms] * gain).sum())

    def _open(self, most: int, low: int, high: int, best: list[tuple[int, int]], top: int) -> bool:
        return most > 0 and (len(best) < top or (most, -self.bound(low, high)[2]) > best[0])


def search_trees(
    vectors: DataFrame, items: Items, weights: np.ndarray, places: np.ndarray, documents: int, terms: int,
    top: int = TOP, entries: int = TREE_ENTRIES, leaf: int = LEAF_DOCS,
) -> DataFrame:
    """Per task and item the ``top`` best documents of the task: ``item`` (number), ``doc_id``, ``score``.

    ``places`` numbers the terms from frequent to rare, ``weights`` is in that order. Trees are made one after another, each of
    documents with about ``entries`` terms in all; what earlier ones found bounds the search of later ones.
    """
    shipped = vectors.sparkSession.sparkContext.broadcast((weights, places, [places[found] for found in items.terms]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, places, wanted = shipped.value
        best: list[list[tuple[int, int]]] = [[] for _ in wanted]
        held, size = [], 0

        def search() -> None:
            keys, n, found, tfs = zip(*held, strict=True)
            m = np.array([M_FLAT + M_LENGTH * x * documents // terms for x in n], np.int64)
            tree = DocumentTree(np.array(keys, np.int64), m, list(found), list(tfs), len(weights), leaf)
            own = np.zeros(len(weights), np.int64)
            for at, item in enumerate(wanted):
                own[item] = weights[item]
                tree.search(own, best[at], top)
                own[item] = 0

        for batch in batches:
            keys = [LAST_ID if key is None else key for key in batch.column(0).to_pylist()]
            for key, n, found, tfs in zip(keys, batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                held.append((key, n, places[found.values.to_numpy()], tfs.values.to_numpy().astype(np.int64)))
                size += len(found) + 8
                if size >= entries:
                    search()
                    held, size = [], 0
        if held:
            search()
        rows = [(at, -key, score) for at, heap in enumerate(best) for score, key in heap]
        item, key, score = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([
            pa.array(item, pa.int64()), pa.array([None if k == LAST_ID else k for k in key], pa.int64()), pa.array(score, pa.int64()),
        ], ["item", "doc_id", "score"])

    kept = vectors.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs")
    return kept.mapInArrow(run, "item long, doc_id long, score long")


def _rank_chunk(docs: DataFrame, items: Items, top: int, entries: int, leaf: int) -> DataFrame:
    spark = docs.sparkSession
    vectors = materialize(restricted_vectors(docs, items.names), "term-vectors")
    documents, terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    df = np.zeros(len(items.names), np.int64)
    for term, count in counts.collect():  # at most the terms of the chunk
        df[term] = count
    by_df = np.argsort(-df, kind="stable")
    places = np.empty(len(df), np.int64)
    places[by_df] = np.arange(len(df))
    weight = [math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df[by_df]]
    found = search_trees(vectors, items, np.array(weight, np.int64), places, documents, max(terms, 1), top, entries, leaf)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.hash("doc_id", "score"), F.lit(MERGE))
    # Two steps: what all tasks found for an item never meets in one.
    first = found.withColumn("_rank", F.row_number().over(Window.partitionBy("item", part).orderBy(*best))).filter(F.col("_rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).filter(F.col("rank") <= top)
    named = spark.createDataFrame([(at, key) for at, key in enumerate(items.ids)], "item long, item_id long")
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, benchmark: DataFrame, top: int = TOP, chunk_chars: int = CHUNK_CHARS, entries: int = TREE_ENTRIES, leaf: int = LEAF_DOCS,
) -> DataFrame:
    """Per item of ``benchmark`` its ``top`` documents with the highest score above 0: ``item_id``, ``rank``, ``doc_id``, ``score``.

    The documents' terms are restricted to those of the items and written once; df, the number of documents and of terms are
    counted over all of them. Every task puts its documents into FP-trees and searches them for each item by branch and
    bound: a subtree whose greatest tf and least m cannot reach the item's worst document so far is skipped, as is one that
    can only equal it with larger ids. Tasks hand on at most ``top`` documents an item; these are merged in two steps. Items
    are taken in chunks of about ``chunk_chars`` characters, whose terms go to the tasks as a broadcast of that size.

    Documents and items without text have no terms: such documents count for nothing, such items have no rows. Rows that
    repeat an id are documents of their own; a missing id comes last among equal scores. Items that repeat id and text are one;
    an id with two texts is ranked for each of them. Other columns are dropped.
    """
    spark = docs.sparkSession
    pairs = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    pairs = materialize(pairs.filter("text is not null").distinct(), "items")
    chars = pairs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-chars // chunk_chars))
    ranked = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for chunk in range(chunks):
        rows = pairs.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == chunk).orderBy("item_id", "text").collect()
        items = number_terms([(row[0], row[1]) for row in rows])
        if items.names:
            ranked = ranked.unionByName(_rank_chunk(docs, items, top, entries, leaf))
    return ranked


@query("op11_lexical_search", r"""
    with t as (select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) as term from documents),
      tf as (select doc_id, term, count(*) as tf from t group by doc_id, term),
      len as (select doc_id, count(*) as n from t group by doc_id),
      all_ as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from len),
      q as (select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) as term from benchmark),
      w as (select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1))) as bigint) as w
        from (select term, count(*) as df from tf where term in (select term from q) group by term), all_),
      s as (select q.item_id, tf.doc_id, cast(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf
          + 20 * (100 - 50 + (50 * len.n * all_.n_docs) // all_.n_terms)))) as bigint) as score
        from q join w on q.term = w.term join tf on tf.term = q.term join len on len.doc_id = tf.doc_id, all_ group by q.item_id, tf.doc_id)
    select item_id, cast(rank as int) as rank, doc_id, score from (
      select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0) where rank <= 50""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
