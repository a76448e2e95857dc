"""N-gram Jaccard join: documents whose word shingles overlap enough are linked and gathered into components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reclake.llm.common import LAST_ID
from reclake.llm.graph import components
from reclake.llm.hashfilter import hash_filter, passes
from reclake.llm.hashing import mix, window_hashes, word_hashes
from reclake.llm.registry import query, table
from reclake.llm.substrings import _base, _groups, _key, several_texts
from reclake.session import materialize

WORDS, PERCENT = 4, 85
# A first comparison is worth it if the lists have this part of the hits in common that a link needs there.
WORTHWHILE = 0.25
BATCH_BYTES, FREQUENT_IN_GROUP, MAX_FREQUENT = 1_000_000, 2, 1_000_000
MAX_BROADCAST = 3_000_000
VERIFY_BATCH = 400
_SALT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and their number per text. A-Z are lower-cased.

    A text of fewer words is one shingle, a text without words has none.
    """
    hashes, counts = word_hashes(texts, lower=True)
    owner = np.repeat(np.arange(len(texts)), counts)
    offset = np.cumsum(counts) - counts
    start = np.arange(len(hashes)) - offset[owner]
    whole = np.flatnonzero(start + words <= counts[owner]) if len(hashes) else np.zeros(0, np.int64)
    shingles, holder = [window_hashes(hashes, words)[whole]], [owner[whole]]
    for size in range(1, words):
        short = np.flatnonzero(counts == size)
        if len(short):
            shingles.append(mix(window_hashes(hashes, size)[offset[short]] + np.uint64(size)))
            holder.append(short)
    shingle, holder = np.concatenate(shingles), np.concatenate(holder)
    order = np.lexsort((shingle, holder))
    shingle, holder = shingle[order], holder[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (holder[1:] != holder[:-1])
    return shingle[new], np.bincount(holder[new], minlength=len(texts))


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``_key`` (order of documents), ``_ver`` (of the text) and ``_node``, a number for each pair of both.

    The number is the key itself, unless rows of different texts share an id: these few are numbered by a hash, beyond all ids.
    """
    base = _base(docs)
    twice = several_texts(base)
    if twice is None:
        return base.withColumn("_node", F.col("_key"))
    twice = twice.withColumn("_twice", F.lit(True))
    number = F.lit(LAST_ID) - F.abs(F.xxhash64("_key", "_ver") % F.lit(1 << 62))
    return _only(base, twice, "_key", "left").withColumn("_node", F.when(F.col("_twice"), number).otherwise(F.col("_key"))).drop("_twice")


def frequent_shingles(base: DataFrame, words: int, most: int = MAX_FREQUENT) -> np.ndarray:
    """Hashes of at most ``most`` shingles of very many documents, from rare to frequent; only the order of lists uses them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _groups(batches, BATCH_BYTES):
            shingle, _ = shingle_sets(texts, words)
            value, count = np.unique(shingle, return_counts=True)
            often = count >= FREQUENT_IN_GROUP
            yield pa.RecordBatch.from_arrays([pa.array(value[often].view(np.int64)), pa.array(count[often])], ["shingle", "n"])

    counts = base.select("_node", "text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    return rows.column("shingle").to_numpy()[::-1].astype(np.int64).view(np.uint64)


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-percent * n // 100)


def short_lists(base: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per document ``_node``, ``n`` (shingles), two digests of the set, and ``short``: shingles whose lists are merged.

    All sets are ordered alike: by hash, frequent shingles last. A text of n shingles shares at least T = ``percent`` of n with a
    partner. Its T - 1 last shingles, among them the long lists, are set aside for probing; the partner must hold one of the
    others, the short lists.
    """
    by_hash = np.argsort(frequent)
    known = frequent[by_hash]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _groups(batches, BATCH_BYTES):
            shingle, n = shingle_sets(texts, words)
            owner = np.repeat(np.arange(len(texts)), n)
            one, two = (np.zeros(len(texts), np.uint64) for _ in range(2))
            full = np.flatnonzero(n)
            if len(full):
                begin = (np.cumsum(n) - n)[full]
                one[full] = np.add.reduceat(mix(shingle), begin)
                two[full] = np.add.reduceat(mix(shingle ^ _SALT), begin)
            rank = np.zeros(len(shingle), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, shingle), len(known) - 1)
                rank = np.where(known[at] == shingle, by_hash[at] + 1, 0)
            order = np.lexsort((shingle, rank, owner))
            place = np.arange(len(shingle)) - np.repeat(np.cumsum(n) - n, n)
            size = np.where(n > 0, n - _needed(n, percent) + 1, 0)
            chosen = shingle[order][place < size[owner]]
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(chosen.view(np.int64))),
            ], ["_node", "n", "one", "two", "short"])

    return base.select("_node", "text").mapInArrow(run, "_node long, n long, one long, two long, short array<long>")


def inverted_lists(sets: DataFrame, shared: np.ndarray) -> DataFrame:
    """A row ``shingle``, ``_node``, ``n``, ``at`` (place in the order) per entry of ``short`` that the filter ``shared`` lets pass."""
    shipped = sets.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch.column(2).flatten().to_numpy()
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = passes(shipped.value, entries)
            yield pa.RecordBatch.from_arrays([
                pa.array(entries[kept]), pa.array(batch.column(0).to_numpy()[row[kept]]), pa.array(batch.column(1).to_numpy()[row[kept]]),
                pa.array(at[kept].astype(np.int32)),
            ], ["shingle", "_node", "n", "at"])

    return sets.mapInArrow(run, "shingle long, _node long, n long, at int")


def _only(
    df: DataFrame, keys: DataFrame, on: str | list[str], how: str = "left_semi", max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``df`` joined with a written table: broadcast if its rows are few, else by a shuffle."""
    return df.join(F.broadcast(keys) if keys.count() <= max_broadcast else keys, on, how)


def _enough(shared: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return shared * (100 + percent) >= percent * (n_a + n_b)


def verify(pairs: DataFrame, base: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole sets overlap enough; each shingle of one is looked up in the other by binary search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, VERIFY_BATCH):
                part = batch.slice(at, VERIFY_BATCH)
                texts = [text for name in ("_ta", "_tb") for text in part.column(name).cast(pa.binary()).to_pylist()]
                shingle, n = shingle_sets(texts, words)
                sets = np.split(shingle, np.cumsum(n)[:-1])
                linked = []
                for one, other in zip(sets[:part.num_rows], sets[part.num_rows:], strict=True):
                    less, more = sorted((one, other), key=len)
                    places = np.minimum(np.searchsorted(more, less), max(len(more) - 1, 0))
                    both = int((more[places] == less).sum()) if len(more) else 0
                    linked.append(100 * both >= percent * (len(one) + len(other) - both) and both > 0)
                yield part.select(["a", "b"]).filter(pa.array(linked))

    pairs = materialize(pairs, "pairs")
    # The pairs go to the texts of one side; with the texts of the other they meet by a shuffle.
    texts = base.select("_node", "text")
    joined = _only(texts.select(F.col("_node").alias("a"), F.col("text").alias("_ta")), pairs, "a", "inner")
    keys = materialize(pairs.select(F.col("b").alias("_node")).distinct(), "pair-keys")
    others = _only(texts, keys, "_node").select(F.col("_node").alias("b"), F.col("text").alias("_tb"))
    joined = joined.join(others, "b")
    return materialize(joined.select("a", "b", "_ta", "_tb").mapInArrow(run, "a long, b long"), "linked")


def _needed_in_all(n_a: Column, n_b: Column, percent: int) -> Column:
    """Shingles that two linked sets of these sizes share at least."""
    return F.ceil(percent * (n_a + n_b) / (100 + percent))


def _set_aside(n: Column, percent: int) -> Column:
    """Length of the part of a set that is not in its short lists."""
    return F.ceil(n * percent / 100) - 1


def _candidates(lists: DataFrame, short: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may be linked: they share short lists enough for what the long lists can add.

    Two sets of given sizes that need T shared shingles share one before place n - T + 1 of both orders, so only such places
    are joined, and only of texts of like size: lists are split by size into bands, and a text meets its own band and the
    next. All hits in the short lists of a pair are counted after that.
    """
    named = _only(lists, comps, "_node", "left").withColumn("comp", F.coalesce("comp", "_node"))
    open_ = named.groupBy("shingle").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high")).filter("_low < _high")
    named = materialize(named.join(open_.select("shingle"), "shingle", "left_semi"), "open-lists")
    a, b = (named.select("shingle", "band", *[F.col(c).alias(f"{c}_{side}") for c in ("_node", "n", "at", "comp")]) for side in "ab")
    a = a.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    needed = _needed_in_all(F.col("n_a"), F.col("n_b"), percent)
    early = (F.col("at_a") <= F.col("n_a") - needed) & (F.col("at_b") <= F.col("n_b") - needed)
    # the smaller set is side a, equal ones in the order of nodes: every pair is met once
    once = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("_node_a") < F.col("_node_b")))
    pairs = a.join(b, ["shingle", "band"]).filter(once & (F.col("comp_a") != F.col("comp_b")) & near & early)
    pairs = materialize(pairs.select("_node_a", "_node_b", "n_a", "n_b").distinct(), "candidates")
    keys = materialize(pairs.select(F.col("_node_b").alias("_node")).distinct(), "candidate-keys")
    held = _only(short, keys, "_node").select(F.col("_node").alias("_node_b"), F.col("short").alias("short_b"))
    pairs = _only(short.withColumnsRenamed({"_node": "_node_a", "short": "short_a"}), pairs, "_node_a", "inner").join(held, "_node_b")
    both = F.size(F.array_intersect("short_a", "short_b"))
    # Shingles shared beyond these stand in the part set aside of the text whose short list ends first in the common order.
    probed = F.greatest(_set_aside(F.col("n_a"), percent), _set_aside(F.col("n_b"), percent))
    pairs = pairs.filter(_enough(both + probed, F.col("n_a"), F.col("n_b"), percent))
    return pairs.select(F.col("_node_a").alias("a"), F.col("_node_b").alias("b")).distinct()


def similar_groups(base: DataFrame, words: int, percent: int) -> DataFrame:
    """``_node``, ``n`` (shingles) and ``comp`` (smallest node reachable by links) of every one of :func:`documents`.

    Two documents are linked if ``percent`` of the union of their shingle sets is shared. Equal sets are one class and only
    its first document goes on. T-occurrence search: the lists of a document's rarest shingles are merged, so many that every
    partner shows up; the longest lists are only probed, by binary search, for the candidates. A candidate needs as many hits
    in the short lists as the long ones cannot make up for.

    First every document is compared with one document of its lists, the first of like size with most lists in common, if
    these are a fair part of the lists that a link needs. That ties large groups of near copies together by about one
    comparison a document. Then all candidate pairs of different components are compared, with no cap. Pairs within a
    component add nothing and are never made.
    """
    sets = materialize(short_lists(base, words, percent, frequent_shingles(base, words)), "short-lists")
    classes = sets.filter("n > 0").groupBy("n", "one", "two").agg(F.min("_node").alias("rep"))
    classes = materialize(classes, "classes")
    reps = materialize(classes.select(F.col("rep").alias("_node")).distinct(), "representatives")
    own = _only(sets.filter("n > 0"), reps, "_node").select("_node", "n", "short")
    ends = own.select("_node", F.explode("short").alias("shingle")).groupBy("shingle").agg(F.min("_node").alias("_low"), F.max("_node").alias("_high"))
    lists = inverted_lists(own, hash_filter(ends.filter("_low < _high"), "shingle"))
    band = F.floor(F.log(F.col("n")) / np.log(100 / percent)).cast("int")
    lists = materialize(lists.withColumn("band", band), "lists")
    # Joins of lists with lists are left to a shuffle: what they are joined with grows as they do.
    hubs = lists.groupBy("shingle", "band").agg(F.min("_node").alias("hub"))
    votes = lists.select("shingle", "band", "_node", "n").join(hubs, ["shingle", "band"]).filter("_node <> hub")
    votes = votes.groupBy("_node", "hub").agg(F.count("*").alias("_c"), F.max("n").alias("_n"))
    # for a hub of the same size; another size needs no fewer hits
    hits = _needed_in_all(F.col("_n"), F.col("_n"), percent) - _set_aside(F.col("_n"), percent)
    best = F.row_number().over(Window.partitionBy("_node").orderBy(F.desc("_c"), "hub"))
    first = votes.filter(F.col("_c") >= WORTHWHILE * hits).withColumn("_place", best).filter("_place = 1")
    links = verify(first.select(F.col("hub").alias("a"), F.col("_node").alias("b")), base, words, percent)
    comps = materialize(components(links).select(F.col("node").alias("_node"), F.col("component").alias("comp")), "components")
    more = verify(_candidates(lists, sets.select("_node", "short"), comps, percent), base, words, percent)
    comps = components(links.unionByName(more)).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    named = materialize(classes.join(comps, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")), "named-classes")
    found = sets.select("_node", "n", "one", "two").join(named, ["n", "one", "two"], "left")
    return found.select("_node", "n", F.coalesce("comp", "_node").alias("comp")).distinct()


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``_key``, ``_ver``, ``_node``, ``n``, ``comp``: one row per document, that is per id and text."""
    base = documents(docs)
    groups = similar_groups(base, words, percent)
    return materialize(base.select("_key", "_ver", "_node").distinct().join(groups, "_node"), "grouped")


def group_similar(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links, itself included).

    Null, empty or blank text: no shingles, linked with nothing. Documents without id come last; a component of such documents
    alone has no id. Rows that repeat id and text are one document and get the same result each; rows of one id and
    different texts are documents of their own. Other columns are dropped.
    """
    groups = _grouped(docs, words, percent)
    lows = groups.groupBy("comp").agg(F.min("_key").alias("_low"))
    named = groups.join(lows, "comp").select("_key", "_ver", "n", "_low")
    joined = _base(docs).select("doc_id", "_key", "_ver").join(named, ["_key", "_ver"])
    nameless = (F.col("_low") > F.lit(LAST_ID >> 1)) & F.col("doc_id").isNull()
    known = F.when(nameless, F.lit(None).cast("long")).otherwise(F.col("_low"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), known.alias("component_id"))


def keep_first(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; columns as they are.

    Texts without words are in no group and stay. Of rows that repeat an id and text one stays; of rows of one id and different
    texts one stays for each group they are in.
    """
    groups = _grouped(docs, words, percent)
    first = groups.groupBy("comp").agg(F.min(F.struct("_key", "_ver")).alias("_first")).select("_first.*")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.select(F.struct("*").alias("_row"), _key(text).alias("_key"), F.xxhash64(text).alias("_ver"))
    kept = marked.join(materialize(first, "first-of-group"), ["_key", "_ver"], "left_semi").groupBy("_key", "_ver").agg(F.first("_row").alias("_row"))
    return kept.select("_row.*")


@query("op5_ngram_jaccard")
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_similar(table(spark, sf_dir, "documents"))
