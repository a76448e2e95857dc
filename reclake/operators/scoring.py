"""Batch scoring: towers, attention, pair scores and top-k recommendations."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.contracts import BATCH_NORM_EPSILON, TOP_K
from reclake.functions import vectors as V
from reclake.functions.features import attention_json, to_stars

Layer = dict[str, np.ndarray]
# Rows of a block of vectors, and scores that a task holds at once.
MIN_BLOCK, MAX_BLOCK, SCORES = 256, 32_768, 4_194_304


def gmf_score(df: DataFrame, weights: list[float], bias: float, name: str = "score") -> DataFrame:
    """``sigmoid(sum(u * v * w) + b)`` over the columns ``user_vector`` and ``item_vector``."""
    product = F.zip_with(V.doubles(F.col("user_vector")), V.doubles(F.col("item_vector")), lambda u, v: u * v)
    return df.withColumn(name, V.sigmoid(V.dot(product, V.literal(weights)) + F.lit(float(bias))))


def modality_attention(df: DataFrame, scorers: dict[str, tuple[list[float], float]]) -> DataFrame:
    """Softmax over one linear score per modality: the ``weights`` and the weighted vectors.

    Reads ``cat_vec``, ``text_vec`` and ``img_vec``; ``scorers`` holds weights and bias for each of these names.
    """
    names = ("cat_vec", "text_vec", "img_vec")
    raw = F.array(*[
        V.dot(V.doubles(F.col(name)), V.literal(scorers[name][0])) + F.lit(float(scorers[name][1])) for name in names
    ])
    peak = F.array_max("_raw")
    exps = F.transform("_raw", lambda score: F.exp(score - peak))
    scored = df.withColumn("_raw", raw).withColumn("_exp", exps)
    scored = scored.withColumn("weights", F.transform("_exp", lambda value: value / V.total(F.col("_exp"))))
    weighted = {
        f"{name}_weighted": V.scale(V.doubles(F.col(name)), F.get("weights", F.lit(place)))
        for place, name in enumerate(names)
    }
    return scored.withColumns(weighted).drop("_raw", "_exp")


def hybrid_score(df: DataFrame, name: str = "hybrid_score") -> DataFrame:
    """Interaction probability times predicted rating."""
    return df.withColumn(name, F.col("p_inter") * F.col("p_rating"))


def _dense() -> Callable[[np.ndarray, Layer], np.ndarray]:
    """Linear, batch normalisation with stored moments, ReLU; made here so that tasks get it by value."""
    epsilon = BATCH_NORM_EPSILON

    def dense(x: np.ndarray, layer: Layer) -> np.ndarray:
        y = x @ layer["weight"].T + layer["bias"]
        y = (y - layer["mean"]) / np.sqrt(layer["var"] + epsilon) * layer["gamma"] + layer["beta"]
        return np.maximum(y, 0.0)

    return dense


def score_user_tower(users: DataFrame, layer: Layer) -> DataFrame:
    """``user_vector`` per user out of ``(user_id, emb)``.

    Embeddings are a column, joined at scale like any table; only the layer, whose size is fixed, is shipped to tasks.
    """
    dense, shipped = _dense(), users.sparkSession.sparkContext.broadcast(layer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors = dense(np.stack(batch["emb"]).astype(float), shipped.value)
                yield pd.DataFrame({"user_id": batch["user_id"], "user_vector": list(vectors)})

    return users.select("user_id", "emb").mapInPandas(run, "user_id bigint, user_vector array<double>")


def score_item_tower(items: DataFrame, weights: dict) -> DataFrame:
    """``item_vector`` and attention ``weights`` per item; ids pass through.

    ``items`` has ``item_id, item_idx, emb, genres_multihot, text_emb, img_emb``. ``weights`` holds the layers
    ``item``, ``category``, ``final``, the list of layers ``content``, and ``attention``: weights and bias for
    ``category``, ``text`` and ``image``.
    """
    dense, shipped = _dense(), items.sparkSession.sparkContext.broadcast(weights)
    columns = ["item_id", "item_idx", "emb", "genres_multihot", "text_emb", "img_emb"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shipped.value
        for batch in batches:
            if not len(batch):
                continue
            emb, genres, text, image = (np.stack(batch[name]).astype(float) for name in columns[2:])
            parts = {"category": dense(genres, net["category"]), "text": text, "image": image}
            scores = np.column_stack([parts[name] @ np.asarray(w) + b for name, (w, b) in net["attention"].items()])
            shares = np.exp(scores - scores.max(axis=1, keepdims=True))
            shares /= shares.sum(axis=1, keepdims=True)
            content = np.hstack([parts[name] * shares[:, [at]] for at, name in enumerate(net["attention"])])
            for layer in net["content"]:
                content = dense(content, layer)
            fused = dense(np.hstack([dense(emb, net["item"]), content]), net["final"])
            yield pd.DataFrame({
                "item_id": batch["item_id"], "item_idx": batch["item_idx"],
                "item_vector": list(fused), "weights": list(shares),
            })

    schema = "item_id bigint, item_idx bigint, item_vector array<double>, weights array<double>"
    return items.select(columns).mapInPandas(run, schema)


def score_pairs(
    pairs: DataFrame, users: DataFrame, items: DataFrame, rating: tuple[list[float], float],
    interaction: tuple[list[float], float] | None = None,
) -> DataFrame:
    """Predicted rating, stars and attention JSON per pair; with an interaction head also its probability and the
    hybrid score.

    Each tower has run once per user and per item; a pair costs two joins and a native dot product. Every pair is answered: a
    user or item without a vector counts as a zero vector, and an item without weights has no attention text.
    """
    joined = pairs.join(users.select("user_id", "user_vector"), "user_id", "left")
    joined = joined.join(items.select("item_id", "item_vector", "weights"), "item_id", "left")
    nothing = F.array_repeat(F.lit(0.0), len(rating[0]))
    joined = joined.withColumns({name: F.coalesce(V.doubles(F.col(name)), nothing) for name in ("user_vector", "item_vector")})
    scored = gmf_score(joined, *rating, name="p_rating").withColumn("stars", to_stars(F.col("p_rating")))
    shares = [F.get("weights", F.lit(place)) for place in range(3)]
    scored = scored.withColumn("attention_weights", F.when(F.col("weights").isNotNull(), attention_json(*shares)))
    if interaction is not None:
        scored = hybrid_score(gmf_score(scored, *interaction, name="p_inter"))
    return scored.drop("user_vector", "item_vector")


def explain(scored: DataFrame, user: int, item: int) -> DataFrame:
    """Stars and attention shares in percent of one recommendation out of :func:`score_pairs`."""
    shares = [
        (F.get("weights", F.lit(place)) * 100).alias(name)
        for place, name in enumerate(("category_pct", "text_pct", "image_pct"))
    ]
    wanted = (F.col("user_id") == user) & (F.col("item_id") == item)
    return scored.filter(wanted).select("user_id", "item_id", "stars", *shares)


def recommendations(
    best: DataFrame, users: DataFrame, items: DataFrame, rating: tuple[list[float], float],
    interaction: tuple[list[float], float] | None = None,
) -> DataFrame:
    """The table of recommendations out of a top-k search ``(user_id, item_id, rank)``: stars and attention JSON per place.

    Columns ``user_id, item_id, rank, stars, attention_weights`` and, with an interaction head, ``hybrid_score``.
    """
    scored = score_pairs(best.select("user_id", "item_id", "rank"), users, items, rating, interaction)
    more = ["hybrid_score"] if interaction is not None else []
    return scored.select("user_id", "item_id", "rank", "stars", "attention_weights", *more)


def block_rows(count: int) -> int:
    """Rows per block of a table of vectors: a sixth of them, so that there are tasks to share, within bounds of memory."""
    return min(max(ceil(count / 6), MIN_BLOCK), MAX_BLOCK)


def best_places(k: int) -> tuple[Callable, Callable]:
    """Two helpers of the searches; made here so that tasks get them by value.

    ``reaching`` finds the scores of a block that can be among the ``k`` best of their row, equal ones included, and a floor per row,
    which is no more than its k-th best score and at least the ``least`` it is given. The k-th greatest of the maxima of groups of columns
    is such a floor; it takes one pass over the scores, and only groups that reach it are searched. ``first`` orders what was found by user,
    score and item id, and keeps the first ``k`` of every user.
    """

    def reaching(scores: np.ndarray, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, count = scores.shape
        groups = max(k, ceil(sqrt(count * k)))
        size = count // groups
        floors = np.full(rows, -np.inf) if least is None else least
        if size < 4:
            if count >= k:
                floors = np.maximum(floors, np.partition(scores, count - k, axis=1)[:, count - k])
            at, which = np.nonzero((scores >= floors[:, None]) & (scores > -np.inf))
            return at, which, floors
        grouped = scores[:, :size * groups].reshape(rows, size, groups)
        greatest = grouped.max(axis=1)
        floors = np.maximum(floors, np.partition(greatest, groups - k, axis=1)[:, groups - k])
        at, group = np.nonzero((greatest >= floors[:, None]) & (greatest > -np.inf))
        inside = grouped[at, :, group]
        found, place = np.nonzero((inside >= floors[at][:, None]) & (inside > -np.inf))
        rest, more = np.nonzero((scores[:, size * groups:] >= floors[:, None]) & (scores[:, size * groups:] > -np.inf))
        return np.append(at[found], rest), np.append(place * groups + group[found], size * groups + more), floors

    def first(users: np.ndarray, items: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
        order = np.lexsort((items, -scores, users))
        users = users[order]
        kept = np.arange(len(users)) - np.searchsorted(users, users) < k
        return pd.DataFrame({"user_id": users[kept], "item_id": items[order][kept], "score": scores[order][kept]})

    return reaching, first


def recommend_top_k(
    users: DataFrame, items: DataFrame, seen: DataFrame, k: int = TOP_K, block: int | None = None
) -> DataFrame:
    """The ``k`` unseen items with the highest dot product per user; exact, equal scores by item id.

    ``users`` is ``(user_id, vector)``, ``items`` is ``(item_id, vector)``, ``seen`` holds (user, item) pairs. Users
    and items are cut into blocks of about ``block`` rows (default: :func:`block_rows`) and multiplied block by block: a task
    holds one user block, one item block and the seen pairs between them, and returns at most ``k`` items per user. Neither
    table is broadcast, nor are scored pairs shuffled. Larger blocks copy the tables less often and need more memory per task.
    Both tables are counted first, so pass stored ones. Exact search compares all pairs: its work is users times items.
    """
    user_count, item_count = users.count(), items.count()
    user_blocks = max(1, ceil(user_count / (block or block_rows(user_count))))
    item_blocks = max(1, ceil(item_count / (block or block_rows(item_count))))

    def place(frame: DataFrame, col: str, blocks: int, name: str) -> DataFrame:
        return frame.withColumn(name, F.pmod(F.xxhash64(col), F.lit(blocks)))

    def spread(frame: DataFrame, blocks: int, name: str) -> DataFrame:
        return frame.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))

    key = ["user_block", "item_block"]
    left = users.select("user_id", F.col("vector").alias("user_vector"))
    left = spread(place(left, "user_id", user_blocks, key[0]), item_blocks, key[1])
    right = items.select("item_id", F.col("vector").alias("item_vector"))
    right = spread(place(right, "item_id", item_blocks, key[1]), user_blocks, key[0])
    # pairs of others are left out before they are sorted or shuffled
    seen = seen.select("user_id", "item_id").join(users.select("user_id"), "user_id", "left_semi").join(items.select("item_id"), "item_id", "left_semi")
    pairs = place(place(seen.distinct(), "user_id", user_blocks, key[0]), "item_id", item_blocks, key[1])
    right = right.unionByName(pairs, allowMissingColumns=True)

    cells, (reaching, first) = SCORES, best_places(k)

    def best(block_users: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"user_id": [], "item_id": [], "score": []})
        known = others["user_id"].isna()
        block_items, block_seen = others[known], others[~known]
        if block_users.empty or block_items.empty:
            return empty
        item_ids = block_items["item_id"].to_numpy(dtype=np.int64)
        matrix = np.stack(block_items["item_vector"]).astype(float)
        item_at = pd.Series(np.arange(len(item_ids)), index=item_ids)
        user_at = pd.Series(np.arange(len(block_users)), index=block_users["user_id"].to_numpy(dtype=np.int64))
        rows = user_at.reindex(block_seen["user_id"].to_numpy(dtype=np.int64)).to_numpy()
        cols = item_at.reindex(block_seen["item_id"].to_numpy(dtype=np.int64)).to_numpy()
        both = ~(np.isnan(rows) | np.isnan(cols))
        rows, cols = rows[both].astype(int), cols[both].astype(int)
        user_ids, found = block_users["user_id"].to_numpy(dtype=np.int64), [empty]
        step = max(1, cells // len(item_ids))
        for start in range(0, len(user_ids), step):
            scores = np.stack(block_users["user_vector"].iloc[start:start + step]).astype(float) @ matrix.T
            here = (rows >= start) & (rows < start + step)
            scores[rows[here] - start, cols[here]] = -np.inf
            at, which, _ = reaching(scores)
            found.append(first(user_ids[start + at], item_ids[which], scores[at, which]))
        return pd.concat(found)

    schema = "user_id bigint, item_id bigint, score double"
    candidates = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(best, schema)
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id"))
    return candidates.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= k)
