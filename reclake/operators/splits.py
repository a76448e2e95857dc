"""Noise filters and time-ordered splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclake.contracts import (
    CORE_MIN_ITEM,
    CORE_MIN_USER,
    CORE_ROUNDS,
    NOISE_MIN_ITEM,
    NOISE_MIN_USER,
    TRAIN_RATIO,
    VAL_RATIO,
)
from reclake.operators.joins import keep_in
from reclake.operators.positions import group_positions
from reclake.operators.profiles import active_ids
from reclake.session import materialize_packed as materialize

# Most rows of a user whose history is sorted by one task.
_FEW = 100_000


@dataclass(frozen=True)
class Core:
    """Result of :func:`kcore`."""

    clean: DataFrame
    discarded: DataFrame
    rounds: int
    converged: bool


def _mark(df: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Flag ``kept``: both the user and the item of the row are valid."""
    marked = df.join(users.withColumn("_user_ok", F.lit(True)), "user_id", "left")
    marked = marked.join(items.withColumn("_item_ok", F.lit(True)), "item_id", "left")
    kept = F.col("_user_ok").isNotNull() & F.col("_item_ok").isNotNull()
    return marked.withColumn("kept", kept).select(*df.columns, "kept")


def kcore(df: DataFrame, min_user: int = CORE_MIN_USER, min_item: int = CORE_MIN_ITEM, max_iter: int = CORE_ROUNDS) -> Core:
    """Drop users with fewer than ``min_user`` rows, then items with fewer than ``min_item``, until nothing changes.

    At most ``max_iter`` rounds. Each round writes the surviving id pairs, which cuts the lineage and gives the count
    that decides whether to go on. The valid ids of a round are among those of the round before, so a row survives
    all rounds exactly if both its ids are valid in the last one: the full rows are joined once, at the end.
    """
    pairs = materialize(df.select("user_id", "item_id"), "core-pairs")
    size, rounds, converged = pairs.count(), 0, False
    while rounds < max_iter and not converged:
        rounds += 1
        pairs = keep_in(pairs, active_ids(pairs, "user_id", min_user), "user_id")
        pairs = keep_in(pairs, active_ids(pairs, "item_id", min_item), "item_id")
        pairs = materialize(pairs, "core-pairs")
        left = pairs.count()
        size, converged = left, left == size
    users = pairs.select("user_id").distinct()
    items = pairs.select("item_id").distinct()
    marked = _mark(df, users, items)
    return Core(
        clean=marked.filter("kept").drop("kept"),
        discarded=marked.filter("not kept").drop("kept"),
        rounds=rounds,
        converged=converged,
    )


def mark_noise(df: DataFrame, min_user: int = NOISE_MIN_USER, min_item: int = NOISE_MIN_ITEM) -> DataFrame:
    """One pass: flag ``kept`` for rows of users with enough rows and of items with enough rows among those."""
    users = active_ids(df, "user_id", min_user)
    items = active_ids(keep_in(df, users, "user_id"), "item_id", min_item)
    return _mark(df, users, items)


def filter_noise(df: DataFrame, min_user: int = NOISE_MIN_USER, min_item: int = NOISE_MIN_ITEM) -> tuple[DataFrame, DataFrame]:
    """Clean and discarded rows of :func:`mark_noise`."""
    marked = mark_noise(df, min_user, min_item)
    return marked.filter("kept").drop("kept"), marked.filter("not kept").drop("kept")


def noise_counts(df: DataFrame, min_user: int = NOISE_MIN_USER, min_item: int = NOISE_MIN_ITEM) -> DataFrame:
    """Rows removed by the user rule, removed by the item rule, and left."""
    users = active_ids(df, "user_id", min_user)
    by_user = keep_in(df, users, "user_id")
    by_item = keep_in(by_user, active_ids(by_user, "item_id", min_item), "item_id")
    counts = [frame.agg(F.count("*").alias(name)) for frame, name in ((df, "n0"), (by_user, "n1"), (by_item, "n2"))]
    n0, n1, n2 = (frame.scalar() for frame in counts)
    return df.sparkSession.range(1).select(
        (n0 - n1).alias("removed_by_users"), (n1 - n2).alias("removed_by_items"), n2.alias("clean"),
    )


def _cut(share: Column, train: float, val: float) -> Column:
    return F.when(share <= train, "train").when(share <= train + val, "val").otherwise("test")


def temporal_split(df: DataFrame, train: float = TRAIN_RATIO, val: float = VAL_RATIO) -> DataFrame:
    """Label each row ``train``, ``val`` or ``test`` by its place in the user's history, oldest first.

    Ordered by (ts, item_id). Positions of long histories are counted in blocks, so no task sorts the whole of one.
    """
    ranked = group_positions(df, ["user_id"], ["ts", "item_id"], "_pos", "_size", _FEW)
    return ranked.withColumn("split", _cut(F.col("_pos") / F.col("_size"), train, val)).drop("_pos", "_size")


@dataclass(frozen=True)
class SplitConfig:
    train_ratio: float = TRAIN_RATIO
    val_ratio: float = VAL_RATIO


def temporal_split_pct(df: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:
    """:func:`temporal_split` with free ratios; fails if the splits do not add up to the input."""
    split = materialize(temporal_split(df, config.train_ratio, config.val_ratio), "split")
    if split.count() != df.count():
        raise ValueError("the splits do not hold every input row")
    return split


def by_split(df: DataFrame, names: tuple[str, ...] = ("train", "val", "test")) -> dict[str, DataFrame]:
    return {name: df.filter(F.col("split") == name).drop("split") for name in names}


def union_splits(*frames: DataFrame) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
