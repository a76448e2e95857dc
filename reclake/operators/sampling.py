"""Negative samples, evaluation decoys and seeded shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.contracts import BAD_STARS, DECOYS, MIN_DECOYS, NEGATIVES, QUALITY_STARS, SEED
from reclake.functions.features import PERMUTE_KEYS, from_stars, hash_keys, permute
from reclake.operators.cleaning import entity_dim
from reclake.operators.encoders import fit_labels
from reclake.operators.positions import group_positions, running
from reclake.operators.profiles import last_seen
from reclake.session import materialize_packed as materialize

SAMPLED_COLUMNS = ["user_id", "item_id", "user_idx", "item_idx", "genres_multihot", "rating_scaled"]
_CHUNK = 4096
# Steps of the walk that every draw may take at once; the few that need more go on by themselves. With more steps in one go the
# generated code grows too large to be compiled, and each draw takes several times as long.
_WALK = 1
# Most rows of a user whose seen items travel with each of the user's requests; the draws of others are counted in blocks.
_LIGHT = 256


def shuffle(df: DataFrame, seed: int, keys: list[str]) -> DataFrame:
    """Rows in a seeded order that depends only on the keys."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(key).cast("string") for key in keys])))


def unseen_items(pool: DataFrame, history: DataFrame) -> DataFrame:
    """Members of the pool that are not in the history."""
    return pool.join(history, [name for name in pool.columns if name in history.columns], "left_anti")


def _draws(requests: DataFrame, key: list[str], seed: int, carry: list[str]) -> DataFrame:
    """``key``, ``user_id``, ``carry``, ``draw`` and ``place``: distinct places in 0 .. free - 1, in the order of the request's permutation.

    ``idx`` is the number of the ``place``-th item that the user has not seen, where the request brings the ``_gaps`` of its user: per seen
    number, in order, the unseen ones before it. The place-th unseen number is the place plus the gaps that are not above it; with
    it known, the place is not kept.

    The permutation covers the smallest grid that holds all ``free`` places; a number beyond them is permuted again until it is
    one of them, which ends since its cycle leads back to the place it came from. Draws are made in chunks, so no row holds all
    of a large request.
    """
    keys = [f"_k{at}" for at in range(PERMUTE_KEYS)]
    parts = [F.lit(seed), *[F.col(name) for name in key]]
    rows = F.ceil(F.sqrt("free")).cast("bigint")
    keyed = requests.withColumns(dict(zip(keys, hash_keys(PERMUTE_KEYS, *parts), strict=True)))
    keyed = keyed.withColumn("_rows", rows).withColumn("_cols", F.ceil(F.col("free") / F.col("_rows")).cast("bigint"))
    count = F.least("need", "free").cast("bigint")
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1, F.lit(_CHUNK).cast("bigint")))
    chunks = keyed.filter(count > 0).withColumn("_count", count).withColumn("_first", first)
    last = F.least(F.col("_first") + _CHUNK, F.col("_count")) - 1
    drawn = chunks.withColumn("draw", F.explode(F.sequence("_first", last)))

    def step(place: str) -> Column:
        return permute(F.col(place), F.col("_rows"), F.col("_cols"), [F.col(name) for name in keys])

    drawn = drawn.withColumn("place", step("draw"))
    def walk(draws: DataFrame) -> DataFrame:
        """``place`` after up to ``_WALK`` more steps; a step stands inside its branch, to be worked out only where a draw needs it."""
        for _ in range(_WALK):
            draws = draws.withColumn("place", F.when(F.col("place") < F.col("free"), F.col("place")).otherwise(step("place")))
        return draws

    drawn = walk(drawn)
    drawn = drawn.withColumn("idx", F.col("place") + F.size(F.filter("_gaps", lambda gap: gap <= F.col("place"))))
    names = list(dict.fromkeys(["user_id", *key, *carry, "draw", "place", "idx"]))
    held = ["free", "_rows", "_cols", "_gaps", *keys]
    on = F.col("place") >= F.col("free")
    kept = [F.when(on | F.col("idx").isNull(), F.col("place")).alias("place") if name == "place" else F.col(name) for name in names]
    drawn = materialize(drawn.select(*kept, *[F.when(on, F.col(c)).alias(c) for c in held]), "draws")
    done, walking = [drawn.filter("free is null").select(names)], drawn.filter("free is not null")
    while not walking.isEmpty():
        walking = walk(walking.withColumn("place", step("place")))
        walking = materialize(walking.withColumn("idx", F.col("place") + F.size(F.filter("_gaps", lambda gap: gap <= F.col("place")))), "draws")
        done.append(walking.filter("place < free").select(names))
        walking = walking.filter("place >= free")
    return reduce(DataFrame.unionByName, done)


def _unseen_at(draws: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """``draws`` with ``idx``, the number of the ``place``-th item that the user has not seen.

    Of a user's seen numbers in order, the i-th has (number - i) unseen ones before it. So the place-th unseen number is the
    place plus the number of seen ones whose difference is not above it: a running count over both, in blocks.
    """
    ranked = group_positions(seen, ["user_id"], ["idx"], "_at")
    gaps = ranked.select("user_id", (F.col("idx") - F.col("_at") + 1).alias("place"), F.col("idx").alias("_own"), F.lit(0).alias("_drawn"))
    both = gaps.unionByName(draws.withColumn("_drawn", F.lit(1)), allowMissingColumns=True).withColumn("_seen", 1 - F.col("_drawn"))
    # seen numbers come before a draw of the same place; the rest of the order only tells rows apart
    counted = running(both, ["user_id"], ["place", "_drawn", "_own", *key, "draw"], "_seen", "sum", "_before")
    idx = F.col("place") + F.coalesce("_before", F.lit(0))
    return counted.filter("_drawn = 1").withColumn("idx", idx).select(*draws.columns, "idx")


def draw_unseen(
    requests: DataFrame, key: list[str], pool: DataFrame, history: DataFrame, seed: int, carry: list[str] | None = None,
    attributes: DataFrame | None = None,
) -> DataFrame:
    """For each request draw distinct items of the pool that its user has not seen, in a seeded random order.

    ``requests`` has one row per ``key``, with ``user_id`` and the wanted number ``need``. A request gets exactly min(need, unseen)
    items. The user's unseen items are permuted, no draw is ever rejected. Which item stands at a place is told by the user's seen
    numbers, which go along with the request where they are few, so that a draw is not moved; for other users it is counted in
    blocks of (user, number), so neither a heavy user nor a popular item makes a large group. Returns ``key`` and ``user_id``
    with ``item_id`` and ``draw``. Columns ``carry`` of the request and the ``attributes`` of the item come along, so that a draw moves
    once, to its item.
    """
    carry = carry or []
    numbered = fit_labels(pool.select("item_id"), "item_id").select(F.col("value").alias("item_id"), F.col("idx").cast("bigint").alias("idx"))
    numbered = materialize(numbered, "pool")
    known = history.select("user_id", "item_id").filter("user_id is not null")
    # rows, not different items of the pool: a bound for them that takes no join
    heavy = known.groupBy("user_id").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > _LIGHT).select("user_id")
    heavy = materialize(heavy, "heavy-users")
    any_heavy = not heavy.isEmpty()
    few = known.join(heavy, "user_id", "left_anti") if any_heavy else known
    # each user has few rows here, so they move to one task as they are; lists made before that would mostly hold one number
    few = few.join(numbered, "item_id").select("user_id", "idx").repartition("user_id").groupBy("user_id").agg(
        F.array_sort(F.array_distinct(F.collect_list("idx"))).alias("_own"))
    by_user = few.select("user_id", F.size("_own").cast("bigint").alias("_seen"), F.transform("_own", lambda idx, at: idx - at).alias("_gaps"))
    if any_heavy:
        own = known.join(heavy, "user_id", "left_semi").join(numbered, "item_id").select("user_id", "idx").distinct()
        own = materialize(own, "seen")
        by_user = by_user.unionByName(own.groupBy("user_id").agg(F.count("*").alias("_seen")), allowMissingColumns=True)
    names = list(dict.fromkeys(["user_id", *key, *carry, "need"]))
    asked = requests.select(names).filter("user_id is not null").join(by_user, "user_id", "left")
    asked = asked.withColumn("_gaps", F.when(F.col("_seen").isNull(), F.array().cast("array<bigint>")).otherwise(F.col("_gaps")))
    asked = asked.withColumn("free", F.lit(numbered.count()) - F.coalesce("_seen", F.lit(0))).drop("_seen").filter("free > 0")
    draws = _draws(asked, key, seed, carry)
    found = draws.filter("idx is not null")
    if any_heavy:
        found = found.unionByName(_unseen_at(draws.filter("idx is null").drop("idx"), own, key))
    if attributes is not None:
        numbered = numbered.join(attributes, "item_id")
    return found.join(numbered, "idx").drop("idx", "place")


def item_attributes(interactions: DataFrame) -> DataFrame:
    """``item_idx`` and multi-hot genres per item, for :func:`negatives_per_positive`; store it where it is used more than once."""
    return entity_dim(interactions, "item_id", ["item_idx", "genres_multihot"])


def _sampled(
    train: DataFrame, requests: DataFrame, key: list[str], items: DataFrame, interactions: DataFrame, seed: int, with_ts: bool,
) -> DataFrame:
    """Training rows and drawn rows. What a draw takes of its user goes along with the request, what it takes of its item comes last."""
    carry = ["user_idx"]
    requests = requests.join(entity_dim(train, "user_id", carry), "user_id")
    if with_ts:
        requests = requests.join(last_seen(train).withColumnRenamed("last_ts", "ts"), "user_id")
        carry = [*carry, "ts"]
    items = items.select("item_id", "item_idx", "genres_multihot")
    draws = draw_unseen(requests, key, items, interactions, seed, carry, items).withColumn("rating_scaled", F.lit(0.0))
    columns = [*SAMPLED_COLUMNS, *carry[1:]]
    return train.select(columns).unionByName(draws.select(columns))


def negatives_per_positive(
    train: DataFrame, interactions: DataFrame, ratio: int = NEGATIVES, seed: int = SEED, with_ts: bool = False,
    items: DataFrame | None = None,
) -> DataFrame:
    """Training rows plus ``ratio`` unseen items per training row, rated 0.

    An item counts as unseen if the user has it in no split (``interactions`` is the union of the splits). ``train``
    is unique on (user, item). With ``with_ts`` negatives carry the user's last training time. ``items`` is a stored
    :func:`item_attributes`, if there is one.
    """
    items = item_attributes(interactions) if items is None else items
    requests = train.select("user_id", F.col("item_id").alias("positive"), F.lit(ratio).alias("need"))
    return _sampled(train, requests, ["user_id", "positive"], items, interactions, seed, with_ts)


def negatives_per_user(
    train: DataFrame, interactions: DataFrame, n: int, seed: int = SEED, items: DataFrame | None = None,
) -> DataFrame:
    """Training rows plus ``n`` unseen items per user, rated 0 and stamped with the user's last training time."""
    items = item_attributes(interactions) if items is None else items
    requests = train.select("user_id").distinct().withColumn("need", F.lit(n))
    return _sampled(train, requests, ["user_id"], items, interactions, seed, with_ts=True)


def test_positives(test: DataFrame, stars: float = QUALITY_STARS) -> DataFrame:
    """Evaluation targets: test rows rated at least ``stars``."""
    return test.filter(F.col("rating_scaled") >= from_stars(stars))


def decoys(
    targets: DataFrame, interactions: DataFrame, embedded: DataFrame, n: int = DECOYS, seed: int = SEED,
    bad_stars: float = BAD_STARS, min_decoys: int = MIN_DECOYS,
) -> DataFrame:
    """Items to rank each target against: badly rated ones that the user has not seen, ``n`` per target.

    Where a user has fewer such items, other unseen items fill up. Targets and decoys without vectors are left out
    (``embedded`` holds the item ids that have them), then targets with fewer than ``min_decoys`` decoys. Returns
    ``(user_id, target, item_id)``.
    """
    bad = interactions.filter(F.col("rating_scaled") <= from_stars(bad_stars)).select("item_id").distinct()
    key = ["user_id", "target"]
    asked = targets.join(embedded, "item_id", "left_semi").select("user_id", F.col("item_id").alias("target"))
    asked = asked.withColumn("need", F.lit(n))
    drawn = materialize(draw_unseen(asked, key, bad, interactions, seed).select(*key, "item_id"), "decoys")
    got = drawn.groupBy(*key).agg(F.count("*").alias("_got"))
    left = F.col("need") - F.coalesce("_got", F.lit(0))
    short = asked.join(got, key, "left").withColumn("need", left).drop("_got").filter("need > 0")
    short = materialize(short, "short-targets")
    if not short.isEmpty():
        others = unseen_items(interactions.select("item_id").distinct(), bad)
        drawn = drawn.unionByName(draw_unseen(short, key, others, interactions, seed + 1).select(*key, "item_id"))
    usable = drawn.join(embedded, "item_id", "left_semi").select(*key, "item_id")
    count = F.count("*").over(Window.partitionBy(*key))
    return usable.withColumn("_count", count).filter(F.col("_count") >= min_decoys).drop("_count")
