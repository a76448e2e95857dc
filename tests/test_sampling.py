from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reclake.operators import sampling as N

SCHEMA = "user_id long, item_id long, ts long, user_idx long, item_idx long, genres_multihot array<int>, rating_scaled double"


def frame(spark, histories, rating=lambda user, item: 0.1 + (user + item) % 9 / 10):
    data = [
        (user, item, user * 100 + at, user + 1, item + 2, [item % 2, 1], float(rating(user, item)))
        for user, items in histories.items() for at, item in enumerate(items)
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def histories():
    """A user who has seen nearly everything, one who has seen all, one with half, and light users."""
    draw = random.Random(3)
    pool = list(range(60))
    given = {0: pool[:57], 1: pool, 2: draw.sample(pool, 30), 3: draw.sample(pool, 31)}
    given.update({user: draw.sample(pool, draw.randrange(1, 12)) for user in range(4, 20)})
    return given


def drawn_by(df, key):
    found = defaultdict(list)
    for row in df.collect():
        found[tuple(row[name] for name in key)].append(row["item_id"])
    return found


@pytest.mark.parametrize("size", [1, 4, 25, 100])
def test_draws_are_exact(spark, histories, size):
    everything = frame(spark, histories)
    requests = everything.select("user_id", F.col("item_id").alias("positive"), F.lit(size).alias("need"))
    found = drawn_by(
        N.draw_unseen(requests, ["user_id", "positive"], everything, everything, 7), ["user_id", "positive"]
    )
    for user, items in histories.items():
        unseen = set(range(60)) - set(items)
        for item in items:
            draws = found.get((user, item), [])
            assert len(draws) == len(set(draws)) == min(size, len(unseen)) and set(draws) <= unseen


def test_draws_reach_every_item_about_evenly(spark):
    everything = frame(spark, {user: [user % 40, (user + 1) % 40] for user in range(2000)})
    requests = everything.select("user_id", F.col("item_id").alias("positive"), F.lit(2).alias("need"))
    draws = N.draw_unseen(requests, ["user_id", "positive"], everything, everything, 7)
    counts = [row["count"] for row in draws.groupBy("item_id").count().collect()]
    assert len(counts) == 40 and min(counts) > 120 and max(counts) < 280


@pytest.mark.parametrize("chunk, walk", [(4096, 3), (3, 0)])
def test_draws_are_the_same_in_chunks_and_without_a_head_start(spark, histories, monkeypatch, chunk, walk):
    monkeypatch.setattr(N, "_CHUNK", chunk)
    monkeypatch.setattr(N, "_WALK", walk)
    everything = frame(spark, histories)
    requests = everything.select("user_id").distinct().withColumn("need", F.lit(40))
    found = drawn_by(N.draw_unseen(requests, ["user_id"], everything, everything, 7).orderBy("user_id", "draw"), ["user_id"])
    for user, items in histories.items():
        unseen = sorted(set(range(60)) - set(items))
        assert found.get((user,), []) == [unseen[at] for at in _order(len(unseen), 7, user)[:40]]


def test_draws_of_users_with_few_seen_items_are_not_sorted(spark, histories, monkeypatch):
    everything = frame(spark, histories)
    requests = everything.select("user_id").distinct().withColumn("need", F.lit(40))
    blocked, found = [], {}
    unseen_at = N._unseen_at
    monkeypatch.setattr(N, "_unseen_at", lambda draws, *rest: blocked.append({row["user_id"] for row in draws.collect()}) or unseen_at(draws, *rest))
    for light in (0, 20, 256):
        monkeypatch.setattr(N, "_LIGHT", light)
        drawn = N.draw_unseen(requests, ["user_id"], everything, everything, 7).orderBy("user_id", "draw")
        found[light] = drawn_by(drawn, ["user_id"])
    # all users, those who have seen more than twenty items and not all, nobody
    assert blocked == [set(histories) - {1}, {0, 2, 3}] and found[0] == found[20] == found[256]


def _order(size, seed, user):
    """All places 0 .. size - 1 in the order of the permutation, by plain arithmetic."""
    prime = 2**31 - 1
    digests = [hashlib.md5(f"{number}|{seed}|{user}".encode()).hexdigest() for number in (0, 1)]
    keys = [int(digest[at:at + 8], 16) % prime for digest in digests for at in range(0, 32, 8)]
    rows = math.ceil(math.sqrt(size))
    cols = math.ceil(size / rows) if size else 0
    places = []
    for start in range(size):
        place = start
        while True:
            halves = list(divmod(place, cols))
            for step in range(4):
                hashed = (halves[1 - step % 2] + keys[2 * step]) % prime * (keys[2 * step + 1] % (prime - 1) + 1) % prime
                halves[step % 2] = (halves[step % 2] + hashed) % (rows, cols)[step % 2]
            place = halves[0] * cols + halves[1]
            if place < size:
                break
        places.append(place)
    return places


def test_orders_of_a_small_pool_are_about_equally_likely(spark):
    pool = spark.range(4).toDF("item_id")
    requests = spark.range(4800).select(F.col("id").alias("user_id"), F.lit(4).alias("need"))
    nothing = spark.createDataFrame([], "user_id long, item_id long")
    found = drawn_by(N.draw_unseen(requests, ["user_id"], pool, nothing, 7).orderBy("user_id", "draw"), ["user_id"])
    counts = Counter(tuple(draws) for draws in found.values())
    assert len(counts) == 24 and min(counts.values()) > 100 and max(counts.values()) < 330


def test_an_empty_pool_gives_no_draws(spark, histories):
    everything = frame(spark, histories)
    requests = everything.select("user_id", F.lit(1).alias("need")).distinct()
    assert N.draw_unseen(requests, ["user_id"], everything.filter("false"), everything, 7).count() == 0


def test_negatives_per_positive(spark, histories):
    everything = frame(spark, histories)
    train = everything.filter("item_id < 30")
    sampled = N.negatives_per_positive(train, everything, 4, with_ts=True)
    assert sampled.columns == [*N.SAMPLED_COLUMNS, "ts"]
    negatives = [row for row in sampled.collect() if row["rating_scaled"] == 0.0]
    positives = train.count()
    assert sampled.count() - len(negatives) == positives
    expected = sum(
        min(4, 60 - len(items)) * sum(item < 30 for item in items) for items in histories.values()
    )
    assert len(negatives) == expected
    last = {user: max(user * 100 + at for at, item in enumerate(items) if item < 30) for user, items in histories.items() if any(i < 30 for i in items)}
    for row in negatives:
        assert row["item_id"] not in histories[row["user_id"]] and row["ts"] == last[row["user_id"]]
        assert (row["user_idx"], row["item_idx"], row["genres_multihot"]) == (row["user_id"] + 1, row["item_id"] + 2, [row["item_id"] % 2, 1])


def test_negatives_per_user(spark, histories):
    everything = frame(spark, histories)
    sampled = N.negatives_per_user(everything, everything, 10)
    found = drawn_by(sampled.filter("rating_scaled = 0"), ["user_id"])
    for user, items in histories.items():
        draws = found.get((user,), [])
        assert len(draws) == len(set(draws)) == min(10, 60 - len(items)) and not set(draws) & set(items)


def test_decoys_fill_up_from_the_other_items(spark):
    # Items 0..7 are bad for everyone, the rest is good.
    histories = {user: [user % 8, 10 + user, 40 - user] for user in range(12)}
    histories[50] = list(range(8, 41))
    everything = frame(spark, histories, lambda user, item: 0.2 if item < 8 else 0.9)
    targets = N.test_positives(everything.filter("user_id < 12"))
    embedded = spark.range(1, 41).select(F.col("id").alias("item_id"))
    found = drawn_by(N.decoys(targets, everything, embedded, n=20), ["user_id", "target"])
    assert found
    for (user, target), draws in found.items():
        seen = set(histories[user])
        bad = set(range(8)) - seen
        assert target in seen and 10 <= len(set(draws)) == len(draws) <= 20
        assert not set(draws) & seen and bad - {0} <= set(draws)
        assert len(draws) >= 20 - 1  # only item 0 lacks a vector
    few = N.decoys(targets, everything, spark.range(1, 9).select(F.col("id").alias("item_id")), n=20)
    assert few.count() == 0


def test_shuffle_depends_on_the_seed_only(spark):
    df = spark.range(200)
    one = [row["id"] for row in N.shuffle(df, 1, ["id"]).collect()]
    assert one == [row["id"] for row in N.shuffle(df.repartition(7), 1, ["id"]).collect()]
    assert one != [row["id"] for row in N.shuffle(df, 2, ["id"]).collect()] and sorted(one) == list(range(200))


def test_unseen_items(spark):
    pool, seen = spark.range(5).toDF("item_id"), spark.range(3).toDF("item_id")
    assert sorted(row["item_id"] for row in N.unseen_items(pool, seen).collect()) == [3, 4]


def test_a_draw_works_out_few_steps_at_once(spark, histories, monkeypatch):
    everything, taken, written = frame(spark, histories), [], {}
    requests = everything.select("user_id").distinct().withColumn("need", F.lit(40))
    permute, materialize = N.permute, N.materialize
    monkeypatch.setattr(N, "permute", lambda *given: taken.append(1) or permute(*given))
    monkeypatch.setattr(N, "materialize", lambda df, label: written.setdefault(label, len(taken)) and False or materialize(df, label))
    N.draw_unseen(requests, ["user_id"], everything, everything, 7)
    # with four steps in one go, the generated code was too large to be compiled
    assert written["draws"] == 2


def test_attributes_of_the_items_of_the_splits(spark):
    from types import SimpleNamespace

    from reclake.workloads.tables import Tables

    items = spark.createDataFrame([(5, 0, [0, 1]), (6, 1, [1, 1]), (7, 2, [1, 0])], "item_id long, item_idx long, genres_multihot array<int>")
    split = spark.createDataFrame([(1, 7, "train"), (2, 7, "val"), (1, 5, "test"), (2, None, "train")], "user_id long, item_id long, split string")
    tables = Tables(spark, "no folder")
    # the vectors of the feature rows are not read: there are none here
    tables.derived = {"split": split, "feature_fit": SimpleNamespace(items=items)}
    assert sorted(tuple(row) for row in tables.item_attributes().collect()) == [(5, 0, [0, 1]), (7, 2, [1, 0])]


def test_seen_items_of_users_with_few_rows_are_not_written_first(spark, histories, monkeypatch):
    given = {user: items for user, items in histories.items() if len(items) < 57}
    everything, written = frame(spark, given), []
    twice = everything.unionByName(everything).unionByName(everything.limit(3).withColumn("user_id", F.lit(None).cast("long")))
    requests = everything.select("user_id").distinct().withColumn("need", F.lit(40))
    materialize = N.materialize
    monkeypatch.setattr(N, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    pool = spark.range(60).toDF("item_id")
    found = drawn_by(N.draw_unseen(requests, ["user_id"], pool, twice, 7).orderBy("user_id", "draw"), ["user_id"])
    for user, items in given.items():
        unseen = sorted(set(range(60)) - set(items))
        assert found[(user,)] == [unseen[at] for at in _order(len(unseen), 7, user)[:40]]
    assert "seen" not in written


def test_a_draw_moves_once_to_its_item(spark, histories, monkeypatch):
    everything, written, materialize = frame(spark, histories), {}, N.materialize

    def kept(df, label):
        written[label] = materialize(df, label)
        return written[label]

    monkeypatch.setattr(N, "materialize", kept)
    items = materialize(N.item_attributes(everything), "items")
    for with_ts in (False, True):
        sampled = N.negatives_per_positive(everything, everything, 2, with_ts=with_ts, items=items)
        # draws and numbers, numbers and attributes; what a draw takes of its user came along with the request
        assert sampled._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2
        assert "user_idx" in written["draws"].columns and ("ts" in written["draws"].columns) == with_ts
    assert written["draws"].filter("idx is not null and free is null and place is not null").isEmpty()
    per_user = N.negatives_per_user(everything, everything, 3, items=items)
    newest = {user: user * 100 + len(items) - 1 for user, items in histories.items()}
    drawn = [row for row in per_user.collect() if row["rating_scaled"] == 0]
    assert drawn and all(
        (row["user_idx"], row["item_idx"], row["genres_multihot"], row["ts"])
        == (row["user_id"] + 1, row["item_id"] + 2, [row["item_id"] % 2, 1], newest[row["user_id"]]) for row in drawn)
