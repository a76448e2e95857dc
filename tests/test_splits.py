from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reclake.contracts import RATINGS
from reclake.operators import encoders as F_
from reclake.operators import splits as W
from reclake.operators.positions import group_positions, group_quantiles, running
from reclake.workloads.tables import Tables
from tests.conftest import rows

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def interactions(spark):
    """One user with a third of all rows, many with a few."""
    draw = random.Random(5)
    data = [(0, item, float(item % 9), draw.randrange(50)) for item in range(400)]
    data += [(user, item, float(item % 9), draw.randrange(50)) for user in range(1, 41) for item in draw.sample(range(400), draw.randrange(1, 40))]
    return spark.createDataFrame(data, RATINGS).repartition(8).persist()


def expected_split(data):
    users, out = {}, {}
    for row in data:
        users.setdefault(row["user_id"], []).append((row["ts"], row["item_id"]))
    for user, items in users.items():
        for place, (_, item) in enumerate(sorted(items), 1):
            share = place / len(items)
            out[user, item] = "train" if share <= 0.8 else "val" if share <= 0.8 + 0.1 else "test"
    return out


@pytest.fixture(params=["many blocks", "few blocks"])
def blocks(request, spark):
    """Small partitions are merged by adaptive execution, unless it is told not to."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, str(request.param == "few blocks").lower())
    yield
    spark.conf.unset(name)


def test_temporal_split_is_the_same_for_any_blocks(interactions, blocks):
    split = W.temporal_split(interactions)
    found = {(row["user_id"], row["item_id"]): row["split"] for row in split.collect()}
    assert found == expected_split(interactions.collect())
    assert split.columns == [*RATINGS.fieldNames(), "split"]


def test_positions_of_one_group(spark, blocks):
    df = spark.range(3000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 3001).alias("x")).repartition(5)
    ranked = group_positions(df, ["g"], ["x"], "place")
    values = sorted(row["x"] for row in df.collect())
    assert {row["x"]: row["place"] for row in ranked.collect()} == {x: at for at, x in enumerate(values, 1)}


def test_group_positions_with_sizes(interactions, blocks):
    placed = group_positions(interactions, ["user_id"], ["ts", "item_id"], "place", "size")
    counts = Counter(row["user_id"] for row in interactions.collect())
    assert all(row["size"] == counts[row["user_id"]] and 1 <= row["place"] <= row["size"] for row in placed.collect())
    assert placed.select("user_id", "place").distinct().count() == placed.count() == interactions.count()


@pytest.mark.parametrize("few, blocked", [(0, 1), (40, 1), (400, 0)])
def test_small_groups_are_placed_without_blocks(spark, interactions, monkeypatch, few, blocked):
    """All users in blocks, only the one with many rows, nobody; rows without a group are left out either way."""
    from reclake.operators import positions

    written, materialize = [], positions.materialize
    monkeypatch.setattr(positions, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    df = interactions.unionByName(interactions.limit(5).withColumn("user_id", F.lit(None).cast("long")))
    placed = group_positions(df, ["user_id"], ["ts", "item_id"], "place", "size", few)
    assert placed.columns == ["user_id", *[name for name in interactions.columns if name != "user_id"], "place", "size"]
    users = {}
    for row in interactions.collect():
        users.setdefault(row["user_id"], []).append((row["ts"], row["item_id"]))
    expected = {(user, item): (at, len(items)) for user, items in users.items() for at, (_, item) in enumerate(sorted(items), 1)}
    assert {(row["user_id"], row["item_id"]): (row["place"], row["size"]) for row in placed.collect()} == expected
    assert placed.count() == len(expected) and written.count("blocks") == blocked


@pytest.mark.parametrize("how", ["min", "max", "sum", "last"])
def test_running_values_of_a_large_group(spark, how, blocks):
    draw = random.Random(2)
    data = [(0, at, draw.choice([None, *range(50)])) for at in range(900)] + [(user, at, draw.randrange(9)) for user in range(1, 9) for at in range(7)]
    df = spark.createDataFrame(data, "g int, at int, x int").repartition(6)
    fold = {"min": min, "max": max, "sum": sum, "last": lambda seen: seen[-1]}[how]
    expected = {}
    for group in range(9):
        seen = []
        for _, at, x in (row for row in data if row[0] == group):
            known = seen if how == "last" else [value for value in seen if value is not None]
            expected[group, at] = fold(known) if known else None
            seen.append(x)
    found = running(df, ["g"], "at", "x", how, "before")
    assert {(row["g"], row["at"]): row["before"] for row in found.collect()} == expected


def test_quantiles(interactions):
    found = {row["user_id"]: row["mid"] for row in group_quantiles(interactions, ["user_id"], "ts", {"mid": 0.5}).collect()}
    pdf = interactions.toPandas()
    assert found == pytest.approx(pdf.groupby("user_id")["ts"].median().to_dict())


def brute_core(pairs, min_user, min_item, rounds):
    for number in range(1, rounds + 1):
        size = len(pairs)
        users = Counter(user for user, _ in pairs)
        pairs = [pair for pair in pairs if users[pair[0]] >= min_user]
        items = Counter(item for _, item in pairs)
        pairs = [pair for pair in pairs if items[pair[1]] >= min_item]
        if len(pairs) == size:
            return set(pairs), number, True
    return set(pairs), rounds, False


@pytest.mark.parametrize(("min_user", "min_item", "rounds"), [(5, 2, 5), (10, 4, 5), (12, 5, 2), (60, 60, 5)])
def test_kcore_against_brute_force(interactions, min_user, min_item, rounds):
    pairs = [(row["user_id"], row["item_id"]) for row in interactions.collect()]
    expected, number, converged = brute_core(pairs, min_user, min_item, rounds)
    core = W.kcore(interactions, min_user, min_item, rounds)
    clean = {(row["user_id"], row["item_id"]) for row in core.clean.collect()}
    dropped = {(row["user_id"], row["item_id"]) for row in core.discarded.collect()}
    assert clean == expected and clean | dropped == set(pairs) and not clean & dropped
    assert (core.rounds, core.converged) == (number, converged)


@pytest.mark.parametrize(("min_user", "min_item", "left", "rounds", "converged"), [
    (20, 10, 57_877, 2, True), (20, 22, 54_299, 4, True), (25, 24, 0, None, None),
])
def test_kcore_on_the_tables(spark, min_user, min_item, left, rounds, converged):
    core = W.kcore(Tables(spark, SMALL).stored(), min_user, min_item, 20 if left == 0 else 5)
    assert core.clean.count() == left
    if rounds:
        assert (core.rounds, core.converged) == (rounds, converged)


def test_kcore_stops_at_the_last_round(spark):
    core = W.kcore(Tables(spark, SMALL).stored(), 20, 25)
    assert (core.rounds, core.converged) == (5, False)


def test_noise_filter(interactions):
    clean, dropped = W.filter_noise(interactions, 8, 3)
    pairs = [(row["user_id"], row["item_id"]) for row in interactions.collect()]
    expected, _, _ = brute_core(pairs, 8, 3, 1)
    assert {(row["user_id"], row["item_id"]) for row in clean.collect()} == expected
    assert clean.count() + dropped.count() == len(pairs)
    counts = W.noise_counts(interactions, 8, 3).first()
    assert counts["clean"] == len(expected) and sum(counts) == len(pairs)
    assert W.filter_noise(interactions.filter("false"))[0].count() == 0


def test_minmax_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "rating double")
    assert rows(F_.minmax_scale(df)) == [(2.0, None), (2.0, None)]


@pytest.mark.parametrize("values", [[9, 3, 3, 7], ["b", "a", "ä", "B", None], []])
def test_labels_follow_the_sorted_values(spark, values):
    kind = "long" if values and isinstance(values[0], int) else "string"
    df = spark.createDataFrame([(value,) for value in values], f"v {kind}")
    known = sorted({value for value in values if value is not None})
    assert rows(F_.fit_labels(df, "v")) == sorted([(value, at) for at, value in enumerate(known)], key=str)


def test_many_labels_over_many_ranges(spark):
    labels = F_.fit_labels(spark.range(20_000).select((F.col("id") * 37 % 20_011).alias("v")).repartition(7), "v")
    found = [row["value"] for row in labels.orderBy("idx").collect()]
    assert found == sorted(found) and [row["idx"] for row in labels.orderBy("idx").collect()] == list(range(20_000))


def test_features_and_universe(spark):
    ratings = spark.createDataFrame([(7, 3, 1.0, 1), (5, 9, 5.0, 2), (7, 9, 3.0, 3)], RATINGS)
    movies = spark.createDataFrame([(3, ["War", "Drama"])], "item_id long, genres array<string>")
    features, encoders = F_.build_features(ratings, movies)
    found = rows(features.select("user_id", "item_id", "genres", "rating_scaled", "user_idx", "item_idx", "genres_multihot"))
    assert found == [
        (5, 9, "Desconocido", 1.0, 0, 1, [1, 0, 0]), (7, 3, "War|Drama", 0.0, 1, 0, [0, 1, 1]), (7, 9, "Desconocido", 0.5, 1, 1, [1, 0, 0]),
    ]
    assert rows(F_.universe(features)) == rows(F_.universe(features, encoders)) == [(2, 2, 3)]


def test_a_vocabulary_of_any_size(spark):
    texts = [("|".join(f"w{n:05d}" for n in range(at, at + 100)),) for at in range(0, 20_000, 100)] + [(None,), ("w00007|w19999|w00007",)]
    df = spark.createDataFrame(texts, "genres string")
    vocabulary = F_.fit_multihot(df)
    assert vocabulary.count() == 20_000
    found = F_.apply_word_indices(df, vocabulary)
    assert found.filter("genres = 'w00007|w19999|w00007'").first()["genre_idx"] == [7, 19_999]
    assert found.filter("genres is null").first()["genre_idx"] == [] and found.count() == len(texts)
    vector = F_.apply_multihot(df.filter("genres like 'w00007|%'"), vocabulary).first()["genres_multihot"]
    assert len(vector) == 20_000 and [i for i, bit in enumerate(vector) if bit] == [7, 19_999]


def test_feature_splits_need_no_features_of_other_rows(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    parts = tables.feature_splits()
    assert "features" not in tables.derived
    features, _ = tables.features()
    whole = features.join(tables.split().select("user_id", "item_id", "split"), ["user_id", "item_id"])
    for name, part in W.by_split(whole).items():
        assert part.columns == parts[name].columns and rows(part) == rows(parts[name])
    cold = features.join(tables.marked().filter("not kept").select("user_id", "item_id"), ["user_id", "item_id"], "left_semi")
    assert rows(cold.select("user_id", "item_id", "rating_scaled", "user_idx")) == rows(tables.cold().select("user_id", "item_id", "rating_scaled", "user_idx"))


def test_feature_splits_write_no_other_split_and_vectors_as_text(spark, monkeypatch):
    from dataclasses import replace

    from reclake.workloads import tables as T

    written, materialize = {}, T.materialize
    monkeypatch.setattr(T, "materialize", lambda df, label: written.setdefault(label, dict(df.dtypes)) and False or materialize(df, label))
    tables = Tables(spark, "/root/testdata/sf0.001")
    parts = tables.feature_splits()
    assert "split" not in written and written["splits"]["genres_multihot"] == "string"
    kinds = dict(parts["train"].dtypes)
    assert kinds["genres_multihot"] == "array<int>" and "split" not in kinds
    present = {row["item_id"] for row in tables.item_attributes().collect()}
    assert "split" not in written and present == {row["item_id"] for row in tables.split().select("item_id").collect()}
    # an item without any place in its vector, as with an empty vocabulary
    fit = tables.feature_fit()
    bare = Tables(spark, "no folder")
    bare.derived = {"split": tables.split(), "feature_fit": replace(fit, items=fit.items.withColumn("genres_multihot", F.array().cast("array<int>")))}
    assert {len(row["genres_multihot"]) for row in bare.described_split().select("genres_multihot").collect()} == {0}


def test_the_split_has_each_interaction_once_though_items_are_described_twice(spark):
    from dataclasses import replace

    given = Tables(spark, "/root/testdata/sf0.001")
    fit, marked = given.feature_fit(), given.marked()
    tables = Tables(spark, "no folder")
    tables.derived = {"marked": marked, "feature_fit": replace(fit, items=fit.items.unionByName(fit.items))}
    clean = marked.filter("kept").count()
    assert tables.described_split().count() == 2 * clean and tables.split().count() == clean
    assert tables.item_attributes().count() == tables.split().select("item_id").distinct().count()
