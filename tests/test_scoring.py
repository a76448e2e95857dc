from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reclake.operators import embeddings as M
from reclake.operators import itemindex as I
from reclake.operators import models
from reclake.operators import scoring as S
from reclake.operators.selection import leaderboard
from reclake.workloads.scoring import rule_layer, rule_weights


def dense(x, layer):
    y = (x @ layer["weight"].T + layer["bias"] - layer["mean"]) / np.sqrt(layer["var"] + 1e-5)
    return np.maximum(y * layer["gamma"] + layer["beta"], 0)


@pytest.fixture(scope="module")
def draw():
    return np.random.default_rng(4)


def test_gmf_and_hybrid(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 0.5])], "user_vector array<double>, item_vector array<float>")
    found = S.gmf_score(df, [0.2, -1.0], 0.1).first()["score"]
    assert found == pytest.approx(1 / (1 + math.exp(-(0.6 - 1.0 + 0.1))))
    pair = spark.createDataFrame([(0.5, 0.25)], "p_inter double, p_rating double")
    assert S.hybrid_score(pair).first()["hybrid_score"] == 0.125


def test_attention_is_a_stable_softmax(spark):
    df = spark.createDataFrame([([1.0], [800.0], [801.0])], "cat_vec array<double>, text_vec array<double>, img_vec array<double>")
    scorers = {name: ([1.0], 0.0) for name in ("cat_vec", "text_vec", "img_vec")}
    found = S.modality_attention(df, scorers).first()
    share = 1 / (1 + math.e)
    assert found["weights"] == pytest.approx([0.0, share, 1 - share])
    assert found["text_vec_weighted"] == pytest.approx([800 * share])


def test_user_tower(spark, draw):
    vectors = draw.normal(size=(50, 6))
    df = spark.createDataFrame([(at, list(map(float, row))) for at, row in enumerate(vectors)], "user_id long, emb array<double>").repartition(4)
    layer = rule_layer(3, 6, 1)
    found = {row["user_id"]: row["user_vector"] for row in S.score_user_tower(df, layer).collect()}
    expected = dense(vectors, layer)
    assert len(found) == 50 and all(found[at] == pytest.approx(list(expected[at])) for at in found)


def test_item_tower_and_pairs(spark, draw):
    net = {
        "item": rule_layer(4, 5, 1), "category": rule_layer(4, 3, 2),
        "attention": {"category": (rule_weights(4, 3), 0.1), "text": (rule_weights(6, 4), 0.0), "image": (rule_weights(6, 5), 0.2)},
        "content": [rule_layer(7, 16, 6), rule_layer(5, 7, 7)], "final": rule_layer(4, 9, 8),
    }
    emb, text, image = draw.normal(size=(30, 5)), draw.normal(size=(30, 6)), draw.normal(size=(30, 6))
    genres = draw.integers(0, 2, size=(30, 3))
    data = [
        (at, at + 100, *[list(map(float, part[at])) for part in (emb,)], [int(x) for x in genres[at]], list(map(float, text[at])), list(map(float, image[at])))
        for at in range(30)
    ]
    items = spark.createDataFrame(data, "item_id long, item_idx long, emb array<double>, genres_multihot array<int>, text_emb array<double>, img_emb array<double>")
    scored = S.score_item_tower(items.repartition(3), net)
    found = {row["item_id"]: row for row in scored.collect()}
    cat = dense(genres.astype(float), net["category"])
    raw = np.column_stack([part @ np.array(net["attention"][name][0]) + net["attention"][name][1] for name, part in (("category", cat), ("text", text), ("image", image))])
    shares = np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)
    content = np.hstack([part * shares[:, [at]] for at, part in enumerate((cat, text, image))])
    for layer in net["content"]:
        content = dense(content, layer)
    final = dense(np.hstack([dense(emb, net["item"]), content]), net["final"])
    for at in range(30):
        assert found[at]["item_idx"] == at + 100
        assert found[at]["weights"] == pytest.approx(list(shares[at])) and found[at]["item_vector"] == pytest.approx(list(final[at]))

    users = spark.createDataFrame([(1, [1.0, 0.5, 0.0, 2.0])], "user_id long, user_vector array<double>")
    pairs = spark.createDataFrame([(1, 3), (1, 4), (1, 99)], "user_id long, item_id long")
    head = ([0.1, 0.2, 0.3, 0.4], 0.05)
    plain = S.score_pairs(pairs, users, scored, head)
    assert "p_inter" not in plain.columns and plain.count() == 3
    # item 99 has no vector: the score of a zero vector, and no attention
    unknown = plain.filter("item_id = 99").first()
    assert unknown["p_rating"] == pytest.approx(1 / (1 + math.exp(-0.05))) and unknown["attention_weights"] is None
    best = pairs.withColumn("rank", F.lit(1))
    table = S.recommendations(best, users, scored, head, head)
    assert table.columns == ["user_id", "item_id", "rank", "stars", "attention_weights", "hybrid_score"] and table.count() == 3
    row = S.score_pairs(pairs, users, scored, head, head).filter("item_id = 3").first()
    value = 1 / (1 + math.exp(-(np.array([1.0, 0.5, 0.0, 2.0]) * final[3] @ np.array(head[0]) + 0.05)))
    assert row["p_rating"] == pytest.approx(value) and row["stars"] == pytest.approx(value * 4 + 1)
    assert row["hybrid_score"] == pytest.approx(value * value)
    assert json.loads(row["attention_weights"])["text"] == pytest.approx(shares[3][1])
    shown = S.explain(plain, 1, 4).first()
    assert shown["image_pct"] == pytest.approx(shares[4][2] * 100)


@pytest.mark.parametrize("block", [7, 1000])
def test_top_k_search_against_brute_force(spark, draw, block):
    users, items = draw.integers(-3, 4, size=(25, 4)), draw.integers(-3, 4, size=(40, 4))
    seen = {(user, int(item)) for user in range(25) for item in draw.choice(40, size=user)} | {(24, item) for item in range(38)}
    as_rows = lambda part: [(at, [float(x) for x in row]) for at, row in enumerate(part)]
    found = S.recommend_top_k(
        spark.createDataFrame(as_rows(users), "user_id long, vector array<double>"),
        spark.createDataFrame(as_rows(items), "item_id long, vector array<double>"),
        spark.createDataFrame(sorted(seen), "user_id long, item_id long"), 5, block,
    )
    best = {}
    for row in found.collect():
        best.setdefault(row["user_id"], {})[row["rank"]] = (row["item_id"], row["score"])
    scores = users @ items.T
    for user in range(25):
        order = sorted((item for item in range(40) if (user, item) not in seen), key=lambda i: (-scores[user, i], i))[:5]
        assert [best[user][rank + 1] for rank in range(len(order))] == [(item, float(scores[user, item])) for item in order]


def test_text_vectors(spark):
    df = spark.createDataFrame([(1, "red ring red"), (2, "red widget"), (3, None), (4, "red")], "item_id long, text string")
    found = {row["item_id"]: np.array(row["text_emb"]) for row in M.embed_text(df, dim=512).collect()}
    assert all(len(vector) == 512 for vector in found.values()) and not found[3].any()
    assert np.linalg.norm(found[1]) == pytest.approx(1, abs=1e-6)
    tf, idf = {"red": 2, "ring": 1}, {"red": math.log(5 / 4), "ring": math.log(5 / 2)}
    weights = {word: tf[word] * idf[word] for word in tf}
    norm = math.sqrt(sum(value * value for value in weights.values()))
    assert sorted(abs(x) for x in found[1] if x) == pytest.approx(sorted(value / norm for value in weights.values()), abs=1e-5)
    digest = hashlib.md5(b"ring").hexdigest()
    assert found[1][int(digest[:8], 16) % 512] * (1 if digest[8] <= "7" else -1) > 0
    # every text holds the only term, or none does
    assert not np.array(M.embed_text(spark.createDataFrame([(1, "a"), (2, "A")], "item_id long, text string"), dim=4).first()["text_emb"]).any()
    assert M.embed_text(df.filter("false"), dim=4).count() == 0


@pytest.fixture(scope="module")
def cloud(draw):
    """Items of very different lengths, users that look their way."""
    centres = draw.normal(size=(12, 8))
    items = centres[draw.integers(0, 12, 600)] * draw.uniform(0.2, 3, (600, 1)) + draw.normal(size=(600, 8)) * 0.2
    users = centres[draw.integers(0, 12, 90)] + draw.normal(size=(90, 8)) * 0.3
    return users, items


@pytest.mark.parametrize("block", [20, 2048])
def test_item_index_against_the_exact_search(spark, cloud, block):
    users, items = cloud
    as_rows = lambda part: [(at, [float(x) for x in row]) for at, row in enumerate(part)]
    asked = spark.createDataFrame(as_rows(users), "user_id long, vector array<double>").repartition(3)
    known = spark.createDataFrame(as_rows(items), "item_id long, vector array<double>").repartition(3)
    seen = spark.createDataFrame([(user, item) for user in range(0, 90, 2) for item in range(user, 600, 7)], "user_id long, item_id long")
    index = I.fit_item_index(known, cells=25)
    assert index.items.count() == 600 and index.items.select("cell").distinct().count() > 10
    exact = S.recommend_top_k(asked, known, seen, 10)
    found = I.search_top_k(asked, index, seen, 10, probes=8, block=block)
    assert found.groupBy("user_id").count().filter("count <> 10").count() == 0
    assert found.join(seen, ["user_id", "item_id"], "left_semi").count() == 0
    scores = users @ items.T
    assert all(row["score"] == pytest.approx(scores[row["user_id"], row["item_id"]]) for row in found.collect())
    assert I.recall_at_k(found, exact).first()["recall"] > 0.9
    # all cells probed: the exact answer
    everything = I.search_top_k(asked, index, seen, 10, probes=25, block=block)
    picked = lambda df: sorted((row["user_id"], row["rank"], row["item_id"]) for row in df.collect())
    assert picked(everything) == picked(exact)


def test_item_index_moves_a_user_once_per_group_of_cells(spark, cloud):
    users, items = cloud
    as_rows = lambda part: [(at, [float(x) for x in row]) for at, row in enumerate(part)]
    asked = spark.createDataFrame(as_rows(users), "user_id long, vector array<double>")
    index = I.fit_item_index(spark.createDataFrame(as_rows(items), "item_id long, vector array<double>"), cells=25)
    none = spark.createDataFrame([], "user_id long, item_id long")
    found = I.search_top_k(asked, index, none, 10, probes=20, block=300)
    moved = found._jdf.queryExecution().toString()
    assert "cells" in moved and S.block_rows(100) == S.MIN_BLOCK and S.block_rows(60_000) == 10_000 and S.block_rows(10**7) == S.MAX_BLOCK
    small = I.search_top_k(asked, index, none, 10, probes=20, block=20)
    picked = lambda df: sorted((row["user_id"], row["rank"], row["item_id"]) for row in df.collect())
    assert picked(found) == picked(small)


def test_item_index_of_few_items(spark):
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0])], "item_id long, vector array<double>")
    users = spark.createDataFrame([(7, [2.0, 1.0])], "user_id long, vector array<double>")
    seen = spark.createDataFrame([(7, 2)], "user_id long, item_id long")
    found = I.search_top_k(users, I.fit_item_index(some), seen, 5, probes=9)
    assert [(row["item_id"], row["rank"]) for row in found.orderBy("rank").collect()] == [(1, 1), (3, 2)]
    assert I.search_top_k(users, I.fit_item_index(some.filter("false")), seen, 5).count() == 0


def test_item_index_makes_no_pairs_of_all(spark, cloud):
    users, items = cloud
    as_rows = lambda part: [(at, [float(x) for x in row]) for at, row in enumerate(part)]
    asked = spark.createDataFrame(as_rows(users), "user_id long, vector array<double>")
    index = I.fit_item_index(spark.createDataFrame(as_rows(items), "item_id long, vector array<double>"), cells=25)
    plan = I.search_top_k(asked, index, spark.createDataFrame([], "user_id long, item_id long"), 10, probes=3)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert I.probe(asked, index, 3).count() == 90 * 3


def test_assembled_vectors(spark):
    text = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "item_id long, text_emb array<float>")
    images = spark.createDataFrame([(2, [5.0])], "item_id long, img_emb array<float>")
    both = M.assemble_embeddings(text, images, 1)
    assert {row["item_id"]: row["img_emb"] for row in both.collect()} == {1: [0.0], 2: [5.0]}
    assert tuple(M.embedding_counts(both).first()) == (1, 1)


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings that follow one hidden factor per user and item."""
    draw = np.random.default_rng(8)
    u, v = draw.uniform(0.3, 1, 40), draw.uniform(0.3, 1, 30)
    data = [(a, b, float(u[a] * v[b])) for a in range(40) for b in range(30) if draw.random() < 0.6]
    return spark.createDataFrame(data, "user_idx long, item_idx long, rating_scaled double").persist()


def test_rating_model_finds_the_factors(planted, spark):
    train, val = planted.randomSplit([0.8, 0.2], 3)
    model = models.fit_rating_model(train, rank=4, reg=0.01)
    scored = models.predict_ratings(model, val, 0.5)
    error = scored.select(F.sqrt(F.avg(F.pow(F.col("p_rating") - F.col("rating_scaled"), 2)))).first()[0]
    assert error < 0.06 and scored.count() == val.count()
    cold = spark.createDataFrame([(999, 1)], "user_idx long, item_idx long")
    assert models.predict_ratings(model, cold, 0.5).first()["p_rating"] == 0.5


def test_search_by_successive_halving(planted, spark):
    train, val = planted.randomSplit([0.8, 0.2], 3)
    trials = models.tune(train, val, [2, 4, 5], [0.01, 5.0], iterations=8, parallel=3)
    by_rung = {rung: [row for row in trials.collect() if row["rung"] == rung] for rung in range(3)}
    assert [len(by_rung[rung]) for rung in range(3)] == [6, 2, 1] and [by_rung[rung][0]["iterations"] for rung in range(3)] == [2, 4, 8]
    for rung in range(2):
        stayed = {row["trial"] for row in by_rung[rung] if row["survived"]}
        assert stayed == {row["trial"] for row in by_rung[rung + 1]}
        assert max(row["objective"] for row in by_rung[rung] if row["survived"]) <= min(row["objective"] for row in by_rung[rung] if not row["survived"])
    assert leaderboard(trials.filter("rung = 2"), "objective", ["rank", "reg"], ["trial"]).first()["reg"] == 0.01
    assert [(row["trial"], row["rank"], row["reg"]) for row in sorted(by_rung[0], key=lambda row: row["trial"])][:3] == [(1, 2, 0.01), (2, 2, 5.0), (3, 4, 0.01)]


def test_folded_in_factors_solve_the_normal_equations(planted, spark):
    known = planted.filter("user_idx < 30 and item_idx < 25")
    model = models.fit_rating_model(known, rank=3, reg=0.01)
    later = planted.filter("(user_idx < 30) <> (item_idx < 25)")
    users, items = models.complete_factors(model, later, 0.01)
    assert users.count() == 40 and items.count() == 30
    factors = {row["id"]: np.array(row["features"]) for row in model.itemFactors.collect()}
    found = {row["id"]: np.array(row["features"]) for row in users.collect()}
    for user in range(30, 40):
        own = [(factors[row["item_idx"]], row["rating_scaled"]) for row in later.filter(F.col("user_idx") == user).collect() if row["item_idx"] in factors]
        left = sum(np.outer(v, v) for v, _ in own) + 0.01 * len(own) * np.eye(3)
        assert found[user] == pytest.approx(np.linalg.solve(left, sum(v * r for v, r in own)), abs=1e-4)
    # users and items that neither fit knew: folded-in factors predict them
    both = planted.filter("user_idx >= 30 and item_idx >= 25")
    scored = both.join(users.withColumnsRenamed({"id": "user_idx", "features": "u"}), "user_idx").join(
        items.withColumnsRenamed({"id": "item_idx", "features": "v"}), "item_idx")
    errors = [np.dot(row["u"], row["v"]) - row["rating_scaled"] for row in scored.collect()]
    assert len(errors) == both.count() and np.sqrt(np.mean(np.square(errors))) < 0.1
    assert models.fold_in(later.filter("false"), model.itemFactors, "user_idx", "item_idx").count() == 0


def test_two_heads_answer_every_pair(planted, spark):
    factors = models.fit_rating_model(planted, rank=3, reg=0.01)
    heads = models.fit_two_heads(planted.withColumn("rating_scaled", F.when(F.col("rating_scaled") > 0.4, F.col("rating_scaled")).otherwise(0.0)), factors)
    pairs = spark.createDataFrame([(1, 1), (999, 1), (1, 999), (999, 999)], "user_idx long, item_idx long")
    scored = {(row["user_idx"], row["item_idx"]): row for row in models.predict_two_heads(heads, pairs).collect()}
    assert len(scored) == 4
    base = 1 / (1 + math.exp(-heads.interaction.intercept))
    assert all(scored[key]["p_inter"] == pytest.approx(base) for key in scored if 999 in key)
    users = spark.createDataFrame([(999, [1.0, 1.0, 1.0])], "id long, features array<float>").unionByName(
        factors.userFactors.select(F.col("id").cast("long").alias("id"), "features"))
    folded = models.predict_two_heads(models.with_factors(heads, users, factors.itemFactors), pairs)
    answers = {(row["user_idx"], row["item_idx"]): row["p_inter"] for row in folded.collect()}
    assert answers[999, 1] != answers[999, 999] == pytest.approx(base)


def test_two_heads(planted):
    labelled = planted.withColumn("rating_scaled", F.when(F.col("rating_scaled") > 0.4, F.col("rating_scaled")).otherwise(0.0))
    factors = models.fit_rating_model(labelled, rank=6, reg=0.01)
    scored = models.predict_two_heads(models.fit_two_heads(labelled, factors), labelled)
    means = {row["hit"]: row["p"] for row in scored.groupBy((F.col("rating_scaled") > 0).alias("hit")).agg(F.avg("p_inter").alias("p")).collect()}
    assert means[True] > means[False] + 0.2
    low, high = scored.agg(F.min("p_rating"), F.max("p_rating")).first()
    assert 0 <= low <= high <= 1


def test_fit_sends_factors_to_few_blocks(spark, monkeypatch):
    given, als = [], models.ALS
    monkeypatch.setattr(models, "ALS", lambda **settings: given.append(settings) or als(**settings))
    train = spark.createDataFrame([(u, i, (u + i) % 3 / 2) for u in range(12) for i in range(5)], "user_idx int, item_idx int, rating_scaled double")
    models.fit_rating_model(train, rank=2, iterations=1)
    monkeypatch.setattr(models, "_BLOCK_RATINGS", 10)
    models.fit_rating_model(train, rank=2, iterations=1)
    assert [(each["numUserBlocks"], each["numItemBlocks"]) for each in given] == [(4, 4), (6, 6)]


def test_two_heads_join_factors_once(spark, monkeypatch):
    train = spark.createDataFrame([(u, i, (u + i) % 3 / 2) for u in range(12) for i in range(5)], "user_idx int, item_idx int, rating_scaled double")
    seen, products = [], models._products
    factors = models.fit_rating_model(train, rank=2, iterations=1)
    monkeypatch.setattr(models, "_products", lambda *given: seen.append(products(*given)) or seen[0])
    monkeypatch.setattr(models, "_as_vectors", lambda rows, plain=models._as_vectors: seen.append(rows) or plain(rows))
    models.fit_two_heads(train, factors, iterations=2)
    assert "Join" in seen[0]._jdf.queryExecution().toString() and "Join" not in seen[1]._jdf.queryExecution().toString()


def test_products_of_tiles_are_those_of_joins(spark):
    def rows(df):
        return sorted((str(row["rating_scaled"]), row["features"]) for row in df.collect())

    vectors = {"users": (0, 1, 2, 4), "items": (0, 1, 3)}
    users, items = (spark.createDataFrame([(i, [float((len(side) + i) * 3 + k) for k in range(3)]) for i in ids], "id int, features array<float>")
                    for side, ids in vectors.items())
    given = [(u, i, u + i / 10) for u in range(6) for i in range(5)] + [(None, 1, 7.0), (1, None, 8.0), (1, 1, 9.0), (1, 1, 9.0), (2, 3, None)]
    pairs = spark.createDataFrame(given, "user_idx bigint, item_idx bigint, rating_scaled double")
    joined = rows(models._products(pairs, users, items, 3).select("rating_scaled", "features"))
    for tile_rows in (100, 5, 1):
        tiled = models.tile_products(pairs, users, items, 3, tile_rows)
        assert rows(tiled) == joined and "Join" not in tiled._jdf.queryExecution().toString()


def test_two_heads_take_tiles_for_many_rows(planted, monkeypatch):
    labelled = planted.withColumn("rating_scaled", F.when(F.col("rating_scaled") > 0.4, F.col("rating_scaled")).otherwise(0.0))
    factors = models.fit_rating_model(labelled, rank=3, reg=0.01)
    plain = models.fit_two_heads(labelled, factors)
    monkeypatch.setattr(models, "_TILE_ROWS", 100)
    monkeypatch.setattr(models, "_products", None)
    tiled = models.fit_two_heads(labelled, factors)
    assert tiled.interaction.coefficients.toArray() == pytest.approx(plain.interaction.coefficients.toArray(), rel=1e-4, abs=1e-6)
    assert tiled.rating.coefficients.toArray() == pytest.approx(plain.rating.coefficients.toArray(), rel=1e-4, abs=1e-6)


def test_fits_side_by_side_take_two_blocks(spark, monkeypatch):
    given, als = [], models.ALS
    monkeypatch.setattr(models, "ALS", lambda **settings: given.append(settings) or als(**settings))
    train = spark.createDataFrame([(u, i, (u + i) % 3 / 2) for u in range(12) for i in range(5)], "user_idx int, item_idx int, rating_scaled double")
    models.tune(train, train, [2], [0.1], iterations=1)
    assert {(each["numUserBlocks"], each["numItemBlocks"]) for each in given} == {(2, 2)}


def test_two_heads_of_many_rows_store_no_products(planted, monkeypatch):
    labelled = planted.withColumn("rating_scaled", F.when(F.col("rating_scaled") > 0.4, F.col("rating_scaled")).otherwise(0.0))
    factors, stored, plain = models.fit_rating_model(labelled, rank=3, reg=0.01), [], models.materialize
    monkeypatch.setattr(models, "_TILE_ROWS", 100)
    monkeypatch.setattr(models, "LogisticRegression", None)  # it would keep a vector per row in its cache
    monkeypatch.setattr(models, "materialize", lambda df, label, **options: stored.append(plain(df, label, **options)) or stored[-1])
    heads = models.fit_two_heads(labelled, factors)
    assert len(stored) == 1 and set(stored[0].dtypes) == {(name, "binary") for name in ("_ratings", "_user_at", "_item_at", "_users", "_items")}
    pairs = [row["n"] for row in stored[0].select((F.length("_ratings") / 8).alias("n")).collect()]
    assert sum(pairs) == labelled.count() and max(pairs) <= 100
    assert {row["p_inter"] is not None for row in models.predict_two_heads(heads, labelled).collect()} == {True}


def test_packed_tiles_hold_the_products_of_joins(spark, monkeypatch):
    users = spark.createDataFrame([(i, [i + 0.5, 2.0]) for i in (0, 1, 2, 4)], "id int, features array<float>")
    items = spark.createDataFrame([(i, [3.0, i - 0.5]) for i in (0, 1, 3)], "id int, features array<float>")
    given = [(u, i, (u + i) % 3 / 2) for u in range(6) for i in range(5)] + [(None, 1, 1.0), (1, None, 0.5), (1, 1, 0.0), (1, 1, 0.0), (2, 3, None)]
    pairs = spark.createDataFrame(given, "user_idx bigint, item_idx bigint, rating_scaled double")
    rows = models._products(pairs, users, items, 2).select(F.coalesce("rating_scaled", F.lit(0.0)).alias("y"), "features").collect()
    x, y = np.hstack([np.ones((len(rows), 1)), [row["features"] for row in rows]]), np.array([row["y"] for row in rows])
    known, weights = np.hstack([x, y[:, None]])[y > 0], np.array([0.2, -0.1, 0.3])
    share = 1 / (1 + np.exp(-x @ weights))
    loss = -np.where(y > 0, np.log(share), np.log(1 - share)).sum()
    for tile_rows, chunk in ((100, 100), (4, 3), (1, 1)):
        monkeypatch.setattr(models, "_PASS_ROWS", chunk)
        tiles = models.pack_tiles(pairs, users, items, 2, tile_rows)
        for found, right in zip(models._tile_sums(tiles, 2, None), (x.T @ x, known.T @ known), strict=True):
            assert found == pytest.approx(right)
        wanted = (loss, x.T @ (share - (y > 0)), (x * (share * (1 - share))[:, None]).T @ x)
        for found, right in zip(models._tile_sums(tiles, 2, weights), wanted, strict=True):
            assert found == pytest.approx(right)


@pytest.mark.parametrize("alike", ["interaction", "rating"])
def test_two_heads_on_tiles_where_all_rows_are_alike(planted, monkeypatch, alike):
    rating = F.col("rating_scaled") if alike == "interaction" else F.when(F.col("rating_scaled") > 0.4, 1.0).otherwise(0.0)
    labelled = planted.withColumn("rating_scaled", rating)
    factors = models.fit_rating_model(labelled, rank=2, reg=0.01)
    plain = models.fit_two_heads(labelled, factors)
    monkeypatch.setattr(models, "_TILE_ROWS", 100)
    tiled = models.fit_two_heads(labelled, factors)
    for one, other in ((plain.interaction, tiled.interaction), (plain.rating, tiled.rating)):
        assert other.coefficients.toArray() == pytest.approx(one.coefficients.toArray(), rel=1e-4, abs=1e-6)
        assert other.intercept == pytest.approx(one.intercept, rel=1e-4)


def test_fits_side_by_side_leave_memory_to_their_tasks(spark, monkeypatch):
    given, als = [], models.ALS
    monkeypatch.setattr(models, "ALS", lambda **settings: given.append(settings) or als(**settings))
    monkeypatch.setattr(models, "_BLOCK_RATINGS", 20)
    train = spark.createDataFrame([(u, i, (u + i) % 3 / 2) for u in range(12) for i in range(5)], "user_idx int, item_idx int, rating_scaled double")
    models.fit_rating_model(train, rank=2, iterations=1)
    models.tune(train, train, [2], [0.1], iterations=1)
    alone, *search = [(each["numUserBlocks"], each["intermediateStorageLevel"], each["finalStorageLevel"]) for each in given]
    assert alone == (4, "MEMORY_AND_DISK", "MEMORY_AND_DISK") and set(search) == {(6, "DISK_ONLY", "DISK_ONLY")}
    assert {each["checkpointInterval"] for each in given} == {2}


@pytest.mark.parametrize(("columns", "k"), [(1, 3), (7, 3), (48, 3), (401, 3), (1000, 10)])
def test_best_places_are_those_of_a_sort(columns, k):
    draw = np.random.default_rng(columns)
    reaching, first = S.best_places(k)
    scores = draw.integers(0, 40, (50, columns)).astype(float)  # many equal scores
    scores[draw.random(scores.shape) < 0.3] = -np.inf
    scores[0] = -np.inf
    items = draw.permutation(columns)
    for least in (None, draw.integers(0, 40, 50).astype(float)):
        rows, which, floors = reaching(scores, least)
        found = first(rows, items[which], scores[rows, which])
        wanted = []
        for row in range(50):
            low = -np.inf if least is None else least[row]
            own = sorted((-score, item) for score, item in zip(scores[row], items, strict=True) if score > -np.inf and score >= low)
            wanted += [(row, item, -score) for score, item in own[:k]]
            best = np.sort(scores[row])[::-1]
            assert low <= floors[row] <= max(low, best[k - 1] if columns >= k else -np.inf)
        assert [tuple(row) for row in found.itertuples(index=False)] == wanted
        # of a long row only few scores are taken, not all
        assert columns < 400 or least is None and len(rows) < 50 * columns / 4 or least is not None


def test_the_exact_search_reads_interactions_that_are_stored(spark, monkeypatch):
    from reclake.workloads import scoring, tables

    t = tables.Tables(spark, "/root/testdata/sf0.001")
    plain = sorted(tuple(row) for row in scoring._exact(t).collect())
    t.stored()
    monkeypatch.setattr(tables.Tables, "interactions", property(lambda self: 1 / 0))
    assert sorted(tuple(row) for row in scoring._exact(t).collect()) == plain
