from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from reclake.operators import metrics as Q
from reclake.operators import ranking as K
from reclake.operators import selection as R
from reclake.plans.evaluation import evaluate, report_documents, summary_of
from tests.conftest import rows

# Results of a finished run: a confusion matrix, two summaries and the scores that follow from them.
MATRIX = (4665, 1416, 1104, 2102)
RATES = (0.72865, 0.76714, 0.80863, 0.78734)
SUMMARIES = [
    ("regression", 0.7627382547205043, 0.4454844860461085, 0.2094711040244851, 0.7229170398566951),
    ("twoheads", 0.7786356097074342, 0.5768764083896689, 0.2978008411814125, 0.7280626987954575),
]
SCORES = {"regression": 0.46546, "twoheads": 0.533617}


@pytest.fixture(scope="module")
def data():
    draw = random.Random(11)
    return [
        ("m", dataset, user, item, draw.randrange(10) / 9, draw.randrange(20) / 19, draw.random())
        for dataset in ("test", "coldstart") for user in range(8) for item in draw.sample(range(40), draw.randrange(1, 30))
    ]


@pytest.fixture(scope="module")
def predictions(spark, data):
    return spark.createDataFrame(
        data, "model string, dataset string, user_id long, item_id long, y double, p_rating double, p_inter double"
    ).persist()


@pytest.fixture
def summary(spark):
    return spark.createDataFrame(
        SUMMARIES, "model string, rmse_stars double, hit_rate_at_k double, ndcg_at_k double, precision_at_k double"
    )


def of(data, dataset):
    return [row for row in data if row[1] == dataset]


def test_rates_of_a_known_matrix(spark):
    matrix = spark.createDataFrame([MATRIX], "tp long, fp long, fn long, tn long")
    found = Q.rates(matrix).first()
    assert [found[name] for name in ("accuracy", "precision", "recall", "f1")] == pytest.approx(RATES, abs=1e-5)
    shares = Q.confusion_pct(matrix).first()
    assert sum(shares[f"{name}_pct"] for name in ("tp", "fp", "fn", "tn")) == pytest.approx(100, abs=1e-5)


def test_pointwise(predictions, data):
    test = of(data, "test")
    mse = sum((row[5] - row[4]) ** 2 for row in test) / len(test)
    found = Q.regression_metrics(predictions.filter("dataset = 'test'")).first()
    assert found["mse"] == pytest.approx(mse, abs=1e-6) and found["rmse_stars"] == pytest.approx(4 * math.sqrt(mse), abs=1e-6)
    entropy = -sum(math.log((row[6] if row[4] > 0 else 1 - row[6]) + 1e-8) for row in test) / len(test)
    assert Q.bce(predictions.filter("dataset = 'test'")).first()["bce"] == pytest.approx(entropy, abs=1e-6)
    positive = [row for row in test if row[4] > 0]
    masked = sum((row[5] - row[4]) ** 2 for row in positive) / len(positive)
    assert Q.masked_mse(predictions.filter("dataset = 'test'")).first()["masked_mse"] == pytest.approx(masked, abs=1e-6)
    assert Q.masked_mse(predictions.filter("y = 0")).first()["masked_mse"] == 0.0
    both = {row["dataset"]: row for row in Q.pointwise_metrics(predictions, ["model", "dataset"]).collect()}
    assert both["test"]["mse"] == found["mse"] and both["test"]["bce"] == pytest.approx(entropy, abs=1e-6)


def test_confusions(predictions, data):
    cells = {"tp": 0, "fp": 0, "fn": 0, "tn": 0}
    heads = dict(cells)
    for row in of(data, "test"):
        truth, chosen = row[4] * 4 + 1 >= 3.5, row[5] * 4 + 1 >= 3.5
        cells[("tp" if truth else "fp") if chosen else ("fn" if truth else "tn")] += 1
        truth, chosen = row[4] > 0, row[6] >= 0.5
        heads[("tp" if truth else "fp") if chosen else ("fn" if truth else "tn")] += 1
    test = predictions.filter("dataset = 'test'")
    assert Q.confusion(test, 3.5).first().asDict() == cells
    assert Q.confusion_at(test, 0.5).first().asDict() == heads


def test_report_of_classes(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 1.0)], "y double, p_rating double")
    report = {row["class"]: row for row in Q.classification_report(df).collect()}
    assert (report["relevant"]["precision"], report["relevant"]["recall"], report["relevant"]["support"]) == (0.5, 0.5, 2)
    assert report["irrelevant"]["precision"] == pytest.approx(2 / 3, abs=1e-6)
    assert report["macro"]["f1"] == pytest.approx((0.5 + 2 / 3) / 2, abs=1e-6)
    assert report["weighted"]["recall"] == pytest.approx(0.6, abs=1e-6) and report["weighted"]["support"] == 5
    never = Q.classification_report(df.withColumn("p_rating", F.lit(0.0)))
    assert {row["class"]: row["f1"] for row in never.collect()}["relevant"] == 0.0


def test_graded_ndcg(predictions, data):
    k, scores = 5, []
    for user in {row[2] for row in of(data, "test")}:
        mine = [row for row in of(data, "test") if row[2] == user]
        dcg = lambda items: sum((2 ** (row[4] * 4 + 1) - 1) / math.log2(at + 2) for at, row in enumerate(items[:k]))
        scores.append(dcg(sorted(mine, key=lambda r: (-r[5], r[3]))) / dcg(sorted(mine, key=lambda r: -r[4])))
    found = K.ndcg_graded(predictions, k, ["dataset"]).filter("dataset = 'test'").first()
    assert found["ndcg_at_k"] == pytest.approx(sum(scores) / len(scores), abs=1e-6) and found["users"] == len(scores)


@pytest.mark.parametrize("stars", [3.5, 3.8, 5.0])
def test_precision_and_recall(predictions, data, stars):
    k, precisions, recalls = 5, [], []
    for user in {row[2] for row in of(data, "test")}:
        mine = sorted((row for row in of(data, "test") if row[2] == user), key=lambda r: (-r[5], r[3]))
        relevant = sum(row[4] * 4 + 1 >= stars for row in mine)
        if relevant:
            chosen = [row for row in mine[:k] if row[5] * 4 + 1 >= stars]
            hits = sum(row[4] * 4 + 1 >= stars for row in chosen)
            precisions.append(hits / len(chosen) if chosen else 0.0)
            recalls.append(hits / relevant)
    found = K.precision_recall_at_k(predictions, k, stars, ["dataset"]).filter("dataset = 'test'").first()
    assert found["precision_at_k"] == pytest.approx(sum(precisions) / len(precisions), abs=1e-6)
    assert found["recall_at_k"] == pytest.approx(sum(recalls) / len(recalls), abs=1e-6)


def test_top_k_limits_before_the_shuffle(predictions):
    best = K.top_k(predictions, 3, [F.desc("p_rating"), F.asc("item_id")], ["dataset", "user_id"])
    assert "WindowGroupLimit" in best._jdf.queryExecution().toString()
    assert best.groupBy("dataset", "user_id").count().agg(F.max("count")).first()[0] <= 3


def test_rank_counts_strictly_better_candidates(spark):
    data = [(1, True, 0.5), (1, False, 0.9), (1, False, 0.5), (1, False, 0.1), (2, True, 0.9), (2, False, 0.1), (3, False, 0.2)]
    ranks = K.target_rank(spark.createDataFrame(data, "id int, is_target boolean, score double"), ["id"])
    assert rows(ranks) == [(1, 1), (2, 0)]
    assert K.hit_rate(ranks, 1).first()["hit_rate_at_k"] == 0.5
    assert K.ndcg_single(ranks, 10).first()["ndcg_at_k"] == pytest.approx((1 + 1 / math.log2(3)) / 2, abs=1e-6)
    assert K.ranking_metrics(ranks, 1).first()["ndcg_at_k"] == 0.5


def test_scores_and_winner(summary):
    scores = R.composite_score(summary)
    found = {row["model"]: row["score"] for row in scores.collect()}
    assert found == pytest.approx(SCORES, abs=1e-5)
    assert R.select_winner(scores).first()["winner"] == "twoheads"
    tie = scores.withColumn("score", F.lit(0.5))
    assert R.select_winner(tie).first()["winner"] == "twoheads" and R.select_winner(tie, "regression").first()["winner"] == "regression"
    parts = R.score_breakdown(summary).groupBy("model").agg(F.sum("contribution").alias("total"), F.sum("weight").alias("weight"))
    assert {row["model"]: row["total"] for row in parts.collect()} == pytest.approx(SCORES, abs=1e-5)


def test_gate(summary):
    assert {row["model"]: row["passed"] for row in R.quality_gate(summary).collect()} == {"regression": True, "twoheads": True}
    assert not any(row["passed"] for row in R.quality_gate(summary, min_ndcg=0.3).collect())
    assert not any(row["passed"] for row in R.quality_gate(summary.withColumn("rmse_stars", F.lit(None).cast("double"))).collect())


def test_a_small_lead_wins_and_nan_loses(spark):
    scores = spark.createDataFrame([("regression", 0.5 + 1e-7), ("twoheads", 0.5), ("broken", float("nan")), ("none", None)], "model string, score double")
    assert R.select_winner(scores).first()["winner"] == "regression"
    broken = spark.createDataFrame([("x", float("nan"), 0.9)], "model string, rmse_stars double, ndcg_at_k double")
    assert not R.quality_gate(broken).first()["passed"]


def test_tables_for_reports(summary, spark):
    table = R.comparison_table(summary, ["rmse_stars", "ndcg_at_k"], ["regression", "twoheads"])
    assert {row["metric"]: row["twoheads"] for row in table.collect()} == {"rmse_stars": SUMMARIES[1][1], "ndcg_at_k": SUMMARIES[1][3]}
    gaps = spark.createDataFrame([("a", "test", 0.7), ("a", "coldstart", 0.9)], "model string, dataset string, rmse_stars double")
    assert rows(R.coldstart_gap(gaps)) == [("a", 0.7, 0.9, pytest.approx(0.2))]
    trials = spark.createDataFrame([(1, 0.5, 1e-3, 64), (2, 0.4, 1e-4, 32), (3, None, 1e-5, 8)], "trial int, loss double, lr double, emb_dim int")
    assert rows(R.leaderboard(trials, "loss", ["lr", "emb"])) == [(0.4, 1e-4, 32)]


def test_evaluation_bundle_and_documents(predictions, spark):
    ranks = spark.createDataFrame([("m", "test", 0), ("m", "test", 30)], "model string, dataset string, rank long")
    bundle = evaluate(predictions, ranks, 10)
    found = {row["dataset"]: row for row in bundle.collect()}
    assert found["test"]["hit_rate_at_k"] == 0.5 and found["coldstart"]["hit_rate_at_k"] is None
    assert summary_of(bundle).count() == 1
    document = report_documents(bundle).first()
    assert document["coldstart_pointwise"]["mse"] == found["coldstart"]["mse"]
    assert document["ranking_true_neg"]["total_evaluations"] == 2 and document["precision_recall"]["k"] == 10
