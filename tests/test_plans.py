from __future__ import annotations

from pyspark.sql import functions as F

from reclake.operators.cleaning import Funnel
from reclake.operators.joins import build_ratings
from reclake.plans.lakehouse import build_silver, build_splits
from reclake.workloads.tables import Tables
from tests.conftest import rows


def test_from_raw_ratings_to_splits(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    silver, movies, counts = build_silver(t.ratings, t.links, t.catalog, t.assets, ["item_id", "title"])
    named = counts.orderBy("step").collect()
    steps = [row["rows"] for row in named]
    assert [row["stage"] for row in named] == ["raw", "linked", "described", "with_asset", "silver"]
    assert steps == sorted(steps, reverse=True) and steps[0] == t.ratings.count() and steps[-1] == silver.count() > 0
    assert steps[3] == t.ratings.join(silver, "item_id", "left_semi").count()
    assert movies.count() == silver.select("item_id").distinct().count()
    splits, encoders = build_splits(silver, t.movies)
    assert sorted(splits) == ["cold-starts", "test", "train", "val"]
    assert sum(frame.count() for frame in splits.values()) == silver.count()
    assert encoders.users.count() == silver.select("user_id").distinct().count()
    newest = lambda name, how: splits[name].groupBy("user_id").agg(how("ts").alias(name))
    both = newest("train", F.max).join(newest("test", F.min), "user_id")
    assert both.filter("train > test").count() == 0
    assert rows(splits["train"].groupBy("user_id", "item_id").count().filter("count > 1")) == []


def test_counts_of_the_silver_build_cost_no_second_read(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    plain = build_ratings(t.ratings, t.links, t.catalog, t.assets)
    counted = build_ratings(t.ratings, t.links, t.catalog, t.assets, Funnel())

    def nodes(df, name):
        return df._jdf.queryExecution().optimizedPlan().toString().count(name)

    assert nodes(counted, "CollectMetrics") == 5 and nodes(plain, "CollectMetrics") == 0
    assert nodes(counted, "Relation [") == nodes(plain, "Relation [") and nodes(counted, "Join LeftSemi") == 3
