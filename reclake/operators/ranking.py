"""Ranking metrics.

Windows that keep the first ``k`` rows of a user are limited before the shuffle (the plan shows a partial
``WindowGroupLimit``), so a user with very many rows sends at most ``k`` rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.contracts import QUALITY_STARS, TOP_K
from reclake.functions.features import to_stars


def top_k(df: DataFrame, k: int, order: list[Column], by: list[str], name: str = "rank") -> DataFrame:
    """First ``k`` rows per group in ``order``, with their 1-based rank."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, rank.cast("bigint")).filter(F.col(name) <= k)


def target_rank(df: DataFrame, key: list[str], score: str = "score") -> DataFrame:
    """0-based rank of the target: the number of its candidates with a strictly higher score.

    ``df`` holds one row per (key, candidate) with the flag ``is_target``. The target's score comes by a join, so candidates
    are neither sorted by score nor gathered; pass a stored table, it is read twice.
    """
    targets = df.filter("is_target").groupBy(*key).agg(F.max(score).alias("_target")).filter("_target is not null")
    ahead = F.count_if(~F.col("is_target") & (F.col(score) > F.col("_target")))
    return df.select(*key, "is_target", score).join(targets, key).groupBy(*key).agg(ahead.alias("rank"))


def _hit(k: int) -> Column:
    return F.when(F.col("rank") < k, 1.0).otherwise(0.0)


def _gain(k: int) -> Column:
    return F.when(F.col("rank") < k, 1.0 / F.log2(F.col("rank") + 2)).otherwise(0.0)


def hit_rate(ranks: DataFrame, k: int = TOP_K, by: list[str] | None = None) -> DataFrame:
    """Share of targets ranked among the first ``k``."""
    return ranks.groupBy(*(by or [])).agg(
        F.avg(_hit(k)).alias("hit_rate_at_k"), F.count("*").alias("total_evaluations")
    )


def ndcg_single(ranks: DataFrame, k: int = TOP_K, by: list[str] | None = None) -> DataFrame:
    """Mean discounted gain of a single target: ``1 / log2(rank + 2)`` within the first ``k``."""
    return ranks.groupBy(*(by or [])).agg(
        F.avg(_gain(k)).alias("ndcg_at_k"), F.count("*").alias("total_evaluations")
    )


def ranking_metrics(ranks: DataFrame, k: int = TOP_K, by: list[str] | None = None) -> DataFrame:
    """Hit rate and discounted gain in one pass."""
    return ranks.groupBy(*(by or [])).agg(
        F.avg(_hit(k)).alias("hit_rate_at_k"),
        F.avg(_gain(k)).alias("ndcg_at_k"),
        F.count("*").alias("total_evaluations"),
    )


def ndcg_graded(df: DataFrame, k: int = TOP_K, by: list[str] | None = None) -> DataFrame:
    """Mean over users of the graded NDCG@k of ``p_rating`` against the stars of ``y``; equal predictions by item."""
    groups = [*(by or []), "user_id"]
    stars = df.select(*groups, "item_id", "p_rating", to_stars(F.col("y")).alias("_stars"))
    gain = F.sum((F.pow(F.lit(2.0), F.col("_stars")) - 1) / F.log2(F.col("rank") + 1))
    predicted = top_k(stars, k, [F.desc("p_rating"), F.asc("item_id")], groups)
    ideal = top_k(stars, k, [F.desc("_stars"), F.asc("item_id")], groups)
    per_user = predicted.groupBy(*groups).agg(gain.alias("_dcg")).join(
        ideal.groupBy(*groups).agg(gain.alias("_idcg")), groups
    )
    score = F.when(F.col("_idcg") > 0, F.col("_dcg") / F.col("_idcg")).otherwise(0.0)
    return per_user.groupBy(*(by or [])).agg(
        F.avg(score).alias("ndcg_at_k"), F.count("*").alias("users")
    )


def precision_recall_at_k(
    df: DataFrame, k: int = TOP_K, stars: float = QUALITY_STARS, by: list[str] | None = None
) -> DataFrame:
    """Mean precision@k and recall@k over the users that have a relevant item; equal predictions by item.

    Recommended means predicted at or above the threshold within the first ``k``.
    """
    groups = [*(by or []), "user_id"]
    relevant = to_stars(F.col("y")) >= stars
    chosen = to_stars(F.col("p_rating")) >= stars
    users = df.groupBy(*groups).agg(F.count_if(relevant).alias("_relevant")).filter(F.col("_relevant") > 0)
    first = top_k(df, k, [F.desc("p_rating"), F.asc("item_id")], groups).groupBy(*groups).agg(
        F.count_if(chosen).alias("_chosen"), F.count_if(chosen & relevant).alias("_both")
    )
    per_user = users.join(first, groups)
    precision = F.coalesce(F.try_divide(F.col("_both"), F.col("_chosen")), F.lit(0.0))
    return per_user.groupBy(*(by or [])).agg(
        F.avg(precision).alias("precision_at_k"),
        F.avg(F.col("_both") / F.col("_relevant")).alias("recall_at_k"),
        F.count("*").alias("users"),
    )
