"""Aggregates that describe interactions and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.contracts import ATTENTION
from reclake.operators.positions import group_quantiles


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, distinct users and distinct items."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count("*").alias("interactions"),
        distinct(F.col("user_id")).alias("users"),
        distinct(F.col("item_id")).alias("items"),
    )


def active_ids(df: DataFrame, key: str, n: int) -> DataFrame:
    """Entities with at least ``n`` rows."""
    return df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= n).select(key)


def user_history(df: DataFrame) -> DataFrame:
    """The set of items per user, one row per member, so that a user with a very long history is no large row."""
    return df.select("user_id", "item_id").distinct()


def last_seen(df: DataFrame) -> DataFrame:
    return df.groupBy("user_id").agg(F.max("ts").alias("last_ts"))


def split_balance(df: DataFrame, col: str = "split") -> DataFrame:
    """Rows and percentage per split."""
    counts = df.groupBy(col).agg(F.count("*").alias("rows"))
    # One row per split reaches this window.
    total = F.sum("rows").over(Window.partitionBy())
    return counts.withColumn("pct", F.col("rows") * 100.0 / total)


def sampling_ratio(df: DataFrame) -> DataFrame:
    """Positives, negatives and negatives per positive of a sampled training set."""
    counts = df.agg(
        F.count_if(F.col("rating_scaled") > 0).alias("positives"),
        F.count_if(F.col("rating_scaled") <= 0).alias("negatives"),
    )
    ratio = F.col("negatives") / F.greatest("positives", F.lit(1))
    return counts.withColumn("ratio", ratio)


def describe_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, median, sample deviation, extremes and quartiles, one row per column; quantiles are exact."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(name).cast("double").alias("x")) for name in cols
    ])).alias("c")).select("c.*").dropna()

    moments = long.groupBy("column").agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    quartiles = group_quantiles(long, ["column"], "x", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return moments.join(quartiles, "column")


def parse_attention(df: DataFrame, col: str = "attention_weights") -> DataFrame:
    """Percentages per modality out of the JSON text; rows that are broken or hold a zero or missing weight go."""
    weights = F.from_json(F.col(col), ATTENTION)
    shares = {
        f"{name}_pct": F.nullif(weights[name], F.lit(0.0)) * 100 for name in ("category", "text", "image")
    }
    return df.withColumns(shares).dropna(subset=list(shares))


def attention_share(df: DataFrame, weights: str = "weights", by: list[str] | None = None) -> DataFrame:
    """Mean attention share per modality in percent; ``weights`` is an array of category, text and image."""
    return df.groupBy(*(by or [])).agg(*[
        (F.avg(F.get(weights, F.lit(place))) * 100).alias(name)
        for place, name in enumerate(("category_pct", "text_pct", "image_pct"))
    ])
