"""Scaling and encoding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.functions.text import pipe_split
from reclake.operators.joins import enrich_genres
from reclake.session import materialize_packed as materialize
from reclake.sources.writers import Encoders


def minmax_scale(df: DataFrame, col: str = "rating", name: str = "rating_scaled", over: DataFrame | None = None) -> DataFrame:
    """Scale to [0, 1] by the extremes observed in ``df``, or in ``over``, of which it is a part; null when they are equal."""
    extremes = (df if over is None else over).agg(F.struct(F.min(col).alias("low"), F.max(col).alias("high"))).scalar()
    low, high = extremes["low"], extremes["high"]
    return df.withColumn(name, F.try_divide(F.col(col) - low, high - low))


def fit_labels(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values numbered from 0, as a ``(value, idx)`` table.

    No global window: values are range-partitioned, numbered inside each range, and shifted by the sizes of the
    ranges before. The range of a value is written down once, so a retried task cannot change it. The labels are
    written too: joins then know their size.
    """
    values = df.select(F.col(col).alias("value")).dropna().distinct()
    ranges = materialize(
        values.repartitionByRange("value").withColumn("_range", F.spark_partition_id()), "label-ranges"
    )
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_size"))
    # One row per range: at most as many as there are shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_range").orderBy("value")
    numbered = ranges.withColumn("_inside", F.row_number().over(inside) - 1)
    labels = numbered.join(F.broadcast(shifts), "_range").select(
        "value", (F.col("_inside") + F.col("_shift")).alias("idx")
    )
    return materialize(labels, "labels")


def apply_labels(df: DataFrame, labels: DataFrame, col: str, name: str) -> DataFrame:
    """Attach the label of ``col``; rows with a value outside the labels are dropped."""
    return df.join(labels.withColumnsRenamed({"value": col, "idx": name}), col)


def fit_multihot(df: DataFrame, col: str = "genres") -> DataFrame:
    """Sorted vocabulary of a pipe-joined column of any size, as a ``(value, idx)`` table."""
    texts = df.select(F.col(col).alias("text")).distinct()
    return fit_labels(texts.select(F.explode(pipe_split(F.col("text"))).alias("word")), "word")


def apply_word_indices(df: DataFrame, vocabulary: DataFrame, col: str = "genres", name: str = "genre_idx") -> DataFrame:
    """Sorted vocabulary indices of the words of ``col``; words outside the vocabulary are left out.

    Each distinct text is split and looked up once.
    """
    words = df.select(F.col(col).alias("_text")).distinct().select("_text", F.explode(pipe_split(F.col("_text"))).alias("value"))
    found = words.join(vocabulary, "value").groupBy("_text").agg(F.sort_array(F.collect_set(F.col("idx").cast("int"))).alias(name))
    joined = df.join(found, df[col] == found["_text"], "left").drop("_text")
    return joined.withColumn(name, F.coalesce(name, F.array().cast("array<int>")))


def dense_vector(indices: Column, size: Column) -> Column:
    """0/1 vector of length ``size`` with ones at ``indices``."""
    places = F.filter(F.sequence(F.lit(0), F.greatest(size, F.lit(1)) - 1), lambda at: at < size)
    return F.transform(places, lambda at: F.array_contains(indices, at).cast("int"))


def apply_multihot(df: DataFrame, vocabulary: DataFrame, col: str = "genres", name: str = "genres_multihot") -> DataFrame:
    """0/1 vector over the vocabulary, made from the indices of :func:`apply_word_indices`.

    Only the vocabulary's size reaches the rows, never the vocabulary. For very large ones keep the indices instead.
    """
    size = vocabulary.agg(F.count("*").cast("int")).scalar()
    both = apply_word_indices(df, vocabulary, col, "_indices").withColumn("_size", size)
    return both.withColumn(name, dense_vector(F.col("_indices"), F.col("_size"))).drop("_indices", "_size")


def universe(df: DataFrame, encoders: Encoders | None = None) -> DataFrame:
    """Vocabulary sizes: class counts of the encoders, else largest index + 1 and vector length of the data."""
    if encoders is None:
        return df.agg(
            (F.max("user_idx") + 1).cast("bigint").alias("num_users"),
            (F.max("item_idx") + 1).cast("bigint").alias("num_items"),
            F.max(F.size("genres_multihot")).cast("bigint").alias("num_categories"),
        )
    tables = {"num_users": encoders.users, "num_items": encoders.items, "num_categories": encoders.genres}
    spark = encoders.users.sparkSession
    return spark.range(1).select(
        *[table.agg(F.count("*")).scalar().alias(name) for name, table in tables.items()]
    )


@dataclass(frozen=True)
class FeatureFit:
    """What feature rows are made of: the ``ratings`` that labels and extremes are taken from, encoders, and described ``items``."""

    ratings: DataFrame
    encoders: Encoders
    items: DataFrame


def fit_features(ratings: DataFrame, movies: DataFrame) -> FeatureFit:
    """Encoders of the interactions; label, genre text and vector are worked out once per item."""
    users = fit_labels(ratings, "user_id")
    items = fit_labels(ratings, "item_id")
    described = enrich_genres(items.withColumnsRenamed({"value": "item_id", "idx": "item_idx"}), movies)
    genres = fit_multihot(described)
    described = materialize(apply_multihot(described, genres), "described-items")
    return FeatureFit(ratings, Encoders(users, items, genres), described)


def apply_features(rows: DataFrame, fit: FeatureFit) -> DataFrame:
    """Feature rows of some of the interactions, with their other columns; labels and scale are those of all interactions."""
    labelled = apply_labels(minmax_scale(rows, over=fit.ratings), fit.encoders.users, "user_id", "user_idx")
    return labelled.join(fit.items, "item_id")


def build_features(ratings: DataFrame, movies: DataFrame) -> tuple[DataFrame, Encoders]:
    """Feature table of the interactions (genre text, scaled rating, labels, multi-hot) and its encoders.

    Genre text and vector are worked out once per item, then joined to the interactions together with the label.
    """
    fit = fit_features(ratings, movies)
    return apply_features(ratings, fit), fit.encoders
