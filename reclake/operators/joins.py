"""Joins between interactions, catalogue, assets, vectors and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclake.contracts import CATALOG_COLUMNS, RATINGS, UNKNOWN
from reclake.functions.text import pipe_join
from reclake.functions.vectors import zeros
from reclake.operators.cleaning import Funnel, conform, fill_genre, select_available


def build_ratings(
    ratings: DataFrame, links: DataFrame, catalog: DataFrame, assets: DataFrame, funnel: Funnel | None = None,
) -> DataFrame:
    """Ratings of items that have a link, a catalogue row and an asset; the newest row per (user, item).

    The three other tables only decide which rows stay, so all joins are semi-joins on the item. Rows are ordered by
    time, then rating, highest first. ``funnel`` counts the rows that are left after each step.
    """
    count = funnel.stage if funnel else lambda _, df: df
    kept = count("raw", ratings)
    for name, side in (("linked", links.dropna(subset=["ext_id"])), ("described", catalog), ("with_asset", assets)):
        kept = count(name, kept.join(side, "item_id", "left_semi"))
    tie_break = [F.desc(name) for name in kept.columns if name not in ("user_id", "item_id", "ts")]
    return count("silver", conform(kept, RATINGS, ["user_id", "item_id"], [F.desc("ts"), *tie_break]))


def build_movies(catalog: DataFrame, ratings: DataFrame, names: list[str] | None = None, key: str = "item_id") -> DataFrame:
    """Catalogue rows of rated items, with the wanted columns that exist."""
    rated = ratings.select(F.col("item_id").alias(key))
    return select_available(catalog.join(rated, key, "left_semi"), names or CATALOG_COLUMNS)


def enrich_genres(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Interactions with the genre text of the item, ``Desconocido`` where there is none."""
    is_array = movies.schema["genres"].dataType.typeName() == "array"
    genres = movies.select("item_id", pipe_join(F.col("genres"), is_array).alias("genres"))
    return fill_genre(ratings.join(genres, "item_id", "left"), UNKNOWN)


def pending_assets(catalog: DataFrame, existing: DataFrame) -> DataFrame:
    """Catalogue rows whose asset does not exist yet."""
    return catalog.join(existing, "item_id", "left_anti")


def keep_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_semi")


def discarded(df: DataFrame, clean: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``clean``."""
    return df.join(clean, keys, "left_anti")


def attach_embeddings(df: DataFrame, embeddings: DataFrame, dim: int) -> DataFrame:
    """Text and image vector of each item; zero vectors where the catalogue of vectors has none."""
    joined = df.join(embeddings.select("item_id", "text_emb", "img_emb"), "item_id", "left")
    kind = embeddings.schema["text_emb"].dataType.elementType.simpleString()
    return joined.withColumns({
        name: F.coalesce(F.col(name), zeros(dim, kind)) for name in ("text_emb", "img_emb")
    })


def join_predictions(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    return truth.join(predictions, ["user_id", "item_id"])
