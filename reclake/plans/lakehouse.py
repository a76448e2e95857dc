"""Silver tables, feature table and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reclake.contracts import NOISE_MIN_ITEM, NOISE_MIN_USER
from reclake.operators.cleaning import Funnel, clean_links
from reclake.operators.encoders import build_features
from reclake.operators.joins import build_movies, build_ratings
from reclake.operators.splits import by_split, filter_noise, temporal_split
from reclake.session import materialize_packed as materialize
from reclake.sources.writers import Encoders


def build_silver(
    ratings: DataFrame, links: DataFrame, catalog: DataFrame, assets: DataFrame, names: list[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver ratings, silver movies and the row counts on the way (``step``, ``stage``, ``rows``), all in one run."""
    funnel = Funnel()
    silver = materialize(build_ratings(ratings, clean_links(links), catalog, assets, funnel), "silver-ratings")
    return silver, build_movies(catalog, silver, names), funnel.counts(ratings.sparkSession)


def build_splits(
    ratings: DataFrame, movies: DataFrame, min_user: int = NOISE_MIN_USER, min_item: int = NOISE_MIN_ITEM
) -> tuple[dict[str, DataFrame], Encoders]:
    """Feature rows as ``train``, ``val``, ``test`` and ``cold-starts``, and the encoders.

    Encoders cover all interactions, so cold-start rows have labels too.
    """
    features, encoders = build_features(ratings, movies)
    features = materialize(features, "features")
    clean, dropped = filter_noise(features, min_user, min_item)
    split = materialize(temporal_split(clean), "splits")
    return {**by_split(split), "cold-starts": dropped}, encoders
