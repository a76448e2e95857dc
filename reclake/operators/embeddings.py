"""Item vectors out of text, and the catalogue of text and image vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclake.functions.vectors import zeros
from reclake.session import materialize_packed as materialize


def hashed_terms(df: DataFrame, col: str = "text", dim: int = 1024, key: str = "item_id") -> DataFrame:
    """``(key, place, weight)``: weights of the hashed terms of each text, squares adding up to one.

    Signed feature hashing: a term, lower-cased and cut at white space, falls on a place of 0 .. ``dim`` - 1 by its md5, with a sign
    by another digit, so that terms that share a place cancel out on average. A place weighs its signed term count times
    ``ln((n + 1) / (d + 1))`` for the d of n texts that have a term there. Places weighing zero are left out.
    """
    words = F.filter(F.split(F.lower(F.coalesce(col, F.lit(""))), r"\s+"), lambda word: word != "")
    terms = df.select(key, F.explode(words).alias("_term"))
    digest = F.md5("_term")
    place = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % dim).alias("place")
    sign = F.when(F.substring(digest, 9, 1).isin(*"01234567"), 1).otherwise(-1)
    counts = materialize(terms.select(key, place, sign.alias("_sign")).groupBy(key, "place").agg(F.sum("_sign").alias("_tf")), "hashed-terms")
    # at most ``dim`` rows
    places = counts.groupBy("place").agg(F.count("*").alias("_d"))
    n = df.agg(F.count("*")).scalar()
    idf = places.select("place", F.log((n + 1) / (F.col("_d") + 1)).alias("_idf"))
    weighted = counts.join(F.broadcast(idf), "place").withColumn("_w", F.col("_tf") * F.col("_idf")).filter("_w <> 0")
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    return weighted.join(norms, key).select(key, "place", (F.col("_w") / F.col("_norm")).alias("weight"))


def embed_text(df: DataFrame, col: str = "text", dim: int = 1024, key: str = "item_id") -> DataFrame:
    """Unit vector of ``dim`` :func:`hashed_terms` per item, as ``(key, text_emb)``; the whole text counts.

    A text without terms, or with terms that every text has, has a zero vector. Each item is one row of ``df``.
    """
    held = hashed_terms(df, col, dim, key).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("place", "weight"))).alias("_weights"))  # at most ``dim`` entries
    joined = df.select(key).join(held, key, "left")
    places = F.sequence(F.lit(0).cast("bigint"), F.lit(dim - 1).cast("bigint"))
    vector = F.transform(places, lambda at: F.coalesce(F.try_element_at("_weights", at), F.lit(0.0)).cast("float"))
    empty = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return joined.select(key, F.when(F.col("_weights").isNull(), empty).otherwise(vector).alias("text_emb"))


def assemble_embeddings(text: DataFrame, images: DataFrame, dim: int) -> DataFrame:
    """Text and image vector per item; a zero vector where there is no image."""
    kind = images.schema["img_emb"].dataType.elementType.simpleString()
    joined = text.join(images.select("item_id", "img_emb"), "item_id", "left")
    return joined.withColumns({
        "has_image": F.col("img_emb").isNotNull(),
        "img_emb": F.coalesce("img_emb", zeros(dim, kind)),
    })


def embedding_counts(assembled: DataFrame) -> DataFrame:
    """Items with an image vector and items without."""
    return assembled.agg(
        F.count_if("has_image").alias("with_image"),
        F.count_if(~F.col("has_image")).alias("without_image"),
    )
