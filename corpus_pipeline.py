"""From raw documents to token ids: the corpus operators as stages, each written as Parquet and read by the next.

A null text counts as empty in every stage. A missing id comes last in the order of documents. Rows of one id and different texts
are documents of their own. An empty table gives an empty table. Further columns, whatever their names, are carried along by
all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.llm.decontaminate import drop_contaminated
from reclake.llm.jaccard import keep_first
from reclake.llm.line_dedup import drop_shared_lines
from reclake.llm.quality import fit_quality, score_quality
from reclake.llm.registry import table
from reclake.llm.tokenize import decode_ids, digests, encode_texts, public_model
from reclake.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; the corpus's n-grams are counted over what the stage is given.

    Documents without words, or with fewer than the rules ask for, go. Repeated rows are judged alike.
    """
    weights, min_ratio = fit_quality(docs, table(spark, sf_dir, "labels"))
    # Written first: a filter on the verdict would be pushed below the steps that lead to it and repeat them.
    scored = materialize(score_quality(docs, weights, min_ratio=min_ratio).select(*docs.columns, F.col("kept").alias("_kept")), "scored")
    return scored.filter("_kept").drop("_kept")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one holds; ``n_chars`` follows the text.

    Null becomes empty. Repeated rows are one document: both keep their lines.
    """
    others = [name for name in docs.columns if name not in ("doc_id", "text", "n_chars")]
    cleaned = drop_shared_lines(docs, carry=others)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of documents that share four fifths of their five-word shingles.

    Texts without words are in no group and stay. Of rows that repeat id and text one stays.
    """
    return keep_first(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that quote no benchmark item; null and empty texts quote none, repeated rows go or stay alike."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and of the text they decode to: a row per document, null texts as empty ones."""
    model = public_model()
    return digests(decode_ids(encode_texts(docs, model), model))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# Hashed n-grams, components of links and the tokenizer's merges cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
