"""Quality rules: plain counts, and a log-likelihood ratio of hashed n-grams. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.llm.common import rest, strip_blanks, word_array
from reclake.llm.registry import query, table
from reclake.operators.positions import group_quantiles
from reclake.session import materialize

# ---- fixed values ----
SYMBOLS = "#*$%&|<>"
# ---- end of fixed values ----
BUCKETS = 10_000
PRIOR_SHARE = 0.1
MIN_RATIO = -0.04
HELD, MAX_LOST = 5, 0.02
MAX_BROADCAST = 2_000_000  # ids; a shuffle join beyond


def _bucket(*cols: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def _good(labels: DataFrame, max_broadcast: int) -> DataFrame:
    """Ids of the documents labelled good, each once; hinted for a broadcast if there are no more than ``max_broadcast``."""
    good = materialize(labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "good")
    return F.broadcast(good) if good.count() <= max_broadcast else good


def ngram_weights(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, prior: float | None = None, max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``bucket``, ``weight``: log of the target's share of a bucket over the corpus's.

    Corpus counts are smoothed by one; the target's by ``prior`` n-grams spread as in the corpus, by default a tenth of the
    target, so that weights mean the same for targets of any size. Without a target all weights are 0.

    N-grams are words and pairs of adjacent words. The corpus counts cover all words of all documents. The target is
    all documents labelled good (``quality`` = 1); their ids are broadcast up to ``max_broadcast`` of them, and joined by a
    shuffle beyond. Both multinomials come from one pass, summed by bucket before the shuffle.
    """
    good = _good(labels, max_broadcast).withColumn("_good", F.lit(1))
    words = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).join(good, "doc_id", "left")
    pairs = words.select("_good", word_array(F.col("_text")).alias("_words")).select(
        F.coalesce("_good", F.lit(0)).alias("_good"),
        F.inline(F.arrays_zip(F.col("_words").alias("_a"), rest(F.col("_words"), 1).alias("_b"))).alias("_a", "_b"),
    )
    grams = pairs.select("_good", F.explode(F.array(
        _bucket(F.col("_a"), buckets=buckets),
        F.when(F.col("_b").isNotNull(), _bucket(F.col("_a"), F.col("_b"), buckets=buckets)),
    )).alias("bucket")).filter(F.col("bucket").isNotNull())
    counts = grams.groupBy("bucket").agg(F.sum("_good").alias("_t"), F.count("*").alias("_r"))
    full = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    counted = [F.coalesce("_t", F.lit(0)).cast("double").alias("_t"), (F.coalesce("_r", F.lit(0)) + 1.0).alias("_r")]
    full = materialize(full.select("bucket", *counted), "ngrams")
    total = full.agg(F.sum("_t"), F.sum("_r")).first()
    share = F.col("_r") / total[1]
    prior = (PRIOR_SHARE * total[0] or 1.0) if prior is None else prior
    weight = F.log((F.col("_t") + prior * share) / (total[0] + prior)) - F.log(share)
    return full.select("bucket", F.round(weight, 6).alias("weight"))


FEW = 32


def _with_repeat_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words of ``_words`` in three-word windows that occur twice or more.

    Window hashes are sorted to find the repeated ones. With few of them, positions are looked up; with many, hashes
    are sorted with their positions. Each step is a column of its own, which keeps Catalyst from repeating its work.
    """
    words = F.col("_words")
    pairs = F.zip_with(words, rest(words, 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    hashes = F.zip_with(F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), rest(words, 2),
                        lambda ab, c: F.xxhash64(ab["a"], ab["b"], c))
    df = df.withColumn("_h", hashes)
    df = df.withColumn("_s", F.sort_array("_h"))
    same = F.zip_with("_s", rest(F.col("_s"), 1), lambda a, b: F.when(a == b, a))
    df = df.withColumn("_d", F.array_distinct(F.filter(same, lambda x: x.isNotNull())))
    looked_up = F.filter(F.transform("_h", lambda h, at: F.when(F.array_contains("_d", h), at)), lambda x: x.isNotNull())
    placed = F.transform("_h", lambda h, at: F.struct(h.alias("h"), at.alias("at")))
    df = df.withColumn("_p", F.when(F.size("_d") > FEW, F.sort_array(placed)))
    twins = F.flatten(F.filter(
        F.zip_with("_p", rest(F.col("_p"), 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"]))),
        lambda x: x.isNotNull(),
    ))
    df = df.withColumn("_at", F.when(F.size("_d") == 0, F.array().cast("array<int>"))
                       .when(F.size("_d") <= FEW, looked_up).otherwise(F.sort_array(F.array_distinct(twins))))
    steps = F.zip_with("_at", rest(F.col("_at"), 1), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    total = F.aggregate(steps, F.lit(0), lambda sum_, x: sum_ + x)
    return df.withColumn("n_repeat_words", total.cast("long")).drop("_h", "_s", "_d", "_p", "_at")


def score_quality(
    docs: DataFrame, weights: DataFrame, min_words: int = 50, max_repeat: float = 0.5, min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """``docs`` with the counts, the ``ratio`` and the verdicts ``base_failed`` and ``kept`` added.

    ``ratio`` is the sum of the weights of all n-grams of the text over their number; a text is kept if it passes the
    base rules and its ratio is at least ``min_ratio``. Each row is judged on its own, without a shuffle; the weights,
    one number per bucket, are a constant array of the plan. Null text counts as empty: no words, base rules failed, ratio 0.
    Columns of ``docs`` with the names of added ones are replaced.
    """
    numbers = [row["weight"] for row in weights.orderBy("bucket").collect()]
    buckets = len(numbers)
    vector = F.split(F.lit(",".join(map(repr, numbers))), ",").cast("array<double>")
    text = F.coalesce("text", F.lit(""))
    split = _with_repeat_words(docs.withColumns({"_words": word_array(text), "_text": text}))
    words = F.col("_words")
    singles = F.transform(words, lambda w: _bucket(w, buckets=buckets))
    doubles = F.zip_with(words, rest(words, 1), lambda a, b: F.when(b.isNotNull(), _bucket(a, b, buckets=buckets)))
    total = F.aggregate(F.concat(singles, doubles), F.lit(0.0), lambda sum_, at: sum_ + F.coalesce(F.get(vector, at), F.lit(0.0)))
    lines = F.filter(F.split("_text", "\n"), lambda line: strip_blanks(line) != "")
    n_words = F.size(words).cast("long")
    stripped = F.length(F.regexp_replace("_text", "[ \\t-\\r]+", ""))
    counted = split.withColumns({
        "n_words": n_words,
        "word_chars": stripped.cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.regexp_replace("_text", "[#*$%&|<>]+", ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "ratio": F.when(n_words > 0, total / (2 * n_words - 1)).otherwise(F.lit(0.0)),
    }).drop("_words", "_text")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 100 * max_repeat * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= min_ratio))


def _held() -> Column:
    return F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(HELD)) == 0


def least_ratio(docs: DataFrame, labels: DataFrame, weights: DataFrame, max_lost: float = MAX_LOST, max_broadcast: int = MAX_BROADCAST) -> float:
    """The ratio that all but ``max_lost`` of the good documents of ``labels`` reach, of those that pass the base rules.

    All of them are scored; the quantile is exact and worked out in blocks of ratios. Without any, no ratio is too low.
    """
    held = docs.select("doc_id", "text").join(_good(labels, max_broadcast), "doc_id", "left_semi")
    # Written first: a filter on the verdict would be pushed below the steps that lead to it and repeat them.
    scored = materialize(score_quality(held, weights).select("base_failed", "ratio"), "held")
    passed = scored.filter("not base_failed").select(F.lit(0).alias("all"), "ratio")
    found = group_quantiles(passed, ["all"], "ratio", {"least": max_lost}).first()
    return float("-inf") if found is None else found["least"]


def fit_quality(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """Weights out of four fifths of the labelled documents, and the least ratio to keep out of the others."""
    weights = ngram_weights(docs, labels.filter(~_held()))
    return weights, least_ratio(docs, labels.filter(_held()), weights)


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights, min_ratio = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, weights, min_ratio=min_ratio).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")
