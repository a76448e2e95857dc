"""Pointwise and classification metrics. Each is one aggregation over a frame of predictions.

A frame of predictions has the scaled truth ``y`` and, as needed, ``p_rating`` and ``p_inter``. ``by`` names the
grouping columns, for instance model and dataset. Nothing is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclake.contracts import EPSILON, INTERACTION_THRESHOLD, QUALITY_STARS, REPORT_STARS, STARS_RANGE
from reclake.functions.features import interaction_label, to_stars


def _squared_error() -> Column:
    return F.pow(F.col("p_rating") - F.col("y"), 2)


def _cross_entropy() -> Column:
    label = interaction_label(F.col("y"))
    return -(label * F.log(F.col("p_inter") + EPSILON) + (1 - label) * F.log(1 - F.col("p_inter") + EPSILON))


def regression_metrics(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean squared error, its root, the root in stars, and the number of rows."""
    errors = df.groupBy(*(by or [])).agg(F.avg(_squared_error()).alias("mse"), F.count("*").alias("n_samples"))
    return errors.select(
        *(by or []),
        F.col("mse").alias("mse"),
        F.sqrt("mse").alias("rmse"),
        (F.sqrt("mse") * STARS_RANGE).alias("rmse_stars"),
        "n_samples",
    )


def bce(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Binary cross-entropy of the interaction probability."""
    return df.groupBy(*(by or [])).agg(F.avg(_cross_entropy()).alias("bce"))


def masked_mse(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean squared error over the positives only; 0 when there is none."""
    positive = F.when(F.col("y") > 0, _squared_error())
    return df.groupBy(*(by or [])).agg(F.coalesce(F.avg(positive), F.lit(0.0)).alias("masked_mse"))


def _cells(truth: Column, predicted: Column) -> list[Column]:
    return [
        F.count_if(predicted & truth).alias("tp"),
        F.count_if(predicted & ~truth).alias("fp"),
        F.count_if(~predicted & truth).alias("fn"),
        F.count_if(~predicted & ~truth).alias("tn"),
    ]


def _by_stars(stars: float) -> list[Column]:
    return _cells(to_stars(F.col("y")) >= stars, to_stars(F.col("p_rating")) >= stars)


def confusion(df: DataFrame, stars: float = QUALITY_STARS, by: list[str] | None = None) -> DataFrame:
    """Confusion matrix of the predicted rating at a number of stars."""
    return df.groupBy(*(by or [])).agg(*_by_stars(stars))


def confusion_at(df: DataFrame, prob: float = INTERACTION_THRESHOLD, by: list[str] | None = None) -> DataFrame:
    """Confusion matrix of the interaction probability at a threshold."""
    return df.groupBy(*(by or [])).agg(*_cells(F.col("y") > 0, F.col("p_inter") >= prob))


def rates(matrix: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of a confusion matrix."""
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    precision = tp / (tp + fp + EPSILON)
    recall = tp / (tp + fn + EPSILON)
    return matrix.withColumns({
        "accuracy": (tp + tn) / (tp + fp + fn + tn + EPSILON),
        "precision": precision,
        "recall": recall,
        "f1": 2 * precision * recall / (precision + recall + EPSILON),
    })


def classification_metrics(
    df: DataFrame, stars: float = QUALITY_STARS, prob: float | None = None, by: list[str] | None = None
) -> DataFrame:
    """:func:`rates` of the rating head at ``stars``, or of the interaction head when ``prob`` is given."""
    return rates(confusion(df, stars, by) if prob is None else confusion_at(df, prob, by))


def classification_report(df: DataFrame, stars: float = REPORT_STARS, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    by = by or []
    matrix = confusion(df, stars, by)

    def one(label: str, hit: str, wrong: str, missed: str) -> DataFrame:
        ratio = lambda part, whole: F.coalesce(F.try_divide(F.col(part), whole), F.lit(0.0))
        precision = ratio(hit, F.col(hit) + F.col(wrong))
        recall = ratio(hit, F.col(hit) + F.col(missed))
        return matrix.select(
            *by, F.lit(label).alias("class"), precision.alias("precision"), recall.alias("recall"),
            F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"),
            (F.col(hit) + F.col(missed)).alias("support"),
        )

    classes = one("relevant", "tp", "fp", "fn").unionByName(one("irrelevant", "tn", "fn", "fp"))
    scores = ("precision", "recall", "f1")
    total = F.sum("support")
    macro = classes.groupBy(*by).agg(
        F.lit("macro").alias("class"), *[F.avg(name).alias(name) for name in scores], total.alias("support")
    )
    weighted = classes.groupBy(*by).agg(
        F.lit("weighted").alias("class"),
        *[F.coalesce(F.try_divide(F.sum(F.col(name) * F.col("support")), total), F.lit(0.0)).alias(name) for name in scores],
        total.alias("support"),
    )
    every = classes.unionByName(macro).unionByName(weighted)
    return every.select(*by, "class", *[F.col(name).alias(name) for name in scores], "support")


def confusion_pct(matrix: DataFrame) -> DataFrame:
    """Cells of a confusion matrix as percentages of all rows."""
    names = ("tp", "fp", "fn", "tn")
    total = sum((F.col(name) for name in names), F.lit(0))
    return matrix.withColumns({f"{name}_pct": F.try_divide(F.col(name) * 100.0, total) for name in names})


def pointwise_metrics(df: DataFrame, by: list[str], stars: float = QUALITY_STARS) -> DataFrame:
    """Regression, cross-entropy, masked and classification metrics in one pass over the predictions."""
    sums = df.groupBy(*by).agg(
        F.avg(_squared_error()).alias("_mse"),
        F.count("*").alias("n_samples"),
        F.avg(_cross_entropy()).alias("_bce"),
        F.avg(F.when(F.col("y") > 0, _squared_error())).alias("_masked"),
        *_by_stars(stars),
    )
    return rates(sums).withColumns({
        "mse": F.col("_mse"),
        "rmse": F.sqrt("_mse"),
        "rmse_stars": F.sqrt("_mse") * STARS_RANGE,
        "bce": F.col("_bce"),
        "masked_mse": F.coalesce("_masked", F.lit(0.0)),
    }).drop("_mse", "_bce", "_masked")
