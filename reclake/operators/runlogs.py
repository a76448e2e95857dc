"""Training logs: series of metrics per job, and what is read off them.

Log lines are ``(job, seq, message)`` with ``seq`` unique within a job. A series table is wide: one row per (job, epoch)
with one column per metric. Epochs of a metric are its occurrences in order, whatever number a line may state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclake.functions.text import strip
from reclake.operators.positions import group_positions, running

# ---- fixed values: names in the log lines, number patterns, required series ----
LOGGED = {
    "train_total": "train_total_loss",
    "train_bce": "train_bce",
    "train_mse": "train_mse",
    "val_total": "val_total_loss",
    "val_bce": "val_bce",
    "val_mse": "val_mse",
    "val_rmse_stars": "val_rmse_stars",
    "lr": "lr",
}
NUMBER = "[0-9.]+"
RATE = r"[0-9.eE+\-]+"
REQUIRED = ["train_total", "train_bce", "train_mse", "val_mse", "val_rmse_stars"]
REQUIRED_EPOCH_LINES = ["train_total", "val_total", "val_bce", "val_mse", "val_rmse_stars"]
REQUIRED_REGRESSION = ["train_mse", "val_mse", "val_rmse_stars"]
# ---- end of fixed values ----


def _pattern(metric: str) -> str:
    return f"{LOGGED[metric]}=({RATE if metric == 'lr' else NUMBER});"


def _found(message: Column, pattern: str) -> Column:
    return F.regexp_extract(message, pattern, 1).try_cast("double")


def parse_epoch_lines(logs: DataFrame) -> DataFrame:
    """One row per line ``Epoch N | name=value; …`` with its number and its metrics."""
    lines = logs.withColumn("_line", strip(F.col("message"))).filter(F.col("_line").startswith("Epoch "))
    return lines.select(
        "job", "seq",
        F.regexp_extract("_line", r"^Epoch (\d+)", 1).try_cast("bigint").alias("epoch"),
        *[_found(F.col("_line"), _pattern(metric)).alias(metric) for metric in LOGGED],
    )


def to_series(values: DataFrame, metrics: list[str]) -> DataFrame:
    """Wide series out of rows ``(job, seq, metric columns)``: the n-th value of each metric goes to epoch n."""
    long = values.unpivot(["job", "seq"], metrics, "metric", "value").dropna(subset=["value"])
    placed = group_positions(long, ["job", "metric"], ["seq"], "epoch")
    return placed.groupBy("job", "epoch").pivot("metric", metrics).agg(F.max("value"))


def parse_metric_lines(logs: DataFrame) -> DataFrame:
    """Series out of both log formats: one line per epoch, or one line per metric. Test lines are skipped."""
    line = F.col("_line")
    lines = logs.filter(~F.col("message").contains("test_total_loss=") & ~F.col("message").contains("test_bce="))
    lines = lines.withColumn("_line", strip(F.col("message")))
    whole = line.startswith("Epoch ") & line.contains("train_total_loss=")
    values = lines.select("job", "seq", *[
        F.when(whole, _found(line, _pattern(metric))).otherwise(_found(line, f"^{_pattern(metric)}$")).alias(metric)
        for metric in LOGGED
    ])
    return to_series(values, list(LOGGED))


def fill_train_mse(series: DataFrame) -> DataFrame:
    """``train_total - train_bce`` for jobs that never logged ``train_mse``."""
    logged = series.groupBy("job").agg(F.count("train_mse").alias("_logged"))
    derived = F.when(F.col("_logged") == 0, F.col("train_total") - F.col("train_bce"))
    filled = series.join(logged, "job").withColumn("train_mse", F.coalesce("train_mse", derived))
    return filled.drop("_logged")


def align_series(series: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Cut every series of a job to the shortest required one; jobs that lack a required series go."""
    lengths = [F.count(name) for name in required or REQUIRED]
    shortest = series.groupBy("job").agg(F.least(*lengths).alias("_n"))
    return series.join(shortest, "job").filter(F.col("epoch") <= F.col("_n")).drop("_n")


def learning_curve(series: DataFrame) -> DataFrame:
    """Training against validation error per epoch, with roots and gap."""
    return series.select(
        "job", "epoch", "train_mse", "val_mse",
        F.sqrt("train_mse").alias("train_rmse"),
        F.sqrt("val_mse").alias("val_rmse"),
        (F.col("val_mse") - F.col("train_mse")).alias("gap"),
    )


def parse_regression_lines(logs: DataFrame) -> DataFrame:
    """Aligned series of a regression job: epoch lines only, test lines left out, validation root derived."""
    metrics = [*REQUIRED_REGRESSION, "lr"]
    line = F.col("_line")
    lines = logs.withColumn("_line", strip(F.col("message")))
    lines = lines.filter(line.startswith("Epoch ") & ~line.contains("test_mse="))
    values = lines.select("job", "seq", *[_found(line, _pattern(metric)).alias(metric) for metric in metrics])
    aligned = align_series(to_series(values, metrics), REQUIRED_REGRESSION)
    return aligned.withColumn("val_rmse", F.sqrt("val_mse"))


def parse_epoch_series(logs: DataFrame) -> DataFrame:
    """Aligned series of epoch lines; jobs without all of the required metrics are left out."""
    series = to_series(parse_epoch_lines(logs).drop("epoch"), list(LOGGED))
    return align_series(series, REQUIRED_EPOCH_LINES)


def best_epoch(history: DataFrame, metric: str, run: str = "job") -> DataFrame:
    """Epoch of the first minimum of a metric per run."""
    rows = history.filter(F.col(metric).isNotNull())
    return rows.groupBy(run).agg(
        F.min_by("epoch", F.struct(metric, "epoch")).alias("best_epoch"), F.min(metric).alias("best_value")
    )


def early_stop(history: DataFrame, metric: str, patience: int, run: str = "job") -> DataFrame:
    """Epoch at which training ends: ``patience`` epochs without a new minimum, else the last epoch."""
    marked = running(history, [run], "epoch", metric, "min", "_before")
    better = F.col("_before").isNull() | (F.col(metric) < F.col("_before"))
    marked = marked.withColumn("_better", F.when(better, F.col("epoch")))
    marked = running(marked, [run], "epoch", "_better", "max", "_last")
    waited = marked.withColumn("_waited", F.col("epoch") - F.coalesce("_better", "_last"))
    ended = F.min(F.when(F.col("_waited") >= patience, F.col("epoch")))
    return waited.groupBy(run).agg(
        F.coalesce(ended, F.max("epoch")).alias("stop_epoch"), ended.isNotNull().alias("stopped_early")
    )


def lr_drops(history: DataFrame, run: str = "job") -> DataFrame:
    """Epochs whose learning rate is below the one before."""
    with_previous = running(history, [run], "epoch", "lr", "last", "previous_lr")
    return with_previous.filter(F.col("lr") < F.col("previous_lr")).select(run, "epoch", "previous_lr", "lr")
