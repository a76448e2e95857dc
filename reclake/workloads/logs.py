"""Run-log analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclake.operators import runlogs as L
from reclake.operators.positions import group_positions
from reclake.workloads.registry import query
from reclake.workloads.tables import Tables

MISSING = -1.0


def _filled(df: DataFrame, *names: str) -> DataFrame:
    """Missing values as -1, the same in both engines."""
    return df.select("job", "epoch", *[F.coalesce(name, F.lit(MISSING)).alias(name) for name in names])


@query("l1_parse_epoch_lines", """
    select job, seq, epoch, coalesce(train_total, -1) as train_total, coalesce(train_bce, -1) as train_bce,
      coalesce(train_mse, -1) as train_mse, coalesce(lr, -1) as lr from fx_parsed""")
def _(t: Tables) -> DataFrame:
    lines = L.parse_epoch_lines(t.logs)
    names = ("train_total", "train_bce", "train_mse", "lr")
    return lines.select("job", "seq", "epoch", *[F.coalesce(name, F.lit(MISSING)).alias(name) for name in names])


@query("l2_parse_metric_lines", """
    select job, epoch, coalesce(train_total, -1) as train_total, coalesce(train_bce, -1) as train_bce,
      coalesce(train_mse, -1) as train_mse, coalesce(val_mse, -1) as val_mse, coalesce(val_rmse_stars, -1) as val_rmse_stars,
      coalesce(lr, -1) as lr from fx_series""")
def _(t: Tables) -> DataFrame:
    return _filled(
        L.parse_metric_lines(t.logs), "train_total", "train_bce", "train_mse", "val_mse", "val_rmse_stars", "lr"
    )


@query("l3_fill_train_mse", """
    select job, row_number() over (partition by job order by seq) as epoch, train_total, round(train_total - train_bce, 6) as train_mse
    from fx_parsed""")
def _(t: Tables) -> DataFrame:
    series = L.to_series(L.parse_epoch_lines(t.logs).drop("epoch"), list(L.LOGGED))
    return L.fill_train_mse(series).select("job", "epoch", "train_total", F.round("train_mse", 6).alias("train_mse"))


@query("l4_align_series", """
    select job, epoch, train_total, train_bce, train_mse, val_mse, val_rmse_stars, coalesce(lr, -1) as lr from fx_aligned""")
def _(t: Tables) -> DataFrame:
    aligned = L.align_series(L.fill_train_mse(L.parse_metric_lines(t.logs)))
    return _filled(aligned, "train_total", "train_bce", "train_mse", "val_mse", "val_rmse_stars", "lr")


@query("l4_epoch_series", """
    with lines as (select user_id % 10 as job, event_id as seq, event_type, cast(value as varchar) as v from events where user_id % 10 <> 3),
      tr as (select job, v, row_number() over (partition by job order by seq) as epoch from lines),
      va as (select job, v, row_number() over (partition by job order by seq) as epoch from lines where event_type <> 'error')
    select tr.job, tr.epoch, cast(tr.v as double) as train_total, cast('1' || va.v as double) as val_total, cast('3' || va.v as double) as val_bce,
      cast('2' || va.v as double) as val_mse, cast('4' || va.v as double) as val_rmse_stars
    from tr join va on tr.job = va.job and tr.epoch = va.epoch""")
def _(t: Tables) -> DataFrame:
    """Series of epoch lines, cut to the shortest; a job that lacks a required metric is left out."""
    return L.parse_epoch_series(t.epoch_logs).select("job", "epoch", "train_total", "val_total", "val_bce", "val_mse", "val_rmse_stars")


@query("l5_learning_curve", """
    select job, epoch, train_mse, val_mse, round(sqrt(train_mse), 6) as train_rmse, round(sqrt(val_mse), 6) as val_rmse,
      round(val_mse - train_mse, 6) as gap from fx_aligned""", digits=6)
def _(t: Tables) -> DataFrame:
    return L.learning_curve(L.align_series(L.parse_metric_lines(t.logs)))


@query("l6_parse_regression_lines", """
    with lines as (select job, seq, try_cast(regexp_extract(message, 'train_mse=([0-9.]+);', 1) as double) as train_mse,
        try_cast(regexp_extract(message, 'val_mse=([0-9.]+);', 1) as double) as val_mse,
        try_cast(regexp_extract(message, 'val_rmse_stars=([0-9.]+);', 1) as double) as val_rmse_stars,
        try_cast(regexp_extract(message, 'lr=([0-9.eE+\\-]+);', 1) as double) as lr
      from fx_regression_logs where not contains(message, 'test_mse=')),
    tr as (select job, train_mse, lr, row_number() over (partition by job order by seq) as epoch from lines),
    va as (select job, val_mse, val_rmse_stars, row_number() over (partition by job order by seq) as epoch from lines where val_mse is not null)
    select tr.job, tr.epoch, train_mse, val_mse, val_rmse_stars, lr, round(sqrt(val_mse), 6) as val_rmse
    from tr join va on tr.job = va.job and tr.epoch = va.epoch""")
def _(t: Tables) -> DataFrame:
    return L.parse_regression_lines(t.regression_logs).withColumn("val_rmse", F.round("val_rmse", 6))


def _histories(t: Tables) -> DataFrame:
    return group_positions(t.history.withColumnRenamed("epoch", "seq"), ["job"], ["seq"], "epoch")


_PLACED = "select job, row_number() over (partition by job order by epoch) as epoch, val_mse, lr from fx_history"


@query("w7_best_epoch", f"""
    select job, epoch as best_epoch, val_mse as best_value from (
      select *, row_number() over (partition by job order by val_mse, epoch) as rn from ({_PLACED})) where rn = 1""")
def _(t: Tables) -> DataFrame:
    return L.best_epoch(_histories(t), "val_mse")


@query("w8_early_stop", f"""
    with h as ({_PLACED}), b as (select *, min(val_mse) over (partition by job order by epoch
        rows between unbounded preceding and 1 preceding) as before from h),
    g as (select *, epoch - max(case when before is null or val_mse < before then epoch end) over (partition by job order by epoch) as waited from b)
    select job, coalesce(min(epoch) filter (where waited >= 12), max(epoch)) as stop_epoch,
      count(*) filter (where waited >= 12) > 0 as stopped_early from g group by job""")
def _(t: Tables) -> DataFrame:
    return L.early_stop(_histories(t), "val_mse", 12)


@query("w9_lr_drops", f"""
    select job, epoch, previous_lr, lr from (select *, lag(lr) over (partition by job order by epoch) as previous_lr from ({_PLACED}))
    where lr < previous_lr""")
def _(t: Tables) -> DataFrame:
    return L.lr_drops(_histories(t))
