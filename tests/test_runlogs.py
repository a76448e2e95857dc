from __future__ import annotations

import pytest

from reclake.operators import runlogs as L
from tests.conftest import rows

# The history of a finished run of 14 epochs.
VAL_RMSE_STARS = [
    0.8017266139478276, 0.777540143696316, 0.7625164759404626, 0.7537180364484073, 0.7475509441409672, 0.7439817559481038,
    0.7404330498066405, 0.7406876348633807, 0.7392546903973816, 0.7422104604276519, 0.7402147162917962, 0.742951877239258,
    0.7425459194040858, 0.7450763802316922,
]
RATES = [0.0003674917687698108] * 12 + [0.0001837458843849054] * 2


@pytest.fixture(scope="module")
def history(spark):
    data = [("run", at, value, rate) for at, (value, rate) in enumerate(zip(VAL_RMSE_STARS, RATES, strict=True), 1)]
    return spark.createDataFrame(data, "job string, epoch long, val_rmse_stars double, lr double")


def logs(spark, *lines):
    return spark.createDataFrame([("j", at, line) for at, line in enumerate(lines)], "job string, seq long, message string")


def test_epoch_series_and_blanks_around_lines(spark):
    line = "Epoch {0} | train_total_loss={0}.5; val_total_loss=2.0; val_bce=0.1; val_mse=0.2; val_rmse_stars=0.{0};"
    framed = logs(spark, f"\t{line.format(1)}\u00a0", line.format(2) + "\r\n", "\u2003Epoch 3 | train_total_loss=3.5;", "noise")
    found = rows(L.parse_epoch_series(framed).select("epoch", "train_total", "val_rmse_stars"))
    assert found == [(1, 1.5, 0.1), (2, 2.5, 0.2)]
    regression = logs(spark, "\tEpoch 1 | train_mse=0.1; val_mse=0.2; val_rmse_stars=0.3;\t")
    assert rows(L.parse_regression_lines(regression).select("train_mse", "val_mse", "val_rmse_stars")) == [(0.1, 0.2, 0.3)]


def test_best_epoch_stop_and_drops(history):
    stop = lambda patience: rows(L.early_stop(history, "val_rmse_stars", patience))
    assert rows(L.best_epoch(history, "val_rmse_stars")) == [("run", 9, 0.7392546903973816)]
    assert stop(5) == [("run", 14, True)]
    assert stop(6) == [("run", 14, False)]
    assert stop(1) == [("run", 8, True)]
    assert rows(L.lr_drops(history).select("job", "epoch")) == [("run", 13)]


def test_first_minimum_wins(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 1.0), ("a", 3, 1.0), ("a", 4, None)], "job string, epoch long, m double")
    assert rows(L.best_epoch(df, "m")) == [("a", 2, 1.0)]


def test_epoch_lines(spark):
    found = L.parse_epoch_lines(logs(
        spark, " Epoch 3 | train_total_loss=1.5; train_bce=0.5; val_mse=0.25; lr=1.00e-03;", "Resumen Epoch 3 | val_mse=9;", "Epoch x | val_mse=1.2.3;",
    )).collect()
    assert len(found) == 2
    first = found[0].asDict()
    assert (first["epoch"], first["train_total"], first["val_mse"], first["lr"], first["train_mse"]) == (3, 1.5, 0.25, 0.001, None)
    assert found[1]["epoch"] is None and found[1]["val_mse"] is None


def test_both_formats(spark):
    series = L.parse_metric_lines(logs(
        spark, "train_total_loss=1.5;", "train_bce=0.5;", "val_mse=0.4;", "xval_mse=9.0;", "val_mse=9.0; more", "test_bce=7.0;",
        "Epoch 2 | train_total_loss=1.2; train_bce=0.4; val_mse=0.3; val_rmse_stars=0.8; lr=1e-4;", " val_rmse_stars=0.7; ", "val_mse=0.2;",
        "Epoch 3 | test_total_loss=1.0; train_total_loss=8.0;",
    ))
    found = {row["epoch"]: row.asDict() for row in series.collect()}
    assert sorted(found) == [1, 2, 3]
    assert [found[at]["val_mse"] for at in (1, 2, 3)] == [0.4, 0.3, 0.2]
    assert [found[at]["train_total"] for at in (1, 2, 3)] == [1.5, 1.2, None]
    assert [found[at]["val_rmse_stars"] for at in (1, 2, 3)] == [0.8, 0.7, None]
    filled = {row["epoch"]: row["train_mse"] for row in L.fill_train_mse(series).collect()}
    assert filled == pytest.approx({1: 1.0, 2: 0.8, 3: None})
    assert L.align_series(series).count() == 0
    assert sorted(row["epoch"] for row in L.align_series(L.fill_train_mse(series)).collect()) == [1, 2]


def test_logged_train_mse_is_kept(spark):
    series = L.parse_metric_lines(logs(spark, "train_total_loss=1.5;", "train_bce=0.5;", "train_total_loss=1.5;", "train_bce=0.5;", "train_mse=0.9;"))
    assert {row["epoch"]: row["train_mse"] for row in L.fill_train_mse(series).collect()} == {1: 0.9, 2: None}


def test_regression_lines(spark):
    series = L.parse_regression_lines(logs(
        spark, "Epoch 1 | train_mse=0.5; val_mse=0.25; val_rmse_stars=2.0; lr=1e-3;", "train_mse=7;", "Epoch 9 | test_mse=0.1; val_mse=3;",
        "Epoch 2 | train_mse=0.4; val_mse=0.16;",
    ))
    found = series.collect()
    assert len(found) == 1 and (found[0]["val_rmse"], found[0]["lr"]) == (0.5, 0.001)
    curve = L.learning_curve(series).first()
    assert curve["gap"] == -0.25 and curve["val_rmse"] == 0.5
