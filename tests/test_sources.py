from __future__ import annotations

import json
import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reclake.contracts import LINKS, RATINGS
from reclake.operators.encoders import build_features
from reclake.session import checkpoint_root, materialize, scratch_path
from reclake.sources import readers as R
from reclake.sources import snapshots as S
from reclake.sources import writers as W
from reclake.sources.featurelog import FeatureLog
from tests.conftest import rows


def test_csv_tree(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "one.csv").write_text("item_id,ext_id\n1,10\n2,\n")
    (tmp_path / "a" / "b" / "two.csv").write_text("item_id,ext_id\n3,30\n")
    (tmp_path / "a" / "notes.txt").write_text("no\n")
    assert rows(R.read_csv_prefix(spark, str(tmp_path), LINKS)) == [(1, 10), (2, None), (3, 30)]
    assert rows(R.read_csv_prefix(spark, str(tmp_path / "none"), LINKS)) == []


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "links.csv").write_text("movieId,imdbId,tmdbId\n1,114709,862\n2,113497,\n3,5,x\n")
    assert rows(R.read_csv_prefix(spark, str(tmp_path), LINKS)) == [(1, 862), (2, None), (3, None)]
    with pytest.raises(ValueError, match="user_id"):
        R.read_csv_prefix(spark, str(tmp_path), RATINGS)
    (tmp_path / "ratings").mkdir()
    (tmp_path / "ratings" / "r.csv").write_text("timestamp,rating,movieId,userId\n964982703,4.0,1,7\n")
    assert rows(R.read_csv_prefix(spark, str(tmp_path / "ratings"), RATINGS)) == [(7, 1, 4.0, 964982703)]


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"item_id": 1, "ext_id": 2}\n\n   \n{"item_id": 3}\n')
    (tmp_path / "y.json").write_text('{"item_id": 4}')
    (tmp_path / "z.txt").write_text('{"item_id": 5}')
    assert rows(R.read_jsonl_prefix(spark, str(tmp_path), LINKS)) == [(1, 2), (3, None), (4, None)]
    assert rows(R.read_jsonl_prefix(spark, str(tmp_path / "none"), LINKS)) == []


def test_parquet_tree(spark, tmp_path):
    base = str(tmp_path / "t")
    spark.range(3).write.parquet(f"{base}/data/year=2020")
    spark.range(2).write.parquet(f"{base}/data/year=2021")
    assert R.read_parquet_tree(spark, base).columns == ["id"] and R.read_parquet_tree(spark, base).count() == 5
    kept = R.read_parquet_tree(spark, f"{base}/data", keep_partitions=True).filter("year = 2021")
    assert kept.count() == 2 and "PartitionFilters: [isnotnull(year" in kept._jdf.queryExecution().toString()


def test_table_first_then_path(spark, tmp_path):
    path = str(tmp_path / "w")
    df = spark.createDataFrame([(1, 2)], LINKS)
    table = f"links_{tmp_path.name}".replace("-", "_")
    (tmp_path / "l.csv").write_text("item_id,ext_id\n7,8\n")
    assert rows(R.read_table_or_path(spark, table, str(tmp_path), "csv", LINKS)) == [(7, 8)]
    assert S.replace_table(df, table, path) == 1
    assert rows(R.read_table_or_path(spark, table, str(tmp_path), "csv", LINKS)) == [(1, 2)]
    assert S.replace_table(df.union(df).select("ext_id", "item_id"), table, path) == 2
    assert rows(spark.table(table)) == [(1, 2), (1, 2)]
    assert rows(R.sql_table(spark, f"select count(*) from {table}")) == [(2,)]
    spark.sql(f"drop table {table}")


@pytest.fixture
def kept_table(spark, tmp_path):
    table = f"kept_{tmp_path.name}".replace("-", "_")
    S.replace_table(spark.createDataFrame([(n, n) for n in range(5)], LINKS), table, str(tmp_path / "w"))
    yield table
    spark.sql(f"drop table {table}")


def test_a_failing_replace_leaves_the_old_rows(spark, kept_table):
    broken = spark.range(0, 2000, 1, 8).select(
        F.col("id").alias("item_id"), F.when(F.col("id") == 1999, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("ext_id"))
    for bad in (broken, spark.createDataFrame([(1, "x")], "item_id long, ext_id string"), spark.range(3)):
        with pytest.raises(PySparkException):
            S.replace_table(bad, kept_table)
        assert rows(spark.table(kept_table)) == [(n, n) for n in range(5)]
    assert [r["version"] for r in S.snapshots(spark, kept_table).collect()] == [1]


def test_readers_keep_their_rows_during_a_replace(spark, kept_table):
    before = spark.table(kept_table)
    assert before.count() == 5
    assert S.replace_table(spark.createDataFrame([(9, 9)], LINKS), kept_table) == 1
    assert rows(before) == [(n, n) for n in range(5)] and rows(spark.table(kept_table)) == [(9, 9)]
    # a table may be replaced by rows read from itself
    assert S.replace_table(spark.table(kept_table).union(spark.table(kept_table)), kept_table) == 2
    assert S.replace_table(spark.createDataFrame([], LINKS), kept_table) == 0 and rows(spark.table(kept_table)) == []


def test_versions_can_be_read_restored_and_expired(spark, kept_table):
    for n in (6, 7, 8):
        S.replace_table(spark.createDataFrame([(n, n)], LINKS), kept_table)
    found = {r["version"]: r["current"] for r in S.snapshots(spark, kept_table).collect()}
    assert found == {1: False, 2: False, 3: False, 4: True}
    assert rows(S.read_snapshot(spark, kept_table, 2)) == [(6, 6)]
    S.restore_snapshot(spark, kept_table, 1)
    assert spark.table(kept_table).count() == 5
    assert S.replace_table(spark.createDataFrame([(5, 5)], LINKS), kept_table) == 1
    assert sorted(r["version"] for r in S.snapshots(spark, kept_table).collect()) == [1, 2, 3, 4, 5]
    S.restore_snapshot(spark, kept_table, 1)
    assert S.expire_snapshots(spark, kept_table, keep=2) == [2, 3]  # 1 is the current one
    assert spark.table(kept_table).count() == 5
    with pytest.raises(ValueError, match="no version 2"):
        S.read_snapshot(spark, kept_table, 2)


def test_another_writer_is_noticed(spark, kept_table, monkeypatch):
    places = iter([S.table_location(spark, kept_table), "elsewhere"])
    monkeypatch.setattr(S, "table_location", lambda *_: next(places))
    with pytest.raises(S.ReplacedMeanwhile):
        S.replace_table(spark.createDataFrame([(1, 1)], LINKS), kept_table)
    assert spark.table(kept_table).count() == 5


def test_tables_made_elsewhere_are_taken_over(spark, tmp_path):
    table = f"plain_{tmp_path.name}".replace("-", "_")
    spark.range(3).write.option("path", str(tmp_path / "plain")).saveAsTable(table)
    assert S.replace_table(spark.range(7), table) == 7 and spark.table(table).count() == 7
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 3
    spark.sql(f"drop table {table}")
    spark.range(3).withColumn("p", F.lit(1)).write.partitionBy("p").option("path", str(tmp_path / "parts")).saveAsTable(table)
    with pytest.raises(ValueError, match="partitioned"):
        S.replace_table(spark.table(table), table)
    spark.sql(f"drop table {table}")


def test_assets_and_inventory(spark, tmp_path):
    for name in ("1.jpg", "x.jpg", "2.png", "30.jpg", "4.jpg.tmp"):
        (tmp_path / "posters").mkdir(exist_ok=True)
        (tmp_path / "posters" / name).write_bytes(b"123")
    files = R.list_files(spark, str(tmp_path / "posters"))
    assert files.columns == ["path", "length"] and files.count() == 5
    assert rows(R.listed_ids(files)) == [(1,), (30,)] and rows(R.listed_ids(files, ".png")) == [(2,)]
    assert rows(R.asset_ids(spark, str(tmp_path / "posters"))) == [(1,), (30,)]
    assert rows(R.asset_ids(spark, str(tmp_path / "none"))) == []
    found = rows(R.dataset_inventory(spark, str(tmp_path), ["posters", "train"]))
    assert found == [("posters", 5, 15, True), ("train", 0, 0, False)]


def test_assets_are_made_by_tasks(spark, tmp_path):
    from reclake.workloads.storage import _touch

    names = [f"{root}{tmp_path}/posters/brand-{at % 3}/{at}.jpg" for at, root in enumerate(["", "file:", "file://"] * 40)]
    _touch(spark.createDataFrame([(name,) for name in [*names, names[0]]], "path string").repartition(4))
    assert sorted(path.name for path in (tmp_path / "posters").rglob("*.jpg")) == sorted(f"{at}.jpg" for at in range(120))
    assert {path.stat().st_size for path in (tmp_path / "posters").rglob("*.jpg")} == {1}
    found = R.asset_ids(spark, f"{tmp_path}/posters")
    assert sorted(row["item_id"] for row in found.collect()) == list(range(120))
    assert spark.conf.get("spark.sql.files.openCostInBytes") == "4194304b"


def test_large_files_of_the_compaction_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from reclake.workloads import storage
    from reclake.workloads.registry import QUERIES

    monkeypatch.setattr(storage, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    small = {f"spark.sql.adaptive.{name}": "16KB" for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        found = QUERIES["s6_compact"](spark, "/root/testdata/sf0.01").agg(F.sum("n"), F.min("within").cast("string")).first()
    finally:
        for name in small:
            spark.conf.unset(name)
    # 64 small files, and the large ones
    assert found[0] == 60_000 and found[1] == "true" and len(list((tmp_path / "small-files").glob("*.parquet"))) > 70


def test_first_fit_decreasing():
    draw = random.Random(8)
    for size in (0, 1, 2, 50, 333):
        lengths = [draw.randrange(0, 100) for _ in range(size)]
        bins = []
        for at in sorted(range(size), key=lambda at: -lengths[at]):
            room = next((n for n, held in enumerate(bins) if sum(lengths[x] for x in held) + lengths[at] <= 100), None)
            if room is None:
                bins.append([])
                room = len(bins) - 1
            bins[room].append(at)
        wanted = {at: n for n, held in enumerate(bins) for at in held}
        assert dict(enumerate(R.first_fit(lengths, 100))) == wanted


@pytest.mark.parametrize("group_files", [10, 50_000])
def test_files_of_mixed_sizes_are_packed(spark, group_files):
    draw = random.Random(9)
    lengths = [draw.choice([0, 10, 300, 999, 1000, 1001, 5500]) for _ in range(80)]
    files = spark.createDataFrame([(f"f{at}", length) for at, length in enumerate(lengths)], "file string, length long")
    packed = R.pack_files(files, 1000, group_files).collect()
    assert sorted(row["file"] for row in packed) == sorted(f"f{at}" for at in range(80))
    held = Counter()
    for row in packed:
        assert row["pieces"] == max(1, -(-row["length"] // 1000))
        for piece in range(row["pieces"]):
            held[row["bin"] + piece] += row["length"] / row["pieces"]
    assert max(held.values()) <= 1000
    if group_files > 80:
        assert len(held) <= sum(lengths) / 1000 * 1.3 + 1
    assert R.pack_files(files.filter("false"), 1000).count() == 0


def test_packed_reads_hold_every_row_in_few_partitions(spark, tmp_path):
    path = str(tmp_path / "many files")
    spark.range(1000).repartition(40).write.parquet(path)
    spark.range(1000, 60_000).coalesce(1).write.mode("append").parquet(path)
    largest = max(file.stat().st_size for file in (tmp_path / "many files").glob("*.parquet"))
    packed = R.read_packed(spark, path, 20_000)
    assert rows(packed) == [(n,) for n in sorted(range(60_000), key=lambda n: str((n,)))]
    packed.write.parquet(str(tmp_path / "few"))
    sizes = [file.stat().st_size for file in (tmp_path / "few").glob("*.parquet")]
    assert len(sizes) < 40 and len(sizes) > largest // 20_000


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "one [1].csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,4\n")
    (tmp_path / "two.csv").write_text("\ufefftimestamp,note,rating,movieId,userId\r\n8,x,1.5,6,5\r\n")
    (tmp_path / "three.csv").write_text("user_id,item_id,rating,ts\n9,9,bad,9\n10,10\n")
    (tmp_path / "four.csv").write_text("userId,movieId,rating,timestamp\n11,12,0.5,14\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only a header.csv").write_text("rating,userId,movieId,timestamp\n")
    assert len(R.csv_headers(spark, str(tmp_path))) == 4
    found = R.read_csv_prefix(spark, str(tmp_path), RATINGS)
    assert found.schema.fieldNames() == RATINGS.fieldNames()
    assert {tuple(row) for row in found.collect()} == {(1, 2, 3.5, 4), (5, 6, 1.5, 8), (9, 9, None, 9), (10, 10, None, None), (11, 12, 0.5, 14)}
    (tmp_path / "short.csv").write_text("userId,movieId\n1,2\n")
    with pytest.raises(ValueError, match="rating"):
        R.read_csv_prefix(spark, str(tmp_path), RATINGS)


def test_csv_headers_are_found_in_large_files(spark, tmp_path):
    spark.range(20_000).selectExpr("id as item_id", "id as ext_id").coalesce(1).write.option("header", True).csv(str(tmp_path / "x"))
    spark.range(20_000, 20_010).selectExpr("id as ext_id", "id as item_id").coalesce(1).write.option("header", True).csv(str(tmp_path / "y"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert R.read_csv_prefix(spark, str(tmp_path), LINKS).filter("item_id = ext_id").count() == 20_010
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parquet_trees_next_to_other_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t" / "data"))
    (tmp_path / "t" / "metadata").mkdir()
    (tmp_path / "t" / "metadata" / "v1.json").write_text("{}")
    schema = spark.range(1).schema
    for given in (None, schema):
        assert R.read_parquet_tree(spark, str(tmp_path / "t"), given).count() == 3
    odd = tmp_path / "odd names"
    odd.mkdir()
    for at, file in enumerate((tmp_path / "t" / "data").glob("*.parquet")):
        (odd / f"part{at}").write_bytes(file.read_bytes())
    assert R.read_parquet_tree(spark, str(odd)).count() == 3
    with pytest.raises(PySparkException):
        R.read_parquet_tree(spark, str(tmp_path / "nowhere"))


def test_training_documents_and_reports(spark, tmp_path):
    document = {"mode": "regression", "training_history": {"train_mse": [0.5, 0.4], "val_mse": [0.6, 0.3], "lr": [0.1, 0.1]}}
    (tmp_path / "training_metrics.json").write_text(json.dumps(document, indent=2))
    history = R.read_training_history(spark, str(tmp_path / "training_metrics.json"))
    assert rows(history.select("epoch", "train_mse", "val_mse", "val_bce")) == [(1, 0.5, 0.6, None), (2, 0.4, 0.3, None)]
    report = {"mode": "twoheads", "test_pointwise": {"mse": 0.03, "confusion_matrix": {"tp": 1, "fp": 2, "fn": 3, "tn": 4}}}
    (tmp_path / "report.json").write_text(json.dumps(report, indent=1))
    row = R.read_report(spark, str(tmp_path / "report.json")).first()
    assert (row["mode"], row["test_pointwise"]["confusion_matrix"]["tn"], row["precision_recall"]) == ("twoheads", 4, None)


def test_feature_sinks(spark, tmp_path):
    ratings = spark.createDataFrame([(7, 3, 1.0, 1), (5, 9, 5.0, 90_000), (7, 9, 3.0, 7_200)], RATINGS)
    movies = spark.createDataFrame([(3, ["War"])], "item_id long, genres array<string>")
    features, encoders = build_features(ratings, movies)
    path = str(tmp_path / "log")
    W.append_features(features, path)
    W.append_features(features.filter("user_id = 5").withColumn("rating", F.lit(2.0)).withColumn("ts", F.lit(95_000)), path)
    log = R.read_parquet_tree(spark, path, keep_partitions=True)
    assert log.count() == 4 and {(row["year"], row["day"], row["hour"]) for row in log.collect()} >= {(1970, 2, 1), (1970, 1, 0)}
    newest = {row["record_id"]: row["rating"] for row in W.latest_records(log).collect()}
    assert newest == {"7_3": 1.0, "5_9": 2.0, "7_9": 3.0}

    W.write_features(features, str(tmp_path / "features"))
    assert spark.read.parquet(str(tmp_path / "features")).columns == W.FEATURE_COLUMNS
    W.write_encoders(encoders, str(tmp_path / "encoders"))
    found = W.read_encoders(spark, str(tmp_path / "encoders"))
    assert rows(found.users) == [(5, 0), (7, 1)] and rows(found.genres) == [("Desconocido", 0), ("War", 1)]
    vectors = spark.createDataFrame([(1, [1.0], [2.0])], "item_id int, text_emb array<double>, img_emb array<double>")
    W.write_embeddings(vectors, str(tmp_path / "vectors"))
    assert rows(W.read_embeddings(spark, str(tmp_path / "vectors"))) == [(1, [1.0], [2.0])]


LOGGED = "record_id string, event_time string, value int, is_deleted boolean"


def _kept(log, commit=None):
    return {r["record_id"]: r["value"] for r in log.records(commit).collect()}


def test_feature_log_versions_deletes_and_compaction(spark, tmp_path):
    log = FeatureLog(spark, str(tmp_path / "log"), buckets=4)
    with pytest.raises(ValueError, match="empty"):
        log.records()
    record = lambda *given: spark.createDataFrame(given, LOGGED)
    assert log.append(record(*[(f"r{n}", "2024-01-01", n, False) for n in range(20)])) == 1
    log.append(record(("r1", "2024-01-03", 100, False), ("r2", "2023-12-31", 200, False), ("r3", "2024-01-01", 300, False)))
    wanted = {f"r{n}": n for n in range(20)} | {"r1": 100, "r3": 300}  # r2 came late, r3 is as old and was written later
    assert _kept(log) == wanted
    log.append(record(("r1", "2024-01-02", None, True), ("r4", "2024-01-02", None, True), ("r5", "2024-01-02", None, True)))
    log.append(record(("r5", "2024-01-04", 500, False)))
    del wanted["r4"]
    wanted["r5"] = 500  # r1 was deleted before its newest version
    assert _kept(log) == wanted
    assert log.compact() == 5 and _kept(log) == wanted and {kind for kind, _, _ in log.parts()} == {"base"}
    assert log.compact() == 5
    assert _kept(log, 4) == wanted and len(_kept(log, 2)) == 20


def test_feature_log_rewrites_touched_buckets_only(spark, tmp_path):
    log = FeatureLog(spark, str(tmp_path / "log"), buckets=8)
    log.append(spark.createDataFrame([(f"r{n}", "2024-01-01", n, False) for n in range(200)], LOGGED))
    log.compact()
    before = set(log.parts())
    log.append(spark.createDataFrame([("r7", "2024-01-02", -7, False)], LOGGED))
    log.compact()
    after = set(log.parts())
    assert len(before) == len(after) == 8 and len(before & after) == 7
    gone = log.vacuum()
    assert len(gone) == 10 and len(_kept(log)) == 200 and _kept(log)["r7"] == -7  # 8 + 1 deltas and the old bucket


def test_feature_log_without_survivors_and_with_two_writers(spark, tmp_path):
    log = FeatureLog(spark, str(tmp_path / "log"), buckets=2)
    log.append(spark.createDataFrame([("a", "2024-01-01", 1, False)], LOGGED))
    log.append(spark.createDataFrame([("a", "2024-01-02", None, True)], LOGGED))
    log.compact()
    assert log.parts() == [] and log.last_commit() == 3 and _kept(log) == {}
    log.append(spark.createDataFrame([("b", "2024-01-01", 2)], "record_id string, event_time string, value int"))
    assert _kept(log) == {"b": 2}
    with pytest.raises(PySparkException):
        log._commit(4, [], log.schema())  # the other writer was first
    log.append(spark.createDataFrame([("c", "2024-01-01", 3, "x")], "record_id string, event_time string, value int, more string"))
    assert {r["record_id"]: (r["value"], r["more"]) for r in log.records().collect()} == {"b": (2, None), "c": (3, "x")}
    with pytest.raises(ValueError, match="value"):
        log.append(spark.createDataFrame([("d", "2024-01-01", "four")], "record_id string, event_time string, value string"))


def test_a_failing_append_changes_nothing(spark, tmp_path):
    log = FeatureLog(spark, str(tmp_path / "log"), buckets=2)
    log.append(spark.createDataFrame([("a", "2024-01-01", 1, False)], LOGGED))
    with pytest.raises(PySparkException):
        log.append(spark.range(50).select(
            F.col("id").cast("string").alias("record_id"), F.lit("2025-01-01").alias("event_time"),
            F.when(F.col("id") == 49, F.raise_error(F.lit("no")).cast("int")).otherwise(1).alias("value")))
    assert log.last_commit() == 1 and _kept(log) == {"a": 1}
    log.append(spark.createDataFrame([("b", "2024-01-01", 2, False)], LOGGED))
    assert _kept(log) == {"a": 1, "b": 2}


def test_splits_json_and_reports(spark, tmp_path):
    df = spark.range(10).withColumn("text", F.lit("año"))
    W.write_splits({"train": df, "val": df.limit(2)}, str(tmp_path / "s"), max_files=1)
    assert spark.read.parquet(str(tmp_path / "s" / "train")).count() == 10
    assert len(list((tmp_path / "s" / "train").glob("*.parquet"))) == 1
    W.write_jsonl(df, str(tmp_path / "j"))
    assert "año" in next((tmp_path / "j").glob("*.json")).read_text(encoding="utf-8")
    W.write_report(spark.createDataFrame([("m", 0.5)], "model string, rmse double"), str(tmp_path / "r"))
    texts = [text for part in (tmp_path / "r").glob("*.txt") for text in part.read_text().splitlines()]
    assert [json.loads(text) for text in texts] == [{"model": "m", "rmse": 0.5}]


def test_scratch_folder(spark):
    assert scratch_path(spark, "a").startswith(f"{checkpoint_root(spark)}/reclake/")
    df = spark.range(5)
    kept = materialize(df, "ids")
    assert rows(kept) == rows(df) and kept.inputFiles()


def test_a_cluster_must_name_its_folder():
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Cluster)


def test_local_mode_without_the_setting_gets_its_own_folder(tmp_path):
    """In a process of its own: the setting is fixed once a session runs."""
    script = (
        "import os\n"
        "from reclake.session import build_session, checkpoint_root, clear_scratch, materialize\n"
        "spark = build_session('alone', 'local[1]')\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert checkpoint_root(spark) == checkpoint_root(spark)\n"
        "kept = materialize(spark.range(3), 'ids')\n"
        "assert kept.count() == 3\n"
        "clear_scratch(spark)\n"
        "assert not any(os.path.exists(name.removeprefix('file://')) for name in kept.inputFiles())\n"
    )
    root = Path(__file__).resolve().parent.parent
    given = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(root)}
    done = subprocess.run([sys.executable, "-c", script], env=given, capture_output=True, text=True, timeout=180, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]


def test_feature_log_moves_rows_only_to_merge(spark, tmp_path):
    log = FeatureLog(spark, str(tmp_path / "log"), buckets=2)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    written = []
    keep, log_write = log._write, lambda rows, *more: written.append(plan(rows)) or keep(rows, *more)
    object.__setattr__(log, "_write", log_write)
    rows = spark.range(50).selectExpr("concat('r', id) as record_id", "'2024-01-01' as event_time", "cast(id as int) as value")
    log.append(rows)
    log.append(rows.filter("value < 5").selectExpr("record_id", "event_time", "value + 100 as value"))
    assert "Exchange" in plan(log.records())
    log.compact()
    assert [text.count("Exchange hash") for text in written] == [0, 0, 1]
    assert "Exchange" not in plan(log.records())
    assert _kept(log) == {f"r{n}": n + 100 * (n < 5) for n in range(50)}


def test_feature_log_files_are_ordered_and_packed(spark, tmp_path):
    import pyarrow.parquet as pq

    log, names = FeatureLog(spark, str(tmp_path / "log"), buckets=2), [f"r{n}" for n in range(300)]
    random.Random(4).shuffle(names)
    log.append(spark.createDataFrame([(name, "2024-01-01", 1, False) for name in names], LOGGED).coalesce(1))
    log.compact()
    files = sorted((tmp_path / "log").rglob("*.parquet"))
    assert len({path.parent for path in files}) == 4 and sorted(_kept(log)) == sorted(names)
    for path in files:
        file = pq.ParquetFile(path)
        assert {file.metadata.row_group(0).column(at).compression for at in range(file.metadata.num_columns)} == {"ZSTD"}
        held = file.read().column("record_id").to_pylist()
        assert held == sorted(held) or "base" in str(path)


def test_feature_records_hold_no_genres(spark, monkeypatch):
    from reclake.workloads import storage, tables

    written, plain = {}, storage.materialize

    def kept(df, label):
        written[label] = df.columns
        return plain(df, label)

    monkeypatch.setattr(storage, "materialize", kept)
    monkeypatch.setattr(tables, "materialize", kept)
    t = tables.Tables(spark, "/root/testdata/sf0.001")
    first = storage.log_versions(t)[0]
    assert "features" not in written and written["feature-records"] == ["record_id", "event_time", "user_id", "item_id", "rating_scaled"]
    assert rows(first) == rows(W.with_record(t.features()[0]).select(*first.columns))


def test_tables_are_packed_where_asked_for(spark):
    import pyarrow.parquet as pq

    from reclake.session import materialize_packed

    for write, codec in ((materialize, "SNAPPY"), (materialize_packed, "ZSTD")):
        stored = write(spark.range(100, numPartitions=1), "packed")
        assert stored.count() == 100
        file = pq.ParquetFile(stored.inputFiles()[0].removeprefix("file:").replace("///", "/"))
        assert file.metadata.row_group(0).column(0).compression == codec
