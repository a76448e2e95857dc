"""Sources and sinks: each query writes derived rows to the scratch folder and reads them back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclake.contracts import COMPARISON, LINKS, RATINGS, WINNER
from reclake.functions.features import event_time
from reclake.operators.cleaning import drop_deleted
from reclake.operators.encoders import apply_features
from reclake.plans.evaluation import report_documents, write_evaluation
from reclake.session import materialize_packed as materialize, scratch_path
from reclake.sources import readers as R
from reclake.sources import snapshots as S
from reclake.sources import writers as W
from reclake.sources.featurelog import FeatureLog
from reclake.workloads.registry import query
from reclake.workloads.scoring import ATTENTION_SQL, bundle
from reclake.workloads.tables import MODELS, Tables


@query("s1_read_csv_prefix", "select user_id, item_id, rating, ts from fx_ratings")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    # Files of one prefix with columns in two orders, under two sets of names, some with a column that nobody asks for.
    one = t.ratings.filter("rating < 3").select(
        F.col("ts").alias("timestamp"), F.lit("x").alias("note"), "rating", F.col("item_id").alias("movieId"), F.col("user_id").alias("userId"))
    other = t.ratings.filter("rating >= 3").select("user_id", "item_id", "rating", "ts")
    one.write.option("header", True).csv(f"{path}/2024/ratings")
    other.write.option("header", True).csv(f"{path}/2025")
    return R.read_csv_prefix(t.spark, path, RATINGS)


@query("s2_read_jsonl_prefix", "select item_id, title, director, coalesce(asset_path, '(none)') as asset_path from fx_catalog")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "jsonl")
    W.write_jsonl(t.catalog, f"{path}/movies")
    found = R.read_jsonl_prefix(t.spark, path, t.catalog.schema)
    return found.select("item_id", "title", "director", F.coalesce("asset_path", F.lit("(none)")).alias("asset_path"))


@query("s3_read_parquet_tree", "select user_id, item_id, rating, ts from fx_interactions")
def _(t: Tables) -> DataFrame:
    # The folder holds a table's data next to a description of it in another format.
    path = scratch_path(t.spark, "tree")
    t.interactions.write.parquet(f"{path}/data/part=a")
    t.links.limit(1).write.json(f"{path}/metadata")
    return R.read_parquet_tree(t.spark, path)


@query("s4_read_table_or_path", """
    select 'path' as source, item_id, ext_id from fx_links where ext_id is not null
    union all select 'table', item_id, ext_id from fx_links where ext_id > 100500""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "links")
    t.links.write.option("header", True).csv(path)
    table = f"links_{path.rsplit('-', 1)[-1]}"
    before = R.read_table_or_path(t.spark, table, path, "csv", LINKS).dropna().withColumn("source", F.lit("path"))
    S.replace_table(t.links.filter("ext_id > 100500"), table, scratch_path(t.spark, "warehouse"))
    after = R.read_table_or_path(t.spark, table, path, "csv", LINKS).withColumn("source", F.lit("table"))
    return before.unionByName(after)


def _touch(paths: DataFrame) -> None:
    """Files of one byte, as an object store would list them, written by the tasks; Spark's listing leaves out empty files."""

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {}
        for batch in batches:
            for path in batch.column("path").to_pylist():
                folder, name = path.rsplit("/", 1)
                if folder not in places:
                    places[folder] = FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))
                    places[folder][0].create_dir(places[folder][1], recursive=True)
                system, place = places[folder]
                with system.open_output_stream(f"{place}/{name}") as stream:
                    stream.write(b"\0")
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    paths.mapInArrow(touch, "files bigint").agg(F.sum("files")).collect()


@query("s5_asset_ids", """
    select distinct p_partkey as item_id from part where p_type <> 'PROMO'""")
def _(t: Tables) -> DataFrame:
    # One file per part, in a folder per brand; names of promotional parts are no numbers.
    base = scratch_path(t.spark, "posters")
    key = F.col("p_partkey").cast("string")
    name = F.when(F.col("p_type") == "PROMO", F.concat(F.lit("promo-"), key)).otherwise(key)
    folder = F.translate("p_brand", "#", "-")
    names = t.read("part").select(F.concat(F.lit(f"{base}/"), folder, F.lit("/"), name, F.lit(".jpg")).alias("path"))
    _touch(names.repartition(t.spark.sparkContext.defaultParallelism))
    return R.asset_ids(t.spark, base)


@query("s6_compact", """
    select user_id, count(*) as n, true as within from fx_ratings group by user_id""")
def _(t: Tables) -> DataFrame:
    """Small files and large ones, read in partitions of 64 KB of files; ``within`` says that no partition holds more."""
    path, target = scratch_path(t.spark, "small-files"), 65_536
    t.ratings.filter("user_id % 2 = 0").repartition(64).write.parquet(path)
    t.ratings.filter("user_id % 2 = 1").hint("rebalance").write.mode("append").parquet(path)
    sizes = R.list_files(t.spark, path).select(F.col("path").alias("file"), "length")
    packed = R.pack_files(sizes, target)
    full = packed.filter("pieces = 1").groupBy("bin").agg(F.sum("length").alias("total")).agg(F.coalesce(F.max("total"), F.lit(0)))
    cut = packed.agg(F.max(F.col("length") / F.col("pieces")))
    within = (full.scalar() <= target) & (cut.scalar() <= target)
    return R.read_packed(t.spark, path, target).groupBy("user_id").agg(F.count("*").alias("n")).withColumn("within", within)


@query("s7_sql_table", """
    select l_returnflag as flag, count(*) as n, count(distinct l_partkey) as items from lineitem group by l_returnflag""")
def _(t: Tables) -> DataFrame:
    return R.sql_table(
        t.spark,
        "select l_returnflag as flag, count(*) as n, count(distinct l_partkey) as items from {lines} group by l_returnflag",
        lines=t.read("lineitem"),
    )


@query("s8_training_history", """
    select vec_id as job, cast(pos + 1 as bigint) as epoch, embedding[pos + 1]::double as val_mse, embedding[pos + 1]::double / 2 as train_mse
    from (select vec_id, embedding, unnest(range(len(embedding))) as pos from embeddings)""")
def _(t: Tables) -> DataFrame:
    # One document per vector, whose values stand for the errors of a run.
    path = scratch_path(t.spark, "histories")
    values = F.col("embedding").cast("array<double>")
    runs = t.read("embeddings").select(
        F.col("vec_id").cast("string").alias("mode"),
        F.struct(values.alias("val_mse"), F.transform(values, lambda x: x / 2).alias("train_mse")).alias("training_history"),
    )
    W.write_jsonl(runs, path)
    history = R.read_training_history(t.spark, path, run=F.col("mode"), lines=True)
    return history.select(F.col("run").cast("bigint").alias("job"), "epoch", "val_mse", "train_mse")


@query("s9_read_report", """
    select r.model as mode, r.rmse_stars, r.tp, c.rmse_stars as cold_rmse_stars, g.hit_rate_at_k, k.precision_at_k
    from fx_pointwise r join fx_pointwise c on r.model = c.model and c.dataset = 'coldstart'
    join fx_ranking g on g.model = r.model join fx_at_k k on k.model = r.model and k.dataset = 'test'
    where r.dataset = 'test'""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "reports")
    W.write_report(report_documents(bundle(t)), path)
    return R.read_report(t.spark, path, lines=True).select(
        "mode", "test_pointwise.rmse_stars", "test_pointwise.confusion_matrix.tp",
        F.col("coldstart_pointwise.rmse_stars").alias("cold_rmse_stars"),
        "ranking_true_neg.hit_rate_at_k", "precision_recall.precision_at_k",
    )


@query("s10_dataset_inventory", """
    select name, exists (select 1 from fx_split s where s.split = name) as found,
      case when name = 'embeddings' then 0 else 1 end as files, name <> 'embeddings' as has_bytes
    from (select unnest(['train', 'val', 'test', 'embeddings']) as name)""")
def _(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "datasets")
    split = t.split()
    W.write_splits({name: split.filter(F.col("split") == name) for name in ("train", "val", "test")}, base, max_files=1)
    found = R.dataset_inventory(t.spark, base, ["train", "val", "test", "embeddings"])
    return found.select("name", "found", F.col("files").cast("int").alias("files"), (F.col("bytes") > 0).alias("has_bytes"))


@query("k1_write_jsonl", "select doc_id, text, lang from documents")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "documents")
    W.write_jsonl(t.read("documents").select("doc_id", "text", "lang"), path)
    return R.read_jsonl_prefix(t.spark, path, t.read("documents").select("doc_id", "text", "lang").schema)


def _silver_table(t: Tables) -> str:
    """A table replaced twice: all interactions, then the silver rows; a third replace fails half way."""
    from reclake.workloads.silver import silver

    path = scratch_path(t.spark, "warehouse")
    table = f"silver_{path.rsplit('-', 1)[-1]}"
    S.replace_table(t.interactions, table, path)
    S.replace_table(silver(t), table, path)
    broken = t.interactions.withColumn("rating", F.when(F.col("rating") >= 5, F.raise_error(F.lit("broken row"))).otherwise(F.col("rating")))
    try:
        S.replace_table(broken, table, path)
    except PySparkException:
        return table
    raise RuntimeError("the broken replace went through")


@query("k2_replace_table", "select user_id, item_id, rating, ts from fx_silver")
def _(t: Tables) -> DataFrame:
    return t.spark.table(_silver_table(t))


@query("k2_snapshots", """
    select cast(1 as bigint) as version, true as current, count(*) as rows, sum(rating) as total from fx_interactions
    union all select 2, false, count(*), sum(rating) from fx_silver""")
def _(t: Tables) -> DataFrame:
    table = _silver_table(t)
    S.restore_snapshot(t.spark, table, 1)
    totals = [
        S.read_snapshot(t.spark, table, version).agg(F.count("*").alias("rows"), F.sum("rating").alias("total"))
        .withColumn("version", F.lit(version).cast("long")) for version in (1, 2)
    ]
    return S.snapshots(t.spark, table).select("version", "current").join(totals[0].unionByName(totals[1]), "version")


@query("k3_write_splits", "select split, count(*) as n, sum(rating) as total from fx_split group by split")
def _(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "splits")
    split = t.split()
    W.write_splits({name: split.filter(F.col("split") == name) for name in ("train", "val", "test")}, base)
    return t.spark.read.parquet(*[f"{base}/{name}" for name in ("train", "val", "test")]).groupBy("split").agg(
        F.count("*").alias("n"), F.sum("rating").alias("total")
    )


@query("k4_append_features", """
    select cast(user_id as varchar) || '_' || cast(item_id as varchar) as record_id, user_id, item_id, rating_scaled,
      strftime(make_timestamp(ts * 1000000), '%Y-%m-%dT%H:%M:%SZ') as event_time
    from fx_features""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "feature-log")
    features, _ = t.features()
    W.append_features(features, path)
    return drop_deleted(W.latest_records(R.read_parquet_tree(t.spark, path))).select(
        "record_id", "user_id", "item_id", "rating_scaled", "event_time"
    )


def log_versions(t: Tables) -> list[DataFrame]:
    """Three versions of the feature records: as built; a third of the users rated anew an hour later, with some late rows that are
    older; every fifth item deleted another hour later, and one in ten of these written again."""
    # genre texts and vectors are no part of a record, so they are not moved and stored along with it
    features = apply_features(t.stored(), t.feature_fit())
    first = materialize(W.with_record(features).select("record_id", "event_time", "user_id", "item_id", "rating_scaled"), "feature-records")
    moved = lambda hours: event_time(F.unix_timestamp("event_time", "yyyy-MM-dd'T'HH:mm:ssX") + hours * 3600)
    anew = first.filter("user_id % 3 = 0").withColumn("rating_scaled", 1 - F.col("rating_scaled"))
    late = first.filter("user_id % 3 = 1").withColumn("rating_scaled", F.lit(-1.0)).withColumn("event_time", moved(-1))
    gone = first.filter("item_id % 5 = 0").withColumn("event_time", moved(2)).withColumn("is_deleted", F.lit(True))
    back = first.filter("item_id % 50 = 0").withColumn("event_time", moved(3)).withColumn("is_deleted", F.lit(False))
    return [first, anew.withColumn("event_time", moved(1)).unionByName(late), gone.unionByName(back)]


@query("k4_feature_log", """
    with moved as (select cast(user_id as varchar) || '_' || cast(item_id as varchar) as record_id, user_id, item_id, rating_scaled, ts from fx_features),
      log as (select *, ts as moved_at, false as gone, 1 as version from moved
        union all select record_id, user_id, item_id, 1 - rating_scaled, ts, ts + 3600, false, 2 from moved where user_id % 3 = 0
        union all select record_id, user_id, item_id, -1.0::double, ts, ts - 3600, false, 2 from moved where user_id % 3 = 1
        union all select record_id, user_id, item_id, rating_scaled, ts, ts + 7200, true, 3 from moved where item_id % 5 = 0
        union all select record_id, user_id, item_id, rating_scaled, ts, ts + 10800, false, 3 from moved where item_id % 50 = 0),
      newest as (select *, row_number() over (partition by record_id order by moved_at desc, version desc) as rn from log)
    select state, record_id, user_id, item_id, rating_scaled, strftime(make_timestamp(moved_at * 1000000), '%Y-%m-%dT%H:%M:%SZ') as event_time
    from newest, (select unnest(['deltas', 'half merged', 'merged']) as state) where rn = 1 and not gone""")
def _(t: Tables) -> DataFrame:
    versions = log_versions(t)
    states = []
    for state in ("deltas", "half merged", "merged"):
        log = FeatureLog(t.spark, scratch_path(t.spark, "feature-log"), buckets=8)
        for number, version in enumerate(versions, 1):
            log.append(version)
            if number == (2 if state == "half merged" else 3 if state == "merged" else 0):
                log.compact()
        states.append(log.records().withColumn("state", F.lit(state)))
    return states[0].unionByName(states[1]).unionByName(states[2])


@query("k5_write_features", "select user_id, item_id, rating, ts, genres, rating_scaled, user_idx, item_idx, multihot from fx_features")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "features")
    features, _ = t.features()
    W.write_features(features, path)
    multihot = F.array_join(F.col("genres_multihot").cast("array<string>"), ",").alias("multihot")
    return t.spark.read.parquet(path).select("*", multihot).drop("genres_multihot")


@query("k6_encoders", """
    select 'users' as encoder, cast(user_id as varchar) as value, user_idx as idx from fx_user_dim
    union all select 'items', cast(item_id as varchar), item_idx from fx_item_dim
    union all select 'genres', word, idx from fx_vocabulary""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "encoders")
    W.write_encoders(t.features()[1], path)
    found = W.read_encoders(t.spark, path)
    tables = [
        getattr(found, name).select(
            F.lit(name).alias("encoder"), F.col("value").cast("string").alias("value"), F.col("idx").cast("bigint").alias("idx")
        )
        for name in ("users", "items", "genres")
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query("k7_embeddings", """
    select vec_id as item_id, round(list_sum(list_transform(embedding, lambda x: x::double)), 4) as total,
      cast(len(embedding) as bigint) as dim from embeddings""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "embeddings")
    W.write_embeddings(t.vectors.withColumn("img_emb", F.col("text_emb")), path)
    total = F.aggregate("text_emb", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return W.read_embeddings(t.spark, path).select(
        "item_id", F.round(total, 4).alias("total"), F.size("img_emb").cast("bigint").alias("dim")
    )


@query("k8_write_report", f"""
    select 'report' as document, r.model, r.rmse_stars, r.f1, r.n_samples, a.text_pct, c.text_pct as cold_text_pct, s.score
    from fx_rates r join fx_scores s on r.model = s.model join ({ATTENTION_SQL}) a on a.model = r.model and a.dataset = 'test'
    join ({ATTENTION_SQL}) c on c.model = r.model and c.dataset = 'coldstart' where r.dataset = 'test'
    union all select * from (select d.document, s.model, s.rmse_stars, r.f1, r.n_samples, a.text_pct, c.text_pct, s.score
      from fx_scores s join fx_rates r on r.model = s.model and r.dataset = 'test' join ({ATTENTION_SQL}) a on a.model = s.model and a.dataset = 'test'
      join ({ATTENTION_SQL}) c on c.model = s.model and c.dataset = 'coldstart', (select unnest(['comparison', 'winner']) as document) d
      qualify row_number() over (partition by d.document order by s.score desc, s.model = 'twoheads' desc) = 1)""")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "evaluation")
    write_evaluation(bundle(t), path, at=F.to_timestamp(F.lit("2024-01-02 03:04:05")))
    reports = R.read_report(t.spark, f"{path}/reports/evaluation", lines=True)
    comparison = t.spark.read.schema(COMPARISON).json(f"{path}/reports/model_comparison")
    winner = t.spark.read.schema(WINNER).json(f"{path}/winner")
    scores = comparison.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"{name}_score").alias("score")) for name in MODELS])).alias("s")).select("s.*")
    rows = reports.join(scores, F.col("mode") == F.col("model")).select(
        F.lit("report").alias("document"), "model", "summary.rmse_stars", F.col("test_pointwise.f1_quality").alias("f1"),
        "test_pointwise.n_samples", "test_pointwise.explainability.text_pct",
        F.col("coldstart_pointwise.explainability.text_pct").alias("cold_text_pct"), F.round("score", 6).alias("score"))
    of_report = rows.select("model", "n_samples", "cold_text_pct")
    best = [
        comparison.select(F.lit("comparison").alias("document"), F.col("winner").alias("model"), "winner_summary.*", F.greatest(
            *[F.col(f"{name}_score") for name in MODELS]).alias("score")),
        winner.filter("evaluation_timestamp = '2024-01-02T03:04:05Z' and evaluation_config.num_decoys = 99").select(
            F.lit("winner").alias("document"), F.col("winner_model").alias("model"), "winner_metrics.*", F.col("winner_score").alias("score")),
    ]
    named = best[0].unionByName(best[1]).join(of_report, "model").select(
        "document", "model", "rmse_stars", F.col("f1_quality").alias("f1"), "n_samples", "explainability.text_pct", "cold_text_pct",
        F.round("score", 6).alias("score"))
    return rows.unionByName(named)
