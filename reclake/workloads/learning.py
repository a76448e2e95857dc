"""Encoders, splits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclake.operators import embeddings as M
from reclake.operators import encoders as F_
from reclake.operators import profiles as A
from reclake.operators import sampling as N
from reclake.operators import splits as W
from reclake.session import materialize_packed as materialize
from reclake.workloads.registry import query
from reclake.workloads.tables import Tables
from reclake.workloads.views import decoys, drawn


def _joined(col: str, name: str):
    return F.array_join(F.col(col).cast("array<string>"), ",").alias(name)


@query("f1_minmax_scale", """
    select user_id, item_id, (rating - (select min(rating) from fx_interactions))
      / (select max(rating) - min(rating) from fx_interactions) as rating_scaled from fx_interactions""")
def _(t: Tables) -> DataFrame:
    return F_.minmax_scale(t.interactions).select("user_id", "item_id", "rating_scaled")


@query("f2_labels", """
    select user_id, item_id, dense_rank() over (order by user_id) - 1 as user_idx, dense_rank() over (order by item_id) - 1 as item_idx
    from fx_interactions""")
def _(t: Tables) -> DataFrame:
    rows = t.stored().select("user_id", "item_id")
    labelled = F_.apply_labels(rows, F_.fit_labels(rows, "user_id"), "user_id", "user_idx")
    return F_.apply_labels(labelled, F_.fit_labels(rows, "item_id"), "item_id", "item_idx").select(
        "user_id", "item_id", F.col("user_idx").cast("bigint").alias("user_idx"), F.col("item_idx").cast("bigint").alias("item_idx")
    )


@query("f3_multihot", "select item_id, genres, multihot from fx_item_dim")
def _(t: Tables) -> DataFrame:
    from reclake.operators.joins import enrich_genres

    items = enrich_genres(t.interactions.select("item_id").distinct(), t.movies)
    return F_.apply_multihot(items, F_.fit_multihot(items)).select("item_id", "genres", _joined("genres_multihot", "multihot"))


@query("f4_universe", """
    select 'data' as source, max(user_idx) + 1 as num_users, max(item_idx) + 1 as num_items,
      (select count(*) from fx_vocabulary) as num_categories from fx_features
    union all select 'encoders', (select count(*) from fx_user_dim), (select count(*) from fx_item_dim),
      (select count(*) from fx_vocabulary)""")
def _(t: Tables) -> DataFrame:
    features, encoders = t.features()
    of_data = F_.universe(features).withColumn("source", F.lit("data"))
    return of_data.unionByName(F_.universe(features, encoders).withColumn("source", F.lit("encoders")))


@query("f5_build_features", """
    select user_id, item_id, rating, ts, genres, rating_scaled, user_idx, item_idx, multihot from fx_features""")
def _(t: Tables) -> DataFrame:
    features, _ = F_.build_features(t.stored(), t.movies)
    return features.select(
        "user_id", "item_id", "rating", "ts", "genres", "rating_scaled", F.col("user_idx").cast("bigint").alias("user_idx"),
        F.col("item_idx").cast("bigint").alias("item_idx"), _joined("genres_multihot", "multihot"),
    )


@query("f6_embed_text", """
    with words as (select doc_id, md5(word) as h from (
        select doc_id, unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f\\v]+')) as word from documents) where word <> ''),
      counts as (select doc_id, cast(('0x' || substr(h, 1, 8)) as bigint) % 256 as place,
        sum(case when substr(h, 9, 1) <= '7' then 1 else -1 end) as tf from words group by 1, 2),
      idf as (select place, ln(((select count(*) from documents) + 1)::double / (count(*) + 1)) as idf from counts group by place),
      weights as (select doc_id, place, tf * idf as w from counts join idf using (place) where tf * idf <> 0)
    select doc_id as item_id, place as pos, round(cast(w / sqrt(sum(w * w) over (partition by doc_id)) as float)::double, 5) as weight from weights""")
def _(t: Tables) -> DataFrame:
    docs = t.read("documents").select(F.col("doc_id").alias("item_id"), "text")
    vectors = M.embed_text(docs, "text", 256).select("item_id", F.posexplode("text_emb").alias("pos", "weight")).filter("weight <> 0")
    return vectors.select("item_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("weight").cast("double"), 5).alias("weight"))


@query("f7_assemble_embeddings", """
    select e.vec_id as item_id, m.item_id is not null as has_image, cast(64 as bigint) as dim,
      round(coalesce(list_sum(list_transform(m.img_emb, lambda x: x::double)), 0), 4) as img_total
    from embeddings e left join fx_images m on e.vec_id = m.item_id""")
def _(t: Tables) -> DataFrame:
    total = F.aggregate("img_emb", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return M.assemble_embeddings(t.vectors, t.images, 64).select(
        "item_id", "has_image", F.size("img_emb").cast("bigint").alias("dim"), F.round(total, 4).alias("img_total")
    )


@query("f7_embedding_counts", """
    select count(*) filter (where label < 5) as with_image, count(*) filter (where label >= 5) as without_image from embeddings""")
def _(t: Tables) -> DataFrame:
    return M.embedding_counts(M.assemble_embeddings(t.vectors, t.images, 64))


@query("w1_temporal_split", "select user_id, item_id, rating, ts, split from fx_split")
def _(t: Tables) -> DataFrame:
    return t.split()


@query("w2_temporal_split_pct", """
    select user_id, item_id, case when share <= 0.7::double then 'train' when share <= 0.7::double + 0.15::double then 'val'
      else 'test' end as split
    from (select *, row_number() over (partition by user_id order by ts, item_id)
      / count(*) over (partition by user_id) as share from fx_interactions)""")
def _(t: Tables) -> DataFrame:
    rows = t.stored()
    return W.temporal_split_pct(rows, W.SplitConfig(0.7, 0.15)).select("user_id", "item_id", "split")


def _core_sql() -> str:
    rounds, before = [], "select user_id, item_id from fx_interactions"
    for number in range(1, 6):
        rounds.append(f"p{number - 1} as ({before})")
        rounds.append(
            f"q{number} as (select * from p{number - 1} where user_id in "
            f"(select user_id from p{number - 1} group by user_id having count(*) >= 20))"
        )
        before = (
            f"select * from q{number} where item_id in "
            f"(select item_id from q{number} group by item_id having count(*) >= 22)"
        )
    rounds.append(f"p5 as ({before})")
    return f"""select i.user_id, i.item_id, i.rating, c.user_id is not null as kept from fx_interactions i
      left join (with {", ".join(rounds)} select * from p5) c on i.user_id = c.user_id and i.item_id = c.item_id"""


@query("w5_kcore", _core_sql())
def _(t: Tables) -> DataFrame:
    core = W.kcore(t.stored(), 20, 22)
    rows = core.clean.withColumn("kept", F.lit(True)).unionByName(core.discarded.withColumn("kept", F.lit(False)))
    return rows.select("user_id", "item_id", "rating", "kept")


@query("w6_filter_noise", "select user_id, item_id, rating, ts, kept from fx_marked")
def _(t: Tables) -> DataFrame:
    return t.marked()


@query("w6_noise_counts", """
    select (select count(*) from fx_interactions where user_id not in (select user_id from fx_ok_users)) as removed_by_users,
      (select count(*) from fx_interactions where user_id in (select user_id from fx_ok_users)
        and item_id not in (select item_id from fx_ok_items)) as removed_by_items,
      (select count(*) from fx_marked where kept) as clean""")
def _(t: Tables) -> DataFrame:
    return W.noise_counts(t.stored(), 20, 22)


@query("a5_split_balance", """
    select split, count(*) as rows, round(count(*) * 100.0::double / (select count(*) from fx_split), 6) as pct from fx_split group by split""", digits=6)
def _(t: Tables) -> DataFrame:
    return A.split_balance(t.split())


@query("t1_shuffle", """
    select user_id, event_id, md5('7|' || cast(event_id as varchar)) as place from events""")
def _(t: Tables) -> DataFrame:
    place = F.md5(F.concat_ws("|", F.lit("7"), F.col("event_id").cast("string")))
    return N.shuffle(t.read("events"), 7, ["event_id"]).select("user_id", "event_id", place.alias("place"))


@query("t3_union_splits", "select user_id, item_id, rating from fx_split")
def _(t: Tables) -> DataFrame:
    parts = W.by_split(materialize(t.split(), "split"))
    return W.union_splits(*parts.values()).select("user_id", "item_id", "rating")


@query("t5_unseen_items", """
    select s.c_mktsegment as segment, c.item_id from (select distinct c_mktsegment from customer) s cross join fx_catalog c
    where not exists (select 1 from fx_ratings r join customer u on r.user_id = u.c_custkey
      where u.c_mktsegment = s.c_mktsegment and r.item_id = c.item_id)""")
def _(t: Tables) -> DataFrame:
    # The history of a market segment is what any of its customers has ordered.
    customers = t.read("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    history = t.ratings.select("user_id", "item_id").join(customers, "user_id").select("segment", "item_id")
    names = [row["segment"] for row in customers.select("segment").distinct().orderBy("segment").collect()]
    pool = t.catalog.select(F.explode(F.array(*[F.lit(name) for name in names])).alias("segment"), "item_id")
    return N.unseen_items(pool, history)


def _negatives_sql(ratio: int) -> str:
    """``ratio`` unseen items per training row."""
    asked = f"select user_id, item_id as positive, {ratio} as need from fx_split where split = 'train'"
    return drawn(asked, ["user_id", "positive"], "select item_id from fx_split", "select user_id, item_id from fx_split")


@query("n1_negatives_per_positive", f"""
    select user_id, item_id, user_idx, item_idx, multihot, rating_scaled, count(*) as n from (
      select user_id, item_id, user_idx, item_idx, multihot, rating_scaled from fx_feature_split where split = 'train'
      union all select w.user_id, w.item_id, u.user_idx, d.item_idx, d.multihot, 0.0::double
        from {_negatives_sql(4)} w
        join fx_user_dim u on w.user_id = u.user_id join fx_item_dim d on w.item_id = d.item_id)
    group by user_id, item_id, user_idx, item_idx, multihot, rating_scaled""")
def _(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    sampled = N.negatives_per_positive(parts["train"], W.union_splits(*parts.values()), 4, items=t.item_attributes())
    columns = ["user_id", "item_id", "user_idx", "item_idx", "multihot", "rating_scaled"]
    return sampled.withColumn("multihot", _joined("genres_multihot", "multihot")).groupBy(*columns).agg(F.count("*").alias("n"))


_USERS = drawn(
    "select distinct user_id, 20 as need from fx_split where split = 'train'", ["user_id"], "select item_id from fx_split",
    "select user_id, item_id from fx_split")


@query("n2_negatives_per_user", f"""
    select user_id, item_id, user_idx, item_idx, rating_scaled, ts from fx_feature_split where split = 'train'
    union all select w.user_id, w.item_id, u.user_idx, d.item_idx, 0.0::double, l.ts
      from {_USERS} w
      join fx_user_dim u on w.user_id = u.user_id join fx_item_dim d on w.item_id = d.item_id
      join (select user_id, max(ts) as ts from fx_split where split = 'train' group by user_id) l on w.user_id = l.user_id""")
def _(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    return N.negatives_per_user(parts["train"], W.union_splits(*parts.values()), 20, items=t.item_attributes()).drop("genres_multihot")


@query("n3_negatives_with_time", f"""
    select user_id, ts, rating_scaled, count(*) as n, cast(sum(item_idx) as bigint) as items from (
      select user_id, ts, rating_scaled, item_idx from fx_feature_split where split = 'train'
      union all select w.user_id, l.ts, 0.0::double, d.item_idx
        from {_negatives_sql(2)} w join fx_item_dim d on w.item_id = d.item_id
        join (select user_id, max(ts) as ts from fx_split where split = 'train' group by user_id) l on w.user_id = l.user_id)
    group by user_id, ts, rating_scaled""")
def _(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    sampled = N.negatives_per_positive(parts["train"], W.union_splits(*parts.values()), 2, with_ts=True, items=t.item_attributes())
    return sampled.groupBy("user_id", "ts", "rating_scaled").agg(
        F.count("*").alias("n"), F.sum("item_idx").cast("bigint").alias("items")
    )


@query("t4_positives_and_negatives", f"""
    select rating_scaled > 0 as positive, count(*) as n, count(distinct user_id) as users from (
      select user_id, rating_scaled from fx_feature_split where split = 'train'
      union all select user_id, 0.0::double from {_negatives_sql(1)})
    group by 1""")
def _(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    sampled = N.negatives_per_positive(parts["train"], W.union_splits(*parts.values()), 1, items=t.item_attributes())
    return sampled.groupBy((F.col("rating_scaled") > 0).alias("positive")).agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users")
    )


@query("a6_sampling_ratio", f"""
    select positives, negatives, round(negatives / greatest(positives, 1), 6) as ratio from (
      select count(*) filter (where rating_scaled > 0) as positives, count(*) filter (where rating_scaled <= 0) as negatives
      from (select rating_scaled from fx_feature_split where split = 'train'
        union all select 0.0::double from {_negatives_sql(1)}))""", digits=6)
def _(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    return A.sampling_ratio(N.negatives_per_positive(parts["train"], W.union_splits(*parts.values()), 1, items=t.item_attributes()))


_FOLDED = "select distinct user_id, item_id % 20 as item_id from fx_interactions"


@query("n2_heavy_users", f"""
    select d.user_id, d.item_id, d.draw, s.seen from {drawn(
        f"select distinct user_id, 5 as need from ({_FOLDED})", ["user_id"], f"select item_id from ({_FOLDED})", _FOLDED)} d
    join (select user_id, count(*) as seen from ({_FOLDED}) group by user_id) s on d.user_id = s.user_id""")
def _(t: Tables) -> DataFrame:
    """Items folded to a pool of twenty, nearly all of which most users have seen; some have seen them all."""
    folded = t.stored().select("user_id", (F.col("item_id") % 20).alias("item_id")).distinct()
    seen = folded.groupBy("user_id").agg(F.count("*").alias("seen"))
    requests = seen.select("user_id", F.lit(5).alias("need"))
    return N.draw_unseen(requests, ["user_id"], folded, folded, N.SEED).join(seen, "user_id").select("user_id", "item_id", "draw", "seen")


@query("n4_decoys", "select user_id, target, item_id from fx_decoys")
def _(t: Tables) -> DataFrame:
    return decoy_rows(t)


def decoy_rows(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    return N.decoys(
        N.test_positives(parts["test"]), W.union_splits(*parts.values()), t.vectors.select("item_id")
    )


# Items folded to 120, of which only every third can have bad ratings: fewer than the 60 decoys wanted.
_FEW_BAD = """select user_id, item_id % 120 as item_id,
    max(case when item_id % 3 = 0 then rating_scaled else 1.0::double end) as rating_scaled from fx_feature_split group by 1, 2"""
_FEW_TARGETS = """select distinct user_id, item_id % 120 as target from fx_feature_split where split = 'test'
    and item_id % 120 in (select vec_id from embeddings)"""


@query("n4_decoys_top_up", decoys(_FEW_TARGETS, _FEW_BAD, 60))
def _(t: Tables) -> DataFrame:
    parts = t.feature_splits()
    rating = F.max(F.when(F.col("item_id") % 3 == 0, F.col("rating_scaled")).otherwise(1.0)).alias("rating_scaled")
    folded = materialize(W.union_splits(*parts.values()).groupBy("user_id", (F.col("item_id") % 120).alias("item_id")).agg(rating), "folded")
    targets = parts["test"].select("user_id", (F.col("item_id") % 120).alias("item_id")).distinct()
    return N.decoys(targets, folded, t.vectors.select("item_id"), 60)


@query("n5_test_positives", """
    select user_id, item_id, rating_scaled from fx_feature_split where split = 'test' and rating_scaled >= (3.5 - 1) / 4""")
def _(t: Tables) -> DataFrame:
    return N.test_positives(t.feature_splits()["test"]).select("user_id", "item_id", "rating_scaled")
