"""Cleaning, expressions, silver joins and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reclake.contracts import MOVIE_DOCUMENT, RATINGS
from reclake.functions import features as E
from reclake.functions import text as X
from reclake.operators import cleaning as C
from reclake.operators import joins as J
from reclake.operators import profiles as A
from reclake.session import materialize_packed as materialize
from reclake.plans.lakehouse import build_silver
from reclake.workloads.registry import query
from reclake.workloads.tables import Tables
from reclake.workloads.views import draw

_STRIPPED = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) " \
    "|| chr(31) || chr(133) || chr(160) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288))"
_CLEANED = _STRIPPED.format(
    "replace(replace(replace(replace(text, chr(8232), ' '), chr(8233), ' '), chr(10), ' '), chr(13), '')"
)


def silver(t: Tables) -> DataFrame:
    return J.build_ratings(t.ratings, C.clean_links(t.links), t.catalog, t.assets)


@query("c1_clean_links", "select distinct item_id, ext_id from fx_links where ext_id is not null")
def _(t: Tables) -> DataFrame:
    return C.clean_links(t.links)


@query("c2_flatten_movie", f"""
    select doc_id as "movieId", {_CLEANED} as sinopsis, lang as titulo, case when n_chars > 500 then lang else 'Desconocido' end as director,
      source || '|' || lang as generos, array_to_string(string_split(text, ' ')[1:5], '|') as actores from documents""")
def _(t: Tables) -> DataFrame:
    # Nested documents: the words of a text are the cast, source and language the crew; long texts have a director.
    named = lambda col: F.transform(col, lambda x: F.struct(x.alias("name")))
    crew = F.array(
        F.struct(F.col("source").alias("name"), F.lit("Writer").alias("job")),
        F.struct(F.col("lang").alias("name"), F.when(F.col("n_chars") > 500, "Director").otherwise("Editor").alias("job")),
    )
    given = t.read("documents").select(
        F.col("doc_id").alias("movie_id"), F.col("lang").alias("title"), F.col("text").alias("overview"),
        named(F.array("source", "lang")).alias("genres"),
        F.struct(crew.alias("crew"), named(F.split("text", " ")).alias("cast")).alias("credits"),
    )
    missing = [
        F.lit(None).cast(field.dataType).alias(field.name) for field in MOVIE_DOCUMENT if field.name not in given.columns
    ]
    joined = lambda col: F.array_join(col, "|").alias(col)
    return C.flatten_movie(given.select("*", *missing)).select(
        "movieId", "titulo", "sinopsis", "director", joined("generos"), joined("actores")
    )


@query("c3_clean_text", f"select doc_id, coalesce({_CLEANED}, '') as text from documents")
def _(t: Tables) -> DataFrame:
    return t.read("documents").select("doc_id", X.clean_text(F.col("text")).alias("text"))


@query("c4_with_audit", "select item_id, 'run-1' as correlation_id, true as stamped from fx_catalog")
def _(t: Tables) -> DataFrame:
    stamped = F.col("extraction_timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$")
    return C.with_audit(t.catalog, "run-1").select("item_id", "correlation_id", stamped.alias("stamped"))


@query("c5_has_asset_path", """
    select item_id, asset_path from fx_catalog where asset_path is not null and asset_path not in ('', 'None')""")
def _(t: Tables) -> DataFrame:
    return C.has_asset_path(t.catalog).select("item_id", "asset_path")


@query("c6_drop_deleted", "select o_orderkey, o_custkey from orders where o_orderstatus <> 'F'")
def _(t: Tables) -> DataFrame:
    stored = t.read("orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderstatus") == "F").alias("is_deleted"),
        F.col("o_orderdate").alias("write_time"), F.col("o_orderdate").alias("event_time_trunc"),
    )
    return C.drop_deleted(stored)


@query("c7_select_available", "select item_id, title, director from fx_catalog")
def _(t: Tables) -> DataFrame:
    return C.select_available(t.catalog, ["item_id", "title", "tagline", "director"])


@query("c8_conform", "select user_id, item_id, rating, ts from fx_interactions")
def _(t: Tables) -> DataFrame:
    return t.interactions


@query("c9_fill_genre", """
    select p.p_partkey as item_id, coalesce(c.genre_words, 'Desconocido') as genres
    from part p left join fx_catalog c on p.p_partkey = c.item_id""")
def _(t: Tables) -> DataFrame:
    items = t.read("part").select(F.col("p_partkey").alias("item_id"))
    words = t.catalog.select("item_id", F.col("genre_words").alias("genres"))
    return C.fill_genre(items.join(words, "item_id", "left"))


@query("c10_entity_dim", "select distinct item_id, item_idx, multihot from fx_features")
def _(t: Tables) -> DataFrame:
    features, _ = t.features()
    items = C.entity_dim(features, "item_id", ["item_idx", "genres_multihot"])
    multihot = F.array_join(F.col("genres_multihot").cast("array<string>"), ",").alias("multihot")
    return items.select("item_id", F.col("item_idx").cast("bigint").alias("item_idx"), multihot)


@query("c11_funnel", """
    select 0 as step, 'raw' as stage, count(*) as rows from fx_ratings
    union all select 1, 'linked', count(*) from fx_ratings where item_id in (select item_id from fx_links where ext_id is not null)
    union all select 2, 'described', count(*) from fx_ratings where item_id in (select item_id from fx_links where ext_id is not null)
      and item_id in (select item_id from fx_catalog)
    union all select 3, 'with_asset', count(*) from fx_ratings where item_id in (select item_id from fx_links where ext_id is not null)
      and item_id in (select item_id from fx_catalog) and item_id in (select item_id from fx_assets)
    union all select 4, 'silver', count(*) from fx_silver""")
def _(t: Tables) -> DataFrame:
    _, _, counts = build_silver(t.ratings, t.links, t.catalog, t.assets, ["item_id"])
    return counts


@query("e1_pipe_join", "select item_id, replace(genre_words, ' ', '|') as genres from fx_catalog")
def _(t: Tables) -> DataFrame:
    return t.movies.select("item_id", X.pipe_join(F.col("genres")).alias("genres"))


@query("e2_pipe_split", """
    select item_id, word, cast(count(*) as bigint) as n
    from (select item_id, unnest(string_split(genre_words, ' ')) as word from fx_catalog) group by item_id, word""")
def _(t: Tables) -> DataFrame:
    piped = t.movies.select("item_id", X.pipe_join(F.col("genres")).alias("genres"))
    words = piped.select("item_id", F.explode(X.pipe_split(F.concat(F.lit("| "), "genres", F.lit(" ||")))).alias("word"))
    return words.groupBy("item_id", "word").agg(F.count("*").alias("n"))


@query("e3_list_text", """
    select item_id, replace(title, ' ', ', ') as listed, replace(title, ' ', ', ') as parsed from fx_catalog""")
def _(t: Tables) -> DataFrame:
    quoted = F.concat(F.lit("['"), F.array_join("name_parts", "', '"), F.lit("']"))
    return t.catalog.select(
        "item_id", X.list_text(F.col("name_parts")).alias("listed"), X.list_text(quoted, is_array=False).alias("parsed")
    )


@query("e4_semantic_text", """
    select item_id, 'title: ' || title || '. director: ' || director || '. cast: ' || replace(title, ' ', ', ')
      || case when coalesce(asset_path, '') <> '' then '. sinopsis: ' || asset_path else '' end as description
    from fx_catalog""")
def _(t: Tables) -> DataFrame:
    movies = t.catalog.select(
        "item_id", F.col("title").alias("titulo"), F.lit(" ").alias("frase_promocional"), "director",
        F.col("name_parts").alias("actores"), F.col("asset_path").alias("sinopsis"),
    )
    return movies.select("item_id", X.semantic_text(movies).alias("description"))


@query("e5_interaction_label", """
    select label, count(*) as n from (select case when rating_scaled > 0 then 1.0::double else 0.0::double end as label
      from fx_features) group by label""")
def _(t: Tables) -> DataFrame:
    features, _ = t.features()
    return features.select(E.interaction_label(F.col("rating_scaled")).alias("label")).groupBy("label").agg(
        F.count("*").alias("n")
    )


@query("e6_stars", """
    select user_id, item_id, (rating - 0.5) / 4.5 * 4.0 + 1.0 as stars, (rating - 0.5) / 4.5 >= (3.5 - 1) / 4 as relevant
    from fx_interactions""")
def _(t: Tables) -> DataFrame:
    scaled = (F.col("rating") - 0.5) / 4.5
    return t.interactions.select(
        "user_id", "item_id", E.to_stars(scaled).alias("stars"), (scaled >= E.from_stars(3.5)).alias("relevant")
    )


@query("e7_event_time", """
    select event_id, strftime(make_timestamp(cast(floor(epoch(ts)) as bigint) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as event_time
    from events""")
def _(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", E.event_time(F.unix_timestamp("ts")).alias("event_time"))


@query("e8_record_id", """
    select cast(user_id as varchar) || '_' || cast(event_id as varchar) as record_id from events""")
def _(t: Tables) -> DataFrame:
    return t.read("events").select(E.record_id(F.col("user_id"), F.col("event_id")).alias("record_id"))


@query("e9_attention_json", """
    select event_id, '{"category":0.25,"text":' || cast(value as varchar) || ',"image":0.5}' as attention_weights from events""")
def _(t: Tables) -> DataFrame:
    weights = E.attention_json(F.lit(0.25), F.col("value"), F.lit(0.5))
    return t.read("events").select("event_id", weights.alias("attention_weights"))


@query("e10_parse_attention", """
    select rec_id, round(category_pct, 6) as category_pct, round(text_pct, 6) as text_pct, round(image_pct, 6) as image_pct
    from fx_attention_pct where category_pct is not null and text_pct is not null and image_pct is not null""")
def _(t: Tables) -> DataFrame:
    shares = [F.round(name, 6).alias(name) for name in ("category_pct", "text_pct", "image_pct")]
    return A.parse_attention(t.attention).select("rec_id", *shares)


@query("j1_build_ratings", "select user_id, item_id, rating, ts from fx_silver")
def _(t: Tables) -> DataFrame:
    return silver(t)


@query("j2_build_movies", """
    select item_id, title, director from fx_catalog where item_id in (select item_id from fx_silver)""")
def _(t: Tables) -> DataFrame:
    return J.build_movies(t.catalog, silver(t), ["item_id", "title", "tagline", "director"])


@query("j3_enrich_genres", """
    select i.user_id, i.item_id, i.rating, g.genres from fx_interactions i join fx_genres g on i.item_id = g.item_id""")
def _(t: Tables) -> DataFrame:
    return J.enrich_genres(t.interactions, t.movies).select("user_id", "item_id", "rating", "genres")


@query("j4_pending_assets", """
    select item_id, asset_path from fx_catalog where asset_path is not null and asset_path not in ('', 'None')
      and item_id not in (select item_id from fx_assets)""")
def _(t: Tables) -> DataFrame:
    return J.pending_assets(C.has_asset_path(t.catalog), t.assets).select("item_id", "asset_path")


@query("j5_keep_in", "select user_id, item_id, rating, ts from fx_interactions where user_id in (select user_id from fx_ok_users)")
def _(t: Tables) -> DataFrame:
    rows = t.stored()
    return J.keep_in(rows, A.active_ids(rows, "user_id", 20), "user_id").select(RATINGS.fieldNames())


@query("j6_discarded", "select user_id, item_id, rating, ts from fx_marked where not kept")
def _(t: Tables) -> DataFrame:
    marked = materialize(t.marked(), "marked")
    clean = marked.filter("kept").select("user_id", "item_id")
    return J.discarded(marked.drop("kept"), clean, ["user_id", "item_id"]).select(RATINGS.fieldNames())


@query("j7_attach_embeddings", """
    select i.user_id, i.item_id, round(coalesce(list_sum(list_transform(e.embedding, lambda x: x::double)), 0), 4) as text_total,
      round(coalesce(list_sum(list_transform(m.img_emb, lambda x: x::double)), 0), 4) as img_total
    from fx_interactions i left join embeddings e on i.item_id = e.vec_id left join fx_images m on i.item_id = m.item_id""")
def _(t: Tables) -> DataFrame:
    vectors = t.vectors.join(t.images, "item_id", "left")
    rows = J.attach_embeddings(t.interactions.select("user_id", "item_id"), vectors, 64)
    total = lambda col: F.round(F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x.cast("double")), 4)
    return rows.select("user_id", "item_id", total("text_emb").alias("text_total"), total("img_emb").alias("img_total"))


@query("j8_join_predictions", f"""
    select user_id, item_id, rating, {draw("'p'", "user_id", "item_id")} as prediction from fx_interactions""")
def _(t: Tables) -> DataFrame:
    rows = t.stored()
    predicted = rows.select("user_id", "item_id", E.hash_int(F.lit("p"), F.col("user_id"), F.col("item_id")).alias("prediction"))
    return J.join_predictions(rows.select("user_id", "item_id", "rating"), predicted)


@query("a1_profile", """
    select count(*) as interactions, count(distinct user_id) as users, count(distinct item_id) as items from fx_interactions""")
def _(t: Tables) -> DataFrame:
    return A.profile(t.interactions)


@query("a2_active_ids", "select item_id from fx_interactions group by item_id having count(*) >= 22")
def _(t: Tables) -> DataFrame:
    return A.active_ids(t.interactions, "item_id", 22)


@query("a3_user_history", "select distinct user_id, item_id from fx_ratings")
def _(t: Tables) -> DataFrame:
    return A.user_history(t.ratings)


@query("a4_last_seen", "select user_id, max(ts) as last_ts from fx_interactions group by user_id")
def _(t: Tables) -> DataFrame:
    return A.last_seen(t.interactions)


@query("a7_describe_cols", """
    select 'value' as "column", count(value) as n, round(avg(value), 6) as mean, round(median(value), 6) as median,
      round(stddev_samp(value), 6) as std, round(min(value), 6) as min, round(max(value), 6) as max,
      round(quantile_cont(value, 0.25), 6) as q1, round(quantile_cont(value, 0.75), 6) as q3 from events
    union all select 'user_id', count(user_id), round(avg(user_id), 6), round(median(user_id), 6), round(stddev_samp(user_id), 6),
      min(user_id), max(user_id), round(quantile_cont(user_id, 0.25), 6), round(quantile_cont(user_id, 0.75), 6) from events""", digits=6)
def _(t: Tables) -> DataFrame:
    return A.describe_cols(t.read("events"), ["value", "user_id"])


@query("a8_attention_share", """
    select round(avg(l_discount) * 100, 6) as category_pct, round(avg(l_tax) * 100, 6) as text_pct,
      round(avg(l_quantity / 50) * 100, 6) as image_pct, l_returnflag as model from lineitem group by l_returnflag""", digits=6)
def _(t: Tables) -> DataFrame:
    weights = F.array("l_discount", "l_tax", F.col("l_quantity") / 50)
    return A.attention_share(
        t.read("lineitem").select(F.col("l_returnflag").alias("model"), weights.alias("weights")), by=["model"]
    )
