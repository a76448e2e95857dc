from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reclake.contracts import MOVIE_DOCUMENT, RATINGS, adopt_names
from reclake.functions import features as E
from reclake.functions import text as X
from reclake.operators import cleaning as C
from reclake.operators import joins as J
from reclake.operators.profiles import describe_cols, parse_attention, profile
from reclake.workloads.tables import Tables
from tests.conftest import rows


def document(movie_id, **fields):
    empty = {name: None for name in MOVIE_DOCUMENT.fieldNames()}
    return tuple({**empty, "movie_id": movie_id, "tmdb_id": movie_id + 1, **fields}.values())


def names(*values):
    return [(value,) for value in values]


def test_flatten_movie(spark):
    crew = [("Ann", "Writer"), ("Bob", "Director"), ("Cy", "Director")]
    df = spark.createDataFrame([
        document(1, overview=" a b\r\nc ", credits=(crew, names(*"abcdefg")), genres=names("Drama", "War"), budget=7),
        document(2, credits=(None, names("x", "y", "z")), keywords=(names("k"),)),
        document(3, credits=([("Ann", "Writer")], None)),
        document(4),
    ], MOVIE_DOCUMENT)
    flat = {row["movieId"]: row for row in C.flatten_movie(df).collect()}
    assert len(flat[1]) == 21
    assert (flat[1]["sinopsis"], flat[1]["director"], flat[1]["actores"]) == ("a b c", "Bob", list("abcde"))
    assert (flat[1]["generos"], flat[1]["presupuesto"], flat[1]["tmdbId"]) == (["Drama", "War"], 7, 2)
    assert (flat[2]["director"], flat[2]["actores"], flat[2]["palabras_clave"]) == ("Desconocido", ["x", "y", "z"], ["k"])
    assert flat[3]["director"] == "Desconocido"
    assert (flat[4]["sinopsis"], flat[4]["actores"], flat[4]["ingresos"], flat[4]["estado"]) == ("", [], 0, "")


def test_clean_links(spark):
    df = spark.createDataFrame([("1", "10"), ("1", "10"), ("2", None), ("1", "11")], "item_id string, ext_id string")
    assert rows(C.clean_links(df)) == [(1, 10), (1, 11)]


def test_drop_deleted_with_and_without_the_flag(spark):
    df = spark.createDataFrame([(1, False, "w", "t"), (2, True, "w", "t")], "item_id int, is_deleted boolean, write_time string, et_trunc string")
    assert rows(C.drop_deleted(df)) == [(1,)]
    assert rows(C.drop_deleted(df.drop("is_deleted"))) == [(1,), (2,)]


def test_conform_keeps_the_newest_row_of_a_heavy_key(spark):
    many = spark.range(5000).select(
        (F.col("id") % 1 + 1).cast("string").alias("user_id"), F.lit("2").alias("item_id"), (F.col("id") % 10).alias("rating"), F.col("id").alias("ts")
    )
    kept = C.conform(many, RATINGS, ["user_id", "item_id"], [F.desc("ts")])
    assert kept.schema.simpleString() == RATINGS.simpleString() and rows(kept) == [(1, 2, 9.0, 4999)]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_asset_paths_and_available_columns(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "None"), (4, "/4.jpg")], "item_id int, asset_path string")
    assert rows(C.has_asset_path(df)) == [(4, "/4.jpg")]
    assert C.select_available(df, ["asset_path", "nothing", "item_id"]).columns == ["asset_path", "item_id"]


def test_adopt_names(spark):
    df = spark.createDataFrame([(1, 2)], "userId int, movieId int")
    assert adopt_names(df).columns == ["user_id", "item_id"]


def test_funnel_and_empty_profile(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "user_id int, item_id int")
    funnel = C.Funnel()
    kept = funnel.stage("one", funnel.stage("all", df).filter("item_id = 1"))
    funnel.stage("none", kept.filter("item_id = 2")).write.format("noop").mode("overwrite").save()
    assert rows(funnel.counts(spark)) == [(0, "all", 2), (1, "one", 1), (2, "none", 0)]
    assert rows(profile(df)) == [(2, 1, 2)] and rows(profile(df.filter("false"))) == [(0, 0, 0)]


@pytest.mark.parametrize(("given", "expected"), [
    (["Action ", " Drama", "", None], "Action|Drama"), ([], "Desconocido"), ([" "], "Desconocido"), (None, "Desconocido"),
])
def test_pipe_join(spark, given, expected):
    df = spark.createDataFrame([(given,)], "g array<string>")
    assert df.select(X.pipe_join(F.col("g"))).first()[0] == expected


def test_pipe_strings(spark):
    df = spark.createDataFrame([("a| b||c ",), (" ",), (None,)], "g string")
    assert [row[0] for row in df.select(X.pipe_join(F.col("g"), is_array=False)).collect()] == ["a| b||c ", "Desconocido", "Desconocido"]
    assert [row[0] for row in df.select(X.pipe_split(F.col("g"))).collect()] == [["a", "b", "c"], [], None]


@pytest.mark.parametrize(("given", "expected"), [
    ("['a', 'b']", "a, b"), ('["it\'s", "b"]', "it's, b"), ("[a, b", "a, b"), ("nan", ""), ("NaN", ""), (None, ""), ("plain", "plain"),
])
def test_list_text_of_strings(spark, given, expected):
    df = spark.createDataFrame([(given,)], "g string")
    assert df.select(X.list_text(F.col("g"), is_array=False)).first()[0] == expected


def test_list_text_of_arrays(spark):
    df = spark.createDataFrame([(["a", None, "b"],), (None,)], "g array<string>")
    assert [row[0] for row in df.select(X.list_text(F.col("g"))).collect()] == ["a, b", ""]


def test_semantic_text(spark):
    df = spark.createDataFrame(
        [("T", None, ["x", "y"], "nan"), (None, " ", [], "s")],
        "titulo string, frase_promocional string, actores array<string>, sinopsis string",
    )
    texts = [row[0] for row in df.select(X.semantic_text(df)).collect()]
    assert texts == ["title: T. director: Desconocido. cast: x, y", "director: Desconocido. sinopsis: s"]


def test_event_time_ignores_the_session_zone(spark):
    df = spark.createDataFrame([(1, 2, 964982703)], "u int, i int, ts long")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Lima"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert df.select(E.event_time(F.col("ts"))).first()[0] == "2000-07-30T18:45:03Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert df.select(E.record_id(F.col("u"), F.col("i"))).first()[0] == "1_2"


def test_labels_and_stars(spark):
    df = spark.createDataFrame([(0.0,), (0.25,), (1.0,)], "y double")
    assert [row[0] for row in df.select(E.interaction_label(F.col("y"))).collect()] == [0.0, 1.0, 1.0]
    assert [row[0] for row in df.select(E.to_stars(F.col("y"))).collect()] == [1.0, 2.0, 5.0]
    assert (E.from_stars(3.5), E.from_stars(2.5)) == (0.625, 0.375)


def test_parse_attention_drops_broken_rows(spark):
    texts = ['{"category":0.1,"text":0.7,"image":0.2}', '{"category":0,"text":0.7,"image":0.3}', "nope", '{"text":1.0}', None]
    df = spark.createDataFrame([(text,) for text in texts], "attention_weights string")
    assert [tuple(round(x, 6) for x in row[1:]) for row in parse_attention(df).collect()] == [(10.0, 70.0, 20.0)]
    made = df.select(E.attention_json(F.lit(0.1), F.lit(0.7), F.lit(0.2))).first()[0]
    assert made == texts[0]


def test_describe_against_pandas(spark):
    data = [(float(x * 7 % 23), float(x % 3)) for x in range(101)] + [(None, 5.0)]
    df = spark.createDataFrame(data, "a double, b double")
    found = {row["column"]: row for row in describe_cols(df, ["a", "b"]).collect()}
    pdf = df.toPandas()
    for name in ("a", "b"):
        col = pdf[name]
        expected = dict(
            n=col.count(), mean=col.mean(), median=col.median(), std=col.std(), min=col.min(), max=col.max(),
            q1=col.quantile(0.25), q3=col.quantile(0.75),
        )
        for key, value in expected.items():
            assert found[name][key] == pytest.approx(value, abs=1e-6)


def test_silver_ratings(spark):
    ratings = spark.createDataFrame([(1, 1, 3.0, 5), (1, 1, 4.0, 9), (1, 2, 1.0, 1), (2, 3, 2.0, 1), (2, 4, 2.0, 1)], RATINGS)
    links = spark.createDataFrame([(1, 9), (1, 8), (2, None), (3, 7), (4, 6)], "item_id long, ext_id long")
    catalog = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "item_id long, titulo string")
    assets = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    silver = J.build_ratings(ratings, links, catalog, assets)
    assert rows(silver) == [(1, 1, 4.0, 9)]
    assert rows(J.build_movies(catalog, silver, ["titulo"])) == [("a",)]


def test_genres_and_embeddings_of_unknown_items(spark):
    ratings = spark.createDataFrame([(1, 1, 3.0, 5), (1, 2, 4.0, 9)], RATINGS)
    movies = spark.createDataFrame([(1, ["A", "B"])], "item_id long, genres array<string>")
    assert rows(J.enrich_genres(ratings, movies).select("item_id", "genres")) == [(1, "A|B"), (2, "Desconocido")]
    vectors = spark.createDataFrame([(1, [1.0, 2.0], None)], "item_id long, text_emb array<float>, img_emb array<float>")
    found = J.attach_embeddings(ratings.select("item_id"), vectors, 2)
    assert rows(found) == [(1, [1.0, 2.0], [0.0, 0.0]), (2, [0.0, 0.0], [0.0, 0.0])]


def test_silver_ratings_on_the_documented_views(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    key = F.col("p_partkey")
    part = t.read("part")
    pairs = part.select(key.alias("item_id"), F.when(key % 50 != 0, key + 100000).alias("ext_id"))
    links = pairs.unionByName(part.filter(key % 25 == 1).select(key.alias("item_id"), (key + 100000).alias("ext_id")))
    path = (
        F.when(key % 20 == 0, F.lit(None)).when(key % 20 == 7, "").when(key % 20 == 14, "None")
        .otherwise(F.concat(F.lit("/"), key.cast("string"), F.lit(".jpg")))
    )
    catalog = part.filter(key % 10 != 3).select(key.alias("item_id"), path.alias("asset_path"))
    assets = C.has_asset_path(catalog).filter(F.col("item_id") % 6 != 5).select("item_id")
    assert (links.count(), catalog.count(), assets.count()) == (2080, 1800, 1266)
    assert J.build_ratings(t.ratings, C.clean_links(links), catalog, assets).count() == 37_077
