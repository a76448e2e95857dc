"""Names and schemas at the edges of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---- fixed values: file column names, labels and defaults of the data model ----
FILE_TO_LIBRARY = {
    "userId": "user_id",
    "movieId": "item_id",
    "timestamp": "ts",
    "generos": "genres",
    "userId_idx": "user_idx",
    "movieId_idx": "item_idx",
}
LINK_NAMES = {"tmdbId": "ext_id"}
UNKNOWN = "Desconocido"
NO_SYNOPSIS = "Sin descripción."
STARS_MIN = 1.0
STARS_RANGE = 4.0
CATALOG_COLUMNS = [
    "movieId", "tmdbId", "titulo", "titulo_original", "sinopsis", "generos", "director", "actores",
    "palabras_clave", "fecha_lanzamiento", "calificacion_tmdb", "votos_tmdb", "frase_promocional",
    "popularidad", "poster_path", "idioma_original", "duracion_minutos",
]
# column of the flat movie table, field of the nested document, how the field is read
MOVIE_COLUMNS = [
    ("movieId", "movie_id", "id"),
    ("tmdbId", "tmdb_id", "id"),
    ("titulo", "title", "text"),
    ("titulo_original", "original_title", "text"),
    ("sinopsis", "overview", "cleaned"),
    ("generos", "genres", "names"),
    ("director", "credits.crew", "director"),
    ("actores", "credits.cast", "first names"),
    ("palabras_clave", "keywords.keywords", "names"),
    ("fecha_lanzamiento", "release_date", "text"),
    ("calificacion_tmdb", "vote_average", "number"),
    ("votos_tmdb", "vote_count", "number"),
    ("frase_promocional", "tagline", "cleaned"),
    ("popularidad", "popularity", "number"),
    ("poster_path", "poster_path", "text"),
    ("backdrop_path", "backdrop_path", "text"),
    ("idioma_original", "original_language", "text"),
    ("duracion_minutos", "runtime", "number"),
    ("presupuesto", "budget", "number"),
    ("ingresos", "revenue", "number"),
    ("estado", "status", "text"),
]
DIRECTOR_JOB = "Director"
CAST_NAMES = 5
STORE_COLUMNS = ["write_time", "api_invocation_time", "is_deleted"]
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TRAIN_RATIO = 0.8
VAL_RATIO = 0.1
CORE_MIN_USER = 20
CORE_MIN_ITEM = 10
CORE_ROUNDS = 5
NOISE_MIN_USER = 5
NOISE_MIN_ITEM = 5
NEGATIVES = 4
SEED = 42
DECOYS = 99
MIN_DECOYS = 10
BAD_STARS = 2.5
QUALITY_STARS = 3.5
REPORT_STARS = 4.0
INTERACTION_THRESHOLD = 0.5
TOP_K = 10
EPSILON = 1e-8
BATCH_NORM_EPSILON = 1e-5
# ---- end of fixed values ----

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

LINKS = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("ext_id", T.LongType()),
])

_NAMES = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))

MOVIE_DOCUMENT = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("tmdb_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("original_title", T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("tagline", T.StringType()),
    T.StructField("genres", _NAMES),
    T.StructField("credits", T.StructType([
        T.StructField("crew", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("job", T.StringType()),
        ]))),
        T.StructField("cast", _NAMES),
    ])),
    T.StructField("keywords", T.StructType([T.StructField("keywords", _NAMES)])),
    T.StructField("release_date", T.StringType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("poster_path", T.StringType()),
    T.StructField("backdrop_path", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("runtime", T.LongType()),
    T.StructField("budget", T.LongType()),
    T.StructField("revenue", T.LongType()),
    T.StructField("status", T.StringType()),
])

HISTORY_METRICS = [
    "train_total", "train_bce", "train_mse", "val_total", "val_bce", "val_mse", "val_rmse", "val_rmse_stars", "lr",
]

TRAINING_RUN = T.StructType([
    T.StructField("mode", T.StringType()),
    T.StructField("training_history", T.StructType([
        T.StructField(name, T.ArrayType(T.DoubleType())) for name in HISTORY_METRICS
    ])),
    T.StructField("training_time_seconds", T.DoubleType()),
    T.StructField("total_epochs_trained", T.LongType()),
])

_SHARES = T.StructType([
    T.StructField(name, T.DoubleType()) for name in ("category_pct", "text_pct", "image_pct")
])

_POINTWISE = T.StructType([
    T.StructField("mse", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("rmse_stars", T.DoubleType()),
    T.StructField("explainability", _SHARES),
    T.StructField("n_samples", T.LongType()),
    T.StructField("bce", T.DoubleType()),
    T.StructField("quality_threshold_stars", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision_quality", T.DoubleType()),
    T.StructField("recall_quality", T.DoubleType()),
    T.StructField("f1_quality", T.DoubleType()),
    T.StructField("confusion_matrix", T.StructType([
        T.StructField(name, T.LongType()) for name in ("tp", "fp", "fn", "tn")
    ])),
])

SUMMARY_BLOCK = T.StructType([
    *[T.StructField(name, T.DoubleType()) for name in ("rmse_stars", "hit_rate_at_k", "ndcg_at_k", "precision_at_k", "recall_at_k")],
    T.StructField("explainability", _SHARES),
    *[T.StructField(name, T.DoubleType()) for name in ("bce", "f1_quality", "accuracy")],
])

REPORT = T.StructType([
    T.StructField("mode", T.StringType()),
    T.StructField("test_pointwise", _POINTWISE),
    T.StructField("coldstart_pointwise", _POINTWISE),
    T.StructField("ranking_true_neg", T.StructType([
        T.StructField("hit_rate_at_k", T.DoubleType()),
        T.StructField("ndcg_at_k", T.DoubleType()),
        T.StructField("k", T.LongType()),
        T.StructField("total_evaluations", T.LongType()),
    ])),
    T.StructField("precision_recall", T.StructType([
        T.StructField("precision_at_k", T.DoubleType()),
        T.StructField("recall_at_k", T.DoubleType()),
        T.StructField("k", T.LongType()),
    ])),
    T.StructField("summary", SUMMARY_BLOCK),
])

COMPARISON = T.StructType([
    T.StructField("regression_score", T.DoubleType()),
    T.StructField("twoheads_score", T.DoubleType()),
    T.StructField("winner", T.StringType()),
    T.StructField("winner_summary", SUMMARY_BLOCK),
    T.StructField("scoring_weights", T.StructType([T.StructField(name, T.DoubleType()) for name in ("ndcg", "hr", "rmse_inv", "precision")])),
])

WINNER = T.StructType([
    T.StructField("winner_model", T.StringType()),
    T.StructField("winner_score", T.DoubleType()),
    T.StructField("winner_metrics", SUMMARY_BLOCK),
    T.StructField("evaluation_timestamp", T.StringType()),
    T.StructField("evaluation_config", T.StructType([T.StructField(name, T.LongType()) for name in ("k", "num_decoys")])),
])

ATTENTION = T.StructType([T.StructField(name, T.DoubleType()) for name in ("category", "text", "image")])


def adopt_names(df: DataFrame) -> DataFrame:
    """Rename file columns (``userId``, ``movieId``, …) to the names used by this library."""
    return df.withColumnsRenamed({old: new for old, new in FILE_TO_LIBRARY.items() if old in df.columns})
