"""Inputs of the queries, derived with Spark from the given tables. ``views.VIEWS`` states the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.contracts import RATINGS
from reclake.functions.features import hash_unit
from reclake.operators.cleaning import conform, has_asset_path
from reclake.operators.encoders import FeatureFit, apply_features, fit_features
from reclake.operators.sampling import item_attributes
from reclake.operators.splits import by_split, mark_noise, temporal_split, union_splits
from reclake.session import materialize_packed as materialize
from reclake.sources.writers import Encoders

MODELS = ["regression", "twoheads"]
MIN_USER, MIN_ITEM = 20, 22


def scaled_truth() -> Column:
    return (F.col("rating") - 0.5) / 4.5


def _once(derive: Callable) -> Callable:
    """Derive a table at the first call and hand out the same one afterwards, as long as the ``Tables`` are in use."""

    @wraps(derive)
    def kept(self: Tables):
        if derive.__name__ not in self.derived:
            self.derived[derive.__name__] = derive(self)
        return self.derived[derive.__name__]

    return kept


class Tables:
    """The given tables by name, and the inputs derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.derived = spark, sf_dir.rstrip("/"), {}
        # The tables hold times without a zone; both engines take them as UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def ratings(self) -> DataFrame:
        """Raw ratings; a user may rate an item more than once."""
        lines = self.read("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
        )
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        half_stars = (F.col("l_quantity").cast("int") + F.col("l_linenumber")) % 10 + 1
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("item_id"),
            (half_stars * 0.5).alias("rating"),
            F.unix_timestamp("o_orderdate").alias("ts"),
            "l_orderkey", "l_linenumber", "l_extendedprice",
        )

    @property
    def interactions(self) -> DataFrame:
        newest = [F.desc(name) for name in ("ts", "l_orderkey", "l_linenumber", "l_extendedprice")]
        return conform(self.ratings, RATINGS, ["user_id", "item_id"], newest)

    @property
    def links(self) -> DataFrame:
        """Id pairs as a feed repeats them, once per order line; one brand has no foreign id."""
        part = self.read("part").select("p_partkey", "p_brand")
        lines = self.read("lineitem").select("l_partkey")
        foreign = F.when(F.col("p_brand") != "Brand#25", F.col("l_partkey") + 100000)
        return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_partkey").alias("item_id"), foreign.alias("ext_id")
        )

    @property
    def catalog(self) -> DataFrame:
        """Item catalogue; promotional parts are not in it, small parts lack a usable asset path."""
        size = F.col("p_size")
        path = (
            F.when(size <= 2, F.lit(None).cast("string")).when(size <= 4, "").when(size <= 6, "None")
            .otherwise(F.concat(F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".jpg")))
        )
        return self.read("part").filter("p_type <> 'PROMO'").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("title"),
            F.split("p_name", " ").alias("name_parts"),
            F.concat_ws(" ", "p_name", "p_type").alias("genre_words"),
            F.col("p_brand").alias("director"),
            path.alias("asset_path"),
            size.alias("size"),
        )

    @property
    def assets(self) -> DataFrame:
        """Items whose image is there; large parts have none yet."""
        return has_asset_path(self.catalog).filter("size <= 40").select("item_id")

    @property
    def movies(self) -> DataFrame:
        return self.catalog.select("item_id", F.split("genre_words", " ").alias("genres"))

    @_once
    def stored(self) -> DataFrame:
        """The interactions as a table, as the jobs after the silver step read them; derived once, as all tables below."""
        return materialize(self.interactions, "interactions")

    @_once
    def feature_fit(self) -> FeatureFit:
        return fit_features(self.stored(), self.movies)

    @_once
    def features(self) -> tuple[DataFrame, Encoders]:
        fit = self.feature_fit()
        return materialize(apply_features(self.stored(), fit), "features"), fit.encoders

    @_once
    def marked(self) -> DataFrame:
        """The interactions with ``kept``: whether the noise filter leaves them."""
        return materialize(mark_noise(self.stored(), MIN_USER, MIN_ITEM), "marked")

    def _clean_split(self) -> DataFrame:
        return temporal_split(self.marked().filter("kept").drop("kept"))

    @_once
    def split(self) -> DataFrame:
        """Clean interactions with the column ``split``."""
        return materialize(self._clean_split(), "split")

    @_once
    def described_split(self) -> DataFrame:
        """Feature rows of the clean interactions, with their ``split``.

        Vectors are written as text, made once per item, and become vectors again where somebody reads them.
        """
        rows = self.split() if "split" in self.derived else self._clean_split()
        fit, vector = self.feature_fit(), F.col("genres_multihot")
        packed = replace(fit, items=fit.items.withColumn("genres_multihot", F.array_join(vector.cast("array<string>"), ",")))
        stored = materialize(self._described(rows, ("split",), packed), "splits")
        places = F.when(vector == "", F.array().cast("array<string>")).otherwise(F.split(vector, ","))
        return stored.withColumn("genres_multihot", places.cast("array<int>"))

    @_once
    def feature_splits(self) -> dict[str, DataFrame]:
        """Feature rows of the clean interactions, by split; vectors are joined last, to the rows that stay."""
        return by_split(self.described_split())

    def cold(self) -> DataFrame:
        """Feature rows of the interactions that the noise filter dropped."""
        return self._described(self.marked().filter("not kept").drop("kept"))

    def _described(self, rows: DataFrame, more: tuple[str, ...] = (), fit: FeatureFit | None = None) -> DataFrame:
        features = apply_features(rows, fit or self.feature_fit())
        first = ["user_id", "item_id"]
        return features.select(*first, *[name for name in features.columns if name not in (*first, *more)], *more)

    @_once
    def item_attributes(self) -> DataFrame:
        """Attributes of the items of the splits, out of the described items: feature rows of an item all hold the same ones."""
        rows = self.described_split() if "described_split" in self.derived else self.split()
        present = rows.select("item_id").distinct()
        return materialize(item_attributes(self.feature_fit().items.join(present, "item_id", "left_semi")), "item-attributes")

    def scored(self, pairs: DataFrame) -> DataFrame:
        """Stand-in predictions of two models: truth and a seeded draw for the rating, a draw for the interaction."""
        model = F.explode(F.array(*[F.lit(name) for name in MODELS])).alias("model")
        rows = pairs.select("*", model)
        ids = [F.col("user_id"), F.col("item_id")]
        return rows.withColumns({
            "y": scaled_truth(),
            "p_rating": 0.6 * (F.col("rating") - 0.5) / 4.5 + 0.4 * hash_unit(F.col("model"), F.lit("r"), *ids),
            "p_inter": hash_unit(F.col("model"), F.lit("i"), *ids),
        })

    @property
    def predictions(self) -> DataFrame:
        return self.scored(self.interactions).select("model", "user_id", "item_id", "y", "p_rating", "p_inter")

    def evaluation(self) -> DataFrame:
        """Predictions on the test split and on the interactions that the noise filter dropped."""
        test = self.split().filter("split = 'test'")
        cold = self.marked().filter("not kept").drop("kept")
        rows = test.withColumn("dataset", F.lit("test")).drop("split").unionByName(
            cold.withColumn("dataset", F.lit("coldstart"))
        )
        return self.scored(rows).select("model", "dataset", "user_id", "item_id", "y", "p_rating", "p_inter")

    @property
    def logs(self) -> DataFrame:
        """Log lines of ten jobs in both formats, with test lines among them."""
        value = F.col("value").cast("string")
        kind = F.col("event_type")
        whole = F.concat(
            F.lit("Epoch "), F.col("event_id").cast("string"), F.lit(" | train_total_loss="), value,
            F.lit("; train_bce=0.5; lr=1.00e-03;"),
        )
        message = (
            F.when(kind == "error", F.concat(F.lit("test_bce="), value, F.lit(";")))
            .when(kind == "click", F.concat(F.lit("train_mse="), value, F.lit(";")))
            .when(kind == "view", F.concat(F.lit("val_mse="), value, F.lit(";")))
            .when(kind == "signup", F.concat(F.lit("val_rmse_stars="), value, F.lit(";")))
            .otherwise(whole)
        )
        return self.read("events").select(
            (F.col("user_id") % 10).alias("job"), F.col("event_id").alias("seq"), message.alias("message")
        )

    @property
    def regression_logs(self) -> DataFrame:
        """Epoch lines of regression jobs; errors are test lines, sign-ups lack the validation error."""
        value, kind = F.col("value").cast("string"), F.col("event_type")
        start = F.concat(F.lit("Epoch "), F.col("event_id").cast("string"), F.lit(" | "))
        message = (
            F.when(kind == "error", F.concat(start, F.lit("test_mse="), value, F.lit(";")))
            .when(kind == "signup", F.concat(start, F.lit("train_mse="), value, F.lit("; lr=1.00e-03;")))
            .otherwise(F.concat(
                start, F.lit("train_mse="), value, F.lit("; val_mse=1"), value, F.lit("; val_rmse_stars=2"), value,
                F.lit("; lr=5.00e-04;"),
            ))
        )
        return self.read("events").select(
            (F.col("user_id") % 10).alias("job"), F.col("event_id").alias("seq"), message.alias("message")
        )

    @property
    def epoch_logs(self) -> DataFrame:
        """Epoch lines; errors lack the validation metrics, and one job never logs the cross-entropy."""
        value, kind = F.col("value").cast("string"), F.col("event_type")
        start = F.concat(F.lit("Epoch "), F.col("event_id").cast("string"), F.lit(" | train_total_loss="), value, F.lit(";"))
        entropy = F.when(F.col("user_id") % 10 == 3, F.lit("")).otherwise(F.concat(F.lit(" val_bce=3"), value, F.lit(";")))
        more = F.concat(
            F.lit(" val_total_loss=1"), value, F.lit(";"), entropy, F.lit(" val_mse=2"), value, F.lit("; val_rmse_stars=4"), value, F.lit(";"))
        return self.read("events").select(
            (F.col("user_id") % 10).alias("job"), F.col("event_id").alias("seq"),
            F.when(kind == "error", start).otherwise(F.concat(start, more)).alias("message"))

    @property
    def history(self) -> DataFrame:
        """A validation error and a learning rate per event, as the history of a run per user."""
        return self.read("events").select(
            F.col("user_id").alias("job"), F.col("event_id").alias("epoch"),
            F.col("value").alias("val_mse"), F.floor(F.col("value") / 50).cast("double").alias("lr"),
        )

    @property
    def attention(self) -> DataFrame:
        """Attention JSON with broken rows and zero weights."""
        cents = F.lpad((F.round(F.col("value") * 100).cast("int") % 100).cast("string"), 2, "0")
        text = F.concat(F.lit("0."), cents)
        kind = F.col("event_type")
        weights = (
            F.when(kind == "error", "not json")
            .when(kind == "signup", F.concat(F.lit('{"category":0,"text":'), text, F.lit(',"image":0.5}')))
            .otherwise(F.concat(F.lit('{"category":0.05,"text":'), text, F.lit(',"image":0.25}')))
        )
        return self.read("events").select(F.col("event_id").alias("rec_id"), weights.alias("attention_weights"))

    @property
    def vectors(self) -> DataFrame:
        return self.read("embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("text_emb"))

    @property
    def images(self) -> DataFrame:
        """Image vectors: those of the vectors with a label below five."""
        return self.read("embeddings").filter("label < 5").select(
            F.col("vec_id").alias("item_id"), F.col("embedding").alias("img_emb")
        )

    @property
    def trials(self) -> DataFrame:
        """Tuning trials: a customer each, the balance as objective."""
        return self.read("customer").select(
            F.col("c_custkey").alias("trial"),
            F.col("c_acctbal").alias("objective"),
            (F.col("c_acctbal") / 1000000).alias("lr"),
            F.col("c_nationkey").alias("emb_dim"),
            F.col("c_mktsegment").alias("job_name"),
        )
