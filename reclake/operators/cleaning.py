"""Cleaning, conforming and counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reclake.contracts import CAST_NAMES, DIRECTOR_JOB, MOVIE_COLUMNS, STORE_COLUMNS, UNKNOWN
from reclake.functions.text import clean_text


def clean_links(df: DataFrame) -> DataFrame:
    """Id pairs with a foreign id, as numbers, each pair once."""
    pairs = df.dropna(subset=["ext_id"]).select(F.col("item_id").cast("bigint"), F.col("ext_id").cast("bigint"))
    return pairs.distinct()


def _names(items: Column) -> Column:
    return F.coalesce(F.transform(items, lambda item: item["name"]), F.array().cast("array<string>"))


def _director(crew: Column) -> Column:
    directors = F.filter(crew, lambda member: member["job"] == DIRECTOR_JOB)
    return F.coalesce(F.get(directors, F.lit(0))["name"], F.lit(UNKNOWN))


_READ = {
    "id": lambda col: col.cast("bigint"),
    "text": lambda col: F.coalesce(col, F.lit("")),
    "number": lambda col: F.coalesce(col, F.lit(0)),
    "cleaned": clean_text,
    "names": _names,
    "first names": lambda col: F.slice(_names(col), 1, CAST_NAMES),
    "director": _director,
}


def flatten_movie(df: DataFrame) -> DataFrame:
    """Flat movie record out of a nested document (schema ``contracts.MOVIE_DOCUMENT``)."""
    return df.select([_READ[kind](F.col(field)).alias(name) for name, field, kind in MOVIE_COLUMNS])


def with_audit(df: DataFrame, correlation_id: str) -> DataFrame:
    """Extraction time (UTC) and correlation id on every row."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return df.withColumns({
        "extraction_timestamp": F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
        "correlation_id": F.lit(correlation_id),
    })


def has_asset_path(df: DataFrame, col: str = "asset_path") -> DataFrame:
    """Rows whose asset path is neither null nor empty nor the text ``None``."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin("", "None"))


def drop_deleted(df: DataFrame) -> DataFrame:
    """Rows not marked as deleted, without the columns that only the feature store uses."""
    if "is_deleted" in df.columns:
        df = df.filter(~F.col("is_deleted"))
    internal = [name for name in df.columns if name in STORE_COLUMNS or name.endswith("_trunc")]
    return df.drop(*internal)


def select_available(df: DataFrame, names: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([name for name in names if name in df.columns])


def conform(df: DataFrame, schema: T.StructType, keys: list[str], order: list[Column]) -> DataFrame:
    """Cast to ``schema`` and keep one row per key: the first in ``order``.

    Give a total order, newest first; which row survives is then fixed. Columns of ``order`` need not be in the
    schema. Copies are reduced before the shuffle (the plan shows a partial ``WindowGroupLimit``), so a key with
    very many copies costs no more than one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col("_rank") == 1)
    return kept.select([F.col(field.name).cast(field.dataType) for field in schema])


def fill_genre(df: DataFrame, default: str = UNKNOWN, col: str = "genres") -> DataFrame:
    return df.fillna({col: default})


def entity_dim(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """One attribute row per entity. Attributes depend on the key; the smallest is taken should they differ.

    Repeated rows are dropped first, by hash and before the shuffle; vectors then need no sort of the whole input.
    """
    return df.select(key, *attrs).distinct().groupBy(key).agg(*[F.min(name).alias(name) for name in attrs])


class Funnel:
    """Row counts after the stages of a pipeline, taken while the pipeline runs once.

    Wrap each stage in :meth:`stage`, run the last one (write it), then ask for :meth:`counts`. Counting costs no further job and no
    second read. If a lost executor makes Spark run a part of a stage again, its rows may count twice; a count that must
    be exact then is taken from the written table.
    """

    def __init__(self) -> None:
        self._stages: list[tuple[str, Observation]] = []

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as it is, its rows counted when it runs."""
        seen = Observation()
        self._stages.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def counts(self, spark: SparkSession) -> DataFrame:
        """``step``, ``stage`` and ``rows`` of each stage, in order; waits for the run to end."""
        rows = [(step, name, seen.get["rows"]) for step, (name, seen) in enumerate(self._stages)]
        return spark.createDataFrame(rows, "step long, stage string, rows long")
