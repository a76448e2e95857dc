"""Writers and the readers of what they write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reclake.functions.features import event_time, record_id

FEATURE_COLUMNS = [
    "user_id", "item_id", "rating", "ts", "genres", "rating_scaled", "user_idx", "item_idx", "genres_multihot",
]
EMBEDDINGS = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("text_emb", T.ArrayType(T.FloatType())),
    T.StructField("img_emb", T.ArrayType(T.FloatType())),
])


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines, UTF-8 as it is."""
    df.write.mode("overwrite").json(path)


def write_splits(frames: dict[str, DataFrame], base: str, max_files: int | None = None) -> None:
    """One parquet folder per split. ``max_files`` limits the files of each; by default the write stays parallel."""
    for name, frame in frames.items():
        if max_files:
            frame = frame.coalesce(max_files)
        frame.write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}")


def with_record(df: DataFrame, event: str = "event_time", record: str = "record_id") -> DataFrame:
    """Feature rows with event time and record id, named as the store wants them, without the multi-hot vector."""
    plain = df.drop("genres_multihot")
    return plain.withColumns({
        event: event_time(F.col("ts")),
        record: record_id(F.col("user_id"), F.col("item_id")),
    })


def append_features(df: DataFrame, path: str, event: str = "event_time", record: str = "record_id") -> None:
    """Append feature records, laid out by year, month, day and hour of the event.

    The rebalance hint lets adaptive execution split a busy hour and merge quiet ones before the write.
    """
    parts = {
        "year": F.substring(event, 1, 4),
        "month": F.substring(event, 6, 2),
        "day": F.substring(event, 9, 2),
        "hour": F.substring(event, 12, 2),
    }
    laid_out = with_record(df, event, record).withColumns(parts).hint("rebalance", *parts)
    laid_out.write.partitionBy(*parts).mode("append").parquet(path)


def latest_records(df: DataFrame, event: str = "event_time", record: str = "record_id", by: list[str] | None = None) -> DataFrame:
    """Newest row per record id of an append log: by event time, then by write time where there is one.

    Rows still equal go by the remaining columns. Deleted rows count; drop them afterwards, or an older version comes back.
    Columns ``by`` depend on the record id; rows partitioned on them are not moved.
    """
    by = by or []
    order = [event, *[name for name in ("write_time",) if name in df.columns and name not in (event, record)]]
    rest = [name for name in df.columns if name not in (record, *order, *by)]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    return df.groupBy(*by, record).agg(newest).select(*by, record, "newest.*")


def write_features(df: DataFrame, path: str) -> None:
    """The consolidated feature table."""
    df.select(FEATURE_COLUMNS).write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class Encoders:
    """Three ``(value, idx)`` tables."""

    users: DataFrame
    items: DataFrame
    genres: DataFrame


def write_encoders(encoders: Encoders, path: str) -> None:
    for name in ("users", "items", "genres"):
        getattr(encoders, name).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def read_encoders(spark: SparkSession, path: str) -> Encoders:
    return Encoders(*[spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in ("users", "items", "genres")])


def write_embeddings(df: DataFrame, path: str) -> None:
    df.select([F.col(field.name).cast(field.dataType) for field in EMBEDDINGS]).write.mode("overwrite").parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EMBEDDINGS).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """One JSON document per row; a report table has one row per model."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
