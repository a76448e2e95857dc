"""Readers: file trees, catalogue tables, asset listings, nested documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote, urlparse

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reclake.contracts import FILE_TO_LIBRARY, HISTORY_METRICS, LINK_NAMES, REPORT, TRAINING_RUN
from reclake.session import materialize_packed as materialize


# What a file that is listed, not opened, counts for when files are dealt over tasks.
LISTED_BYTES = 4096


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _tree(spark: SparkSession, fmt: str, path: str, schema: T.StructType, glob: str, **options) -> DataFrame:
    reader = spark.read.format(fmt).schema(schema).options(recursiveFileLookup=True, pathGlobFilter=glob, **options)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema)
        raise


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the queries planned meanwhile; names use ``__`` for dots."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def csv_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> dict[str, list[str]]:
    """Files under ``path`` by their first line; empty files are left out.

    Every file gets a partition of its own, whose task stops after the first line; so the files are opened, not read through.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                if batch.column(1)[0].as_py() == 0:
                    yield batch.select([0, 2]).slice(0, 1)
                return

    lines = spark.read.options(recursiveFileLookup=True, pathGlobFilter=glob).text(path)
    named = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    apart = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with _settings(spark, spark__sql__files__openCostInBytes=apart):
        found = named.mapInArrow(first, "file string, value string").collect()
    headers: dict[str, list[str]] = {}
    for row in sorted(found):
        headers.setdefault(row["value"].removeprefix("\ufeff").rstrip("\r"), []).append(unquote(row["file"]))
    return headers


def _by_name(raw: DataFrame, schema: T.StructType, path: str) -> DataFrame:
    found = {LINK_NAMES.get(name, FILE_TO_LIBRARY.get(name, name)): name for name in reversed(raw.columns)}
    lacking = [name for name in schema.fieldNames() if name not in found]
    if lacking:
        raise ValueError(f"no column for {', '.join(lacking)} in {path}: {', '.join(raw.columns)}")
    return raw.select([F.col(f"`{found[f.name]}`").try_cast(f.dataType).alias(f.name) for f in schema])


def read_csv_prefix(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All ``.csv`` files under ``path`` as one table, columns found by header name; empty when there is no file.

    Headers may use the file names of the data model; further columns are left out. Files need not agree in the order or number of
    their columns: there is one read per header, and their rows are put together by name. A column that a file lacks is an
    error. A cell that is not of its type is null; a short line ends in nulls.
    """
    try:
        headers = csv_headers(spark, path)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema)
        raise
    reader = spark.read.options(header=True, enforceSchema=False, inferSchema=False)
    frames = []
    for files in headers.values():
        if len(headers) == 1:
            raw = reader.options(recursiveFileLookup=True, pathGlobFilter="*.csv").csv(path)
        else:
            raw = reader.csv([re.sub(r"([\[\]{}*?\\])", r"\\\1", file) for file in files])
        frames.append(_by_name(raw, schema, path if len(headers) == 1 else files[0]))
    return reduce(DataFrame.unionByName, frames, spark.createDataFrame([], schema)) if len(frames) != 1 else frames[0]


def read_jsonl_prefix(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All ``.json`` and ``.jsonl`` files under ``path``, one record per line; blank lines are skipped."""
    return _tree(spark, "json", path, schema, "*.{json,jsonl}")


def read_parquet_tree(
    spark: SparkSession, path: str, schema: T.StructType | None = None, keep_partitions: bool = False, glob: str | None = None,
) -> DataFrame:
    """Parquet files at any depth under ``path``, whatever their names.

    ``<path>/data`` is read instead where ``path`` has no file of that format, or also files of others, such as a table's metadata;
    any other error is raised. ``glob`` restricts the names. ``keep_partitions`` keeps folder columns such as ``year=``
    visible, so that filters on them prune folders.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if not keep_partitions:
        reader = reader.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    data = f"{path.rstrip('/')}/data"
    try:
        # footers of a few files decide the schema, so files of other formats would only show when they are read
        return reader.parquet(data if _data_among_others(spark, path) else path)
    except AnalysisException as error:
        if _missing(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return reader.parquet(data)
        raise


def _data_among_others(spark: SparkSession, path: str) -> bool:
    """True if ``path`` has a folder ``data`` and, beside it, files with endings of other formats."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return False
    names = {status.getPath().getName() for status in system.listStatus(place)}
    if "data" not in names or len(names) == 1:
        return False
    other = F.col("path").rlike(r"\.(json|avro|csv|orc|txt|xml|md)(\.gz)?$") & ~F.col("path").contains("/data/")
    return not list_files(spark, path).filter(other).isEmpty()


def read_table_or_path(
    spark: SparkSession, table: str, path: str, fmt: str = "csv", schema: T.StructType | None = None
) -> DataFrame:
    """The catalogue table when it exists, else the files."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    if fmt == "json":
        return read_jsonl_prefix(spark, path, schema)
    if fmt == "parquet":
        return read_parquet_tree(spark, path, schema)
    return read_csv_prefix(spark, path, schema)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of every file below ``path``; file contents are not read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], "path string, length bigint")
        raise
    return files.select("path", "length")


def id_from_path(path: Column, ext: str = ".jpg") -> Column:
    """Number in an object name ``{id}{ext}``; null for any other name."""
    escaped = ext.replace(".", r"\.")
    return F.regexp_extract(path, rf"(?:^|/)([^/]*){escaped}$", 1).try_cast("bigint")


def listed_ids(files: DataFrame, ext: str = ".jpg") -> DataFrame:
    """Distinct item ids named by a listing with a ``path`` column; names that are no number are skipped."""
    return files.select(id_from_path(F.col("path"), ext).alias("item_id")).dropna().distinct()


def asset_ids(spark: SparkSession, path: str, ext: str = ".jpg") -> DataFrame:
    """Ids of the items whose asset ``{id}{ext}`` lies under ``path``.

    No file is opened, so that opening one is set to cost little: a task then lists thousands of files, not some tens.
    """
    with _settings(spark, spark__sql__files__openCostInBytes=str(LISTED_BYTES)):
        return materialize(listed_ids(list_files(spark, path), ext), "asset-ids")


def first_fit(lengths: list[int], target: int) -> list[int]:
    """Bin of each length, by first-fit decreasing: the longest first, each into the first bin with room for it."""
    order = sorted(range(len(lengths)), key=lambda at: -lengths[at])
    size = 1
    while size < len(lengths):
        size *= 2
    # a tree of the most room below each node finds the first bin with room in a logarithm of steps
    room, place = [target] * (2 * size), [0] * len(lengths)
    for at in order:
        node = 1
        while node < size:
            node = 2 * node if room[2 * node] >= lengths[at] else 2 * node + 1
        place[at] = node - size
        room[node] -= lengths[at]
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return place


def pack_files(files: DataFrame, target: int, group_files: int = 50_000) -> DataFrame:
    """``file``, ``length``, ``bin`` and ``pieces`` of files (``file``, ``length``): bins of at most ``target`` bytes.

    A larger file is cut into ``pieces`` of at most that size, with a bin each from ``bin`` on. Files are packed in groups of about
    ``group_files``, a task each.
    """

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["pieces", "length", "file"], ascending=[False, False, True])
        large = part["pieces"] > 1
        bins = (part["pieces"].cumsum() - part["pieces"]).where(large, 0)
        bins[~large] = int(part["pieces"][large].sum()) + pd.Series(first_fit(part["length"][~large].tolist(), target), part.index[~large])
        return part.assign(bin=bins.astype("int64"))

    pieces = F.greatest(F.ceil(F.col("length") / target), F.lit(1)).cast("long")
    files = materialize(files.select("file", "length").withColumn("pieces", pieces), "files")
    groups = max(1, -(-files.count() // group_files))
    grouped = files.withColumn("group", F.pmod(F.xxhash64("file"), F.lit(groups))).groupBy("group")
    packed = grouped.applyInPandas(pack, "file string, length long, pieces long, group long, bin long")
    packed = materialize(packed, "packed-files")
    # at most one row per group reaches this window
    ends = packed.groupBy("group").agg(F.max(F.col("bin") + F.col("pieces")).alias("_bins"))
    before = F.sum("_bins").over(Window.partitionBy(F.lit(0)).orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    shifted = packed.join(ends.select("group", F.coalesce(before, F.lit(0)).alias("_shift")), "group")
    return shifted.select("file", "length", (F.col("bin") + F.col("_shift")).alias("bin"), "pieces")


def read_packed(spark: SparkSession, path: str, target: int, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Files under ``path`` with their rows in partitions that hold at most ``target`` bytes of files each.

    Small files are packed by first-fit decreasing, large ones are dealt over several partitions row by row. The rows are shuffled
    once; a write of the result makes one file per partition, so this is how to compact a tree of small files.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    sizes = listed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"))
    packed = materialize(pack_files(sizes, target), "bins")
    bins = packed.agg(F.coalesce(F.max(F.col("bin") + F.col("pieces")), F.lit(1))).first()[0]
    reader = spark.read.format(fmt).option("recursiveFileLookup", True)
    rows = (reader.schema(schema) if schema is not None else reader).load(path)
    names = rows.columns
    tagged = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    named = packed.select(F.col("file").alias("_file"), F.col("bin").alias("_bin"), F.col("pieces").alias("_pieces"))
    dealt = tagged.join(named, "_file").withColumn("_bin", F.col("_bin") + F.pmod("_row", "_pieces"))
    return dealt.repartitionById(int(bins), F.col("_bin").cast("int")).select(names)


def sql_table(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """SQL text over catalogue tables, or over DataFrames named as ``{name}`` in the text."""
    return spark.sql(query, **frames)


def epochs(runs: DataFrame) -> DataFrame:
    """One row per epoch out of documents that hold one array per metric; a metric that is not there is null."""
    none = F.array().cast("array<double>")
    arrays = runs.select("run", *[F.coalesce(f"training_history.{name}", none).alias(name) for name in HISTORY_METRICS])
    exploded = arrays.select("run", F.posexplode(F.arrays_zip(*HISTORY_METRICS)).alias("pos", "m"))
    return exploded.select("run", (F.col("pos") + 1).cast("bigint").alias("epoch"), "m.*")


def read_training_history(spark: SparkSession, path: str, run: Column | None = None, lines: bool = False) -> DataFrame:
    """Training documents under ``path`` as one row per (run, epoch); the run is the file path unless ``run`` says otherwise.

    A file is one document, or with ``lines`` one document per line.
    """
    runs = spark.read.schema(TRAINING_RUN).option("multiLine", not lines).json(path)
    return epochs(runs.withColumn("run", F.input_file_name() if run is None else run))


def read_report(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Evaluation reports, one nested row per document; a file is one document, or with ``lines`` one per line."""
    return spark.read.schema(REPORT).option("multiLine", not lines).json(path)


def dataset_inventory(spark: SparkSession, base: str, names: list[str]) -> DataFrame:
    """Files and bytes per expected dataset folder under ``base``; a folder without files is flagged."""
    below = F.regexp_extract("path", rf"{re.escape(urlparse(base).path.rstrip('/'))}/([^/]+)/", 1)
    sizes = (
        list_files(spark, base)
        .groupBy(below.alias("name"))
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )
    expected = spark.createDataFrame([(name,) for name in names], "name string")
    return expected.join(sizes, "name", "left").select(
        "name",
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.col("files").isNotNull().alias("found"),
    )
