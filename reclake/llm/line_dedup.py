"""Line dedup: lines found in several documents stay only in the first of them. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.llm.common import ascii_lower, keyed, strip_blanks, two_hashes
from reclake.llm.registry import query, table
from reclake.session import materialize

_LINE = ["_h1", "_h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(strip_blanks(line))


def drop_shared_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, carry: Sequence[str] = ()) -> DataFrame:
    """Per row ``doc_id``, ``text`` without shared lines, ``n_lines`` before dropping, ``n_dropped`` and the columns ``carry``.

    A line's key is the line without blanks at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code points in
    at least ``min_docs`` documents lose all their lines except in the document with the smallest id.

    Lines are exploded once with two hashes of the key and their position. Documents per key are counted in two steps,
    so that a line in a third of all documents is summed before the shuffle; the shared keys are written and joined
    back, where adaptive execution can split a hot key on both sides. Texts are shuffled once.

    Null or empty text: one empty line. Missing ids count as one document that comes last. Repeated rows are one
    document. No shared key (or no rows): texts come back unchanged. Other columns are dropped.
    """
    carried = F.struct(F.lit(0).alias("_"), *carry)
    base = keyed(docs.withColumn("_carry", carried), "_carry")
    lines = base.select("_key", "_ver", F.posexplode(F.split("text", "\n")).alias("_pos", "_line")).select(
        "_key", "_ver", "_pos", line_key(F.col("_line")).alias("_line")
    ).filter(F.length("_line") >= min_chars)
    first, second = two_hashes(F.col("_line"))
    lines = materialize(lines.select("_key", "_ver", "_pos", first.alias("_h1"), second.alias("_h2")), "lines")
    shared = (
        lines.groupBy(*_LINE, "_key").agg(F.lit(1).alias("_one"))
        .groupBy(*_LINE).agg(F.count("_one").alias("_docs"), F.min("_key").alias("_keeper"))
        .filter(F.col("_docs") >= min_docs).select(*_LINE, "_keeper")
    )
    shared = materialize(shared, "shared-lines")
    gone = (
        lines.join(shared, _LINE).filter(F.col("_key") != F.col("_keeper"))
        .groupBy("_key", "_ver").agg(F.collect_set("_pos").alias("_gone"))
    )
    none = F.array().cast("array<int>")
    joined = base.join(gone, ["_key", "_ver"], "left").select(
        "doc_id", "_carry", F.split("text", "\n").alias("_lines"), F.coalesce("_gone", none).alias("_gone")
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    # _lines is named twice, which keeps the split out of the lambda.
    return joined.select(
        "doc_id",
        F.array_join(F.transform(left, lambda at: F.get("_lines", at)), "\n").alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_dropped"),
        *[F.col("_carry").getField(name).alias(name) for name in carry],
    )


@query("op10_line_dedup", """
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents
), keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
    from lines
), shared as (
    select k, min(doc_id) as keeper from keyed where length(k) >= 10 group by k having count(distinct doc_id) >= 2
), marked as (
    select keyed.*, keeper is not null and doc_id <> keeper as gone from keyed left join shared using (k)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_shared_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
