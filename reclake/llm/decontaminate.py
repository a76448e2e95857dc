"""Benchmark decontamination by spaced seeds. DataFrame functions only on the main path."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.llm.common import LAST_ID, keyed, rest, word_array
from reclake.llm.registry import query, table
from reclake.session import materialize

# 1: the word counts, 0: it may differ. A passage that reaches MIN_SCORE has a run of five equal words, which the
# first mask cannot miss; the second also finds runs of four with a changed word inside.
MASKS = ("11011", "1101011")
MIN_SCORE = 13
PENALTY = 4
MAX_BROADCAST_SEEDS = 2_000_000


def _hashes(text: Column) -> Column:
    return F.transform(word_array(F.lower(text)), lambda word: F.xxhash64(word))


def _seeds(df: DataFrame, keep: list[str], masks: Sequence[str]) -> DataFrame:
    """One row per position of ``_w`` and mask that fits there: ``keep``, ``_at`` and the hash ``_seed``."""
    span = max(map(len, masks))
    window = F.arrays_zip(*[rest(F.col("_w"), i).alias(f"w{i}") if i else F.col("_w").alias("w0") for i in range(span)])
    rows = df.select(*keep, F.posexplode(window).alias("_at", "_x"))
    seeds = [
        F.when(
            F.col(f"_x.w{len(mask) - 1}").isNotNull(),
            F.xxhash64(F.lit(number), *[F.col(f"_x.w{i}") for i, bit in enumerate(mask) if bit == "1"]),
        )
        for number, mask in enumerate(masks)
    ]
    return rows.select(*keep, "_at", F.explode(F.array(*seeds)).alias("_seed")).filter(F.col("_seed").isNotNull())


def _best_segment(same: Column, penalty: int) -> Column:
    """Highest-scoring run of an array of booleans: +1 for true, -``penalty`` for false; the first of equals.

    A struct of score, length and end (exclusive).
    """
    zero = F.struct(*[F.lit(0).alias(n) for n in ("run", "len", "at", "score", "length", "end")])

    def step(a: Column, equal: Column) -> Column:
        run = F.greatest(a["run"], F.lit(0)) + F.when(equal, F.lit(1)).otherwise(F.lit(-penalty))
        length = F.when(a["run"] > 0, a["len"]).otherwise(F.lit(0)) + 1
        better = run > a["score"]
        return F.struct(
            run.alias("run"), length.alias("len"), (a["at"] + 1).alias("at"),
            F.when(better, run).otherwise(a["score"]).alias("score"),
            F.when(better, length).otherwise(a["length"]).alias("length"),
            F.when(better, a["at"] + 1).otherwise(a["end"]).alias("end"),
        )

    return F.aggregate(same, zero, step)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS, min_score: int = MIN_SCORE,
    penalty: int = PENALTY, max_broadcast: int = MAX_BROADCAST_SEEDS,
) -> DataFrame:
    """Pairs of a document and a benchmark item it quotes: ``doc_id``, ``item_id``, ``doc_start``, ``item_start``,
    ``n_words``, ``n_matched`` (word positions of the best passage) and the internal ``_key``, ``_ver``.

    Words are lower-cased. Each position of a text gives one hash per mask; hashes shared with an item name a diagonal
    (document position minus item position). On each such diagonal the whole overlap is compared word by word, and the
    passage with the highest score counts: +1 for an equal word, -``penalty`` for a changed one. A pair is reported if
    its best passage scores at least ``min_score``, or the item's length if that is shorter. Items shorter than the
    shortest mask are compared by a mask of their own length.

    The seeds of the benchmark are counted; up to ``max_broadcast`` they are broadcast, above they are joined by a
    shuffle. Hits are reduced to distinct diagonals before the texts are joined back. Benchmarks repeated under several
    ids give a row each. Null or empty texts and items match nothing. Repeated rows are one document.
    """
    span = min(map(len, masks))
    items = benchmark.select("item_id", _hashes(F.coalesce("text", F.lit(""))).alias("_w")).distinct()
    items = materialize(items.filter(F.size("_w") > 0), "benchmark")
    short = [row[0] for row in items.select(F.size("_w")).filter(F.size("_w") < span).distinct().collect()]
    masks = [*masks, *["1" * n for n in sorted(short)]]
    wanted = [F.size("_w") >= span, *[F.size("_w") == n for n in sorted(short)]]
    known = [_seeds(items.filter(wanted[0]), ["item_id"], masks)]
    known += [_seeds(items.filter(fits), ["item_id"], masks) for fits in wanted[1:]]
    known = reduce(DataFrame.unionByName, known).withColumnRenamed("_at", "_item_at")
    known = materialize(known, "benchmark-seeds")
    if known.count() <= max_broadcast:
        known = F.broadcast(known)
    base = keyed(docs)
    seeds = _seeds(base.select("_key", "_ver", _hashes(F.col("text")).alias("_w")), ["_key", "_ver"], masks)
    hits = seeds.join(known, "_seed").groupBy("_key", "_ver", "item_id").agg(
        F.collect_set(F.col("_at") - F.col("_item_at")).alias("_diagonals"))
    hits = materialize(hits, "seed-hits")
    texts = base.join(hits, ["_key", "_ver"]).join(items.withColumnRenamed("_w", "_item"), "item_id")
    texts = texts.select("doc_id", "_key", "_ver", "item_id", "_diagonals", "_item", _hashes(F.col("text")).alias("_w"))
    lines = texts.select("*", F.explode("_diagonals").alias("_d"))
    first, item_first = F.greatest("_d", F.lit(0)), F.greatest(-F.col("_d"), F.lit(0))
    length = F.least(F.size("_w") - first, F.size("_item") - item_first)
    lines = lines.withColumns({"_first": first, "_item_first": item_first, "_length": length})
    same = F.zip_with(
        F.slice("_w", F.col("_first") + 1, F.col("_length")),
        F.slice("_item", F.col("_item_first") + 1, F.col("_length")), lambda a, b: a == b,
    )
    scored = lines.select(
        "doc_id", "_key", "_ver", "item_id", "_first", "_item_first", F.size("_item").alias("_n"),
        _best_segment(same, penalty).alias("_best"))
    passages = scored.filter(F.col("_best.score") >= F.least(F.lit(min_score), F.col("_n"))).select(
        "doc_id", "_key", "_ver", "item_id",
        F.struct(
            F.col("_best.score").alias("score"),
            (F.col("_best.length") - F.col("_best.end") - F.col("_first")).alias("before"),
            (F.col("_item_first") + F.col("_best.end") - F.col("_best.length")).alias("item_start"),
            F.col("_best.length").alias("length"),
        ).alias("_p"),
    )
    best = passages.groupBy("doc_id", "_key", "_ver", "item_id").agg(F.max("_p").alias("_p"))
    wrong = (F.col("_p.length") - F.col("_p.score")) / (penalty + 1)
    return best.select(
        "doc_id", "item_id", (-F.col("_p.before")).cast("long").alias("doc_start"),
        F.col("_p.item_start").cast("long").alias("item_start"), F.col("_p.length").cast("long").alias("n_words"),
        (F.col("_p.length") - wrong).cast("long").alias("n_matched"), "_key", "_ver",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that quote a benchmark item; columns as they are, rows of one document alike."""
    bad = find_contamination(docs, benchmark).select("_key", "_ver").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    marked = docs.select(F.struct("*").alias("_row"), key.alias("_key"), F.xxhash64(text).alias("_ver"))
    return marked.join(bad, ["_key", "_ver"], "left_anti").select("_row.*")


@query("op4_decontamination", """
with items as (
    select item_id, string_split_regex(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[ \\t-\\r]+') as w
    from benchmark
), docs as (
    select doc_id, string_split_regex(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[ \\t-\\r]+') as w
    from documents
), d as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as pos from docs where len(w) > 0),
i as (select item_id, unnest(w) as x, generate_subscripts(w, 1) as pos from items where len(w) > 0),
fives as (select doc_id, pos, x || ' ' || lead(x, 1) over o || ' ' || lead(x, 2) over o || ' ' || lead(x, 3) over o || ' ' || lead(x, 4) over o as five
    from d window o as (partition by doc_id order by pos)),
item_fives as (select item_id, pos, x || ' ' || lead(x, 1) over o || ' ' || lead(x, 2) over o || ' ' || lead(x, 3) over o || ' ' || lead(x, 4) over o as five
    from i window o as (partition by item_id order by pos)),
diagonals as (select distinct doc_id, item_id, f.pos - g.pos as diag from fives f join item_fives g using (five)),
pairs as (
    select doc_id, item_id, diag, d.pos, case when d.x = i.x then 1 else 0 end as same
    from diagonals join i using (item_id) join d using (doc_id) where d.pos = i.pos + diag
), sums as (
    select *, sum(5 * same - 4) over (partition by doc_id, item_id, diag order by pos) as upto from pairs
), lows as (
    select *, least(0, coalesce(min(upto) over (partition by doc_id, item_id, diag order by pos
        rows between unbounded preceding and 1 preceding), 0)) as low from sums
), best as (
    select doc_id, item_id, max(upto - low) as score from lows group by all
)
select doc_id, item_id, cast(score as bigint) as score from best join items using (item_id)
where score >= least(13, len(w))
""")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    score = F.col("n_matched") - PENALTY * (F.col("n_words") - F.col("n_matched"))
    return found.select("doc_id", "item_id", score.alias("score"))
