"""Embedding near-dedup by an epsilon grid order join: vectors sorted by grid cells, sequence intervals joined by recursion."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.llm.common import LAST_ID, two_hashes
from reclake.llm.graph import components
from reclake.llm.registry import query, table
from reclake.llm.vectors import bring_back, finite, lists, matrix, moments
from reclake.session import materialize

MIN_COSINE = 0.98
DIMS, BLOCK, FAN, LEAF = 8, 2048, 8, 128
# Bounds on distances are trusted beyond this much only, cosines nearer to the threshold are summed exactly.
SLACK, CLOSE = 1e-9, 1e-12
_GROUP = ["label", "size"]


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither vanish nor overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _distinct(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with their hashes (null: linked with nothing), and each usable vector of a label once."""
    vector = F.col("embedding")
    nonzero = F.exists(vector, lambda c: c.cast("double") != 0)
    one, two = two_hashes(F.col("label"), vector)
    ok = F.col("label").isNotNull() & finite(vector) & nonzero
    rows = embeddings.select("vec_id", "label", vector.alias("v"), F.when(ok, one).alias("one"), F.when(ok, two).alias("two"))
    usable = rows.filter("one is not null").withColumn("size", F.size("v"))
    found = usable.groupBy(*_GROUP, "one", "two", "v").agg(
        F.min(F.coalesce("vec_id", F.lit(LAST_ID))).alias("low"), F.count("*").alias("w"))
    return rows.select("vec_id", "one", "two"), found


def principal_axes(found: DataFrame, size: int, dims: int) -> np.ndarray:
    """Leading directions of the unit vectors; they set the order only, any others would give the same links."""
    n, sums, products = moments(found.withColumn("w", F.lit(1.0)), size, unit_rows, size, "v")
    centre = sums / n
    _, axes = np.linalg.eigh(products / n - np.outer(centre, centre))
    return axes[:, ::-1][:, :dims]


def _project(unit: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading coordinates; vectors of another length are cut or filled up with zeros, which lengthens no distance."""
    both = min(unit.shape[1], len(axes))
    return unit[:, :both] @ axes[:both]


def in_grid_order(found: DataFrame, axes: np.ndarray, eps: float) -> DataFrame:
    """``found`` sorted by label and grid cells of width ``eps`` on the leading axes, in range partitions."""
    dims = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                cells = np.floor(_project(unit_rows(matrix(part.column(4))), axes) / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(cells[:, at]) for at in range(dims)]], [*part.schema.names, *[f"c{at}" for at in range(dims)]])

    names = [*_GROUP, "one", "two", "v", "low", "w"]
    kinds = dict(found.dtypes)
    schema = ", ".join([*[f"{name} {kinds[name]}" for name in names], *[f"c{at} int" for at in range(dims)]])
    order = [*_GROUP, *[f"c{at}" for at in range(dims)], "one", "two"]
    cells = found.select(*names).mapInArrow(run, schema)
    return cells.repartitionByRange(*order).sortWithinPartitions(*order).select(*names)


def blocks(ordered: DataFrame, axes: np.ndarray, block: int) -> DataFrame:
    """The sequence cut into blocks of at most ``block`` vectors of one label, written.

    Rows of ``kind`` 0 are vectors with their ``block`` and ``node`` number, rows of kind 1 are blocks: first ``node``, total
    weight, box ``lo`` to ``hi`` on the leading axes, and ``centre`` and ``radius`` of a ball around the unit vectors.
    """
    kinds, carried = dict(ordered.dtypes), ordered.columns
    names = ["kind", *carried, "block", "node", "lo", "hi", "centre", "radius"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 40, 0

        def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            unit = unit_rows(matrix(rows.column(4)))
            node = base + made + np.arange(len(unit))
            made += len(unit)
            centre = unit.mean(axis=0)
            radius = float(np.sqrt(((unit - centre) ** 2).sum(axis=1).max()))
            place = _project(unit, axes)
            n, none = len(unit), lambda kind, n: pa.nulls(n, kind)
            yield pa.RecordBatch.from_arrays([
                pa.array([0] * n, pa.int32()), *[rows.column(at) for at in range(7)], pa.array(np.full(n, node[0])), pa.array(node),
                *[none(pa.list_(pa.float64()), n)] * 3, none(pa.float64(), n),
            ], names)
            one = rows.slice(0, 1)
            yield pa.RecordBatch.from_arrays([
                pa.array([1], pa.int32()), one.column(0), one.column(1), none(pa.int64(), 1), none(pa.int64(), 1),
                none(rows.column(4).type, 1), pa.array([min(rows.column(5).to_pylist())], pa.int64()),
                pa.array([sum(rows.column(6).to_pylist())], pa.int64()), pa.array([node[0]]), pa.array([node[0]]),
                lists(place.min(axis=0)[None], pa.float64()), lists(place.max(axis=0)[None], pa.float64()),
                lists(centre[None], pa.float64()), pa.array([radius]),
            ], names)

        held, count, group = [], 0, None
        for batch in batches:
            labels = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            at = 0
            while at < len(labels):
                if held and (count == block or labels[at] != group):
                    yield from close(held)
                    held, count = [], 0
                group, end = labels[at], at
                while end < len(labels) and labels[end] == group and count + end - at < block:
                    end += 1
                held.append(batch.slice(at, end - at))
                count, at = count + end - at, end
        if held:
            yield from close(held)

    schema = "kind int, " + ", ".join(f"{name} {kinds[name]}" for name in carried)
    schema += ", block long, node long, lo array<double>, hi array<double>, centre array<double>, radius double"
    return materialize(ordered.mapInArrow(run, schema), "grid-blocks")


def _merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """An interval out of at most ``FAN`` neighbours: box of the boxes, ball around the balls."""
    part = part.sort_values("at")
    centres, radii = np.stack(part["centre"]), part["radius"].to_numpy()
    centre = centres.mean(axis=0)
    radius = float((np.sqrt(((centres - centre) ** 2).sum(axis=1)) + radii).max())
    return pd.DataFrame({
        "label": [key[0]], "size": [key[1]], "at": [key[2]], "first": [part["first"].iloc[0]], "w": [part["w"].sum()],
        "lo": [np.stack(part["lo"]).min(axis=0)], "hi": [np.stack(part["hi"]).max(axis=0)], "centre": [centre], "radius": [radius],
    })


def interval_tree(marked: DataFrame, fan: int) -> list[DataFrame]:
    """Intervals of the sequence of each label: blocks first, then ``fan`` neighbours in one, up to one interval per label."""
    within = Window.partitionBy(*_GROUP).orderBy("block")
    lows = marked.filter("kind = 1").select(*_GROUP, F.col("node").alias("first"), "w", "lo", "hi", "centre", "radius", "block")
    places = lows.select(*_GROUP, "block", (F.row_number().over(within) - 1).cast("long").alias("at"))
    level = materialize(lows.join(places, [*_GROUP, "block"]), "grid-level")
    levels = [level.drop("block")]
    blocks_at = level.select(*_GROUP, "block", "at")
    while levels[-1].agg(F.max("at")).first()[0]:
        up = levels[-1].withColumn("up", F.floor(F.col("at") / fan))
        kinds = dict(level.dtypes)
        names = [*_GROUP, "at", "first", "w", "lo", "hi", "centre", "radius"]
        schema = ", ".join(f"`{name}` {kinds[name]}" for name in names)
        levels.append(materialize(up.groupBy(*_GROUP, "up").applyInPandas(_merge, schema), "grid-level"))
    return [blocks_at, *levels]


def _gap(side: str, other: str, dims: int) -> Column:
    """Least distance between two boxes."""
    apart = lambda at: F.greatest(
        F.get(f"lo_{side}", F.lit(at)) - F.get(f"hi_{other}", F.lit(at)),
        F.get(f"lo_{other}", F.lit(at)) - F.get(f"hi_{side}", F.lit(at)), F.lit(0.0))
    return F.sqrt(reduce(lambda a, b: a + b, [apart(at) * apart(at) for at in range(dims)]))


def interval_pairs(levels: list[DataFrame], eps: float, dims: int, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """Pairs of intervals that the recursion ends with, level by level from the top: whole ones, and pairs of blocks to compare.

    A pair is dropped if its boxes or balls are provably more than ``eps`` apart, and whole if its balls prove that every
    vector of one is near every vector of the other. Any other is split into pairs of children.
    """
    centres = F.sqrt(F.aggregate(F.zip_with("centre_a", "centre_b", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
    whole, pairs = [], None
    for height in range(len(levels) - 1, -1, -1):
        sides = []
        for side in "ab":
            names = ["first", "w", "lo", "hi", "centre", "radius"]
            sides.append(levels[height].select(*_GROUP, F.col("at").alias(f"at_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in names]))
        if pairs is None:
            met = sides[0].join(sides[1], _GROUP).filter("at_a = 0 and at_b = 0")
        else:
            open_ = pairs.filter("fate = 'split'").select(*_GROUP, F.col("at_a").alias("up_a"), F.col("at_b").alias("up_b"))
            met = open_
            for side, frame in zip("ab", sides, strict=True):
                met = met.join(frame.withColumn(f"up_{side}", F.floor(F.col(f"at_{side}") / fan)), [*_GROUP, f"up_{side}"])
            met = met.filter("at_a <= at_b")
        far = F.greatest(_gap("a", "b", dims), F.col("_centres") - F.col("radius_a") - F.col("radius_b")) > eps + SLACK
        near = F.col("_centres") + F.col("radius_a") + F.col("radius_b") <= eps - SLACK
        fate = F.when((F.col("at_a") != F.col("at_b")) & far, "far").when(near, "whole").otherwise("split")
        met = met.withColumn("_centres", centres).withColumn("fate", fate).filter("fate <> 'far'")
        pairs = materialize(met.select(*_GROUP, "at_a", "at_b", "first_a", "first_b", "w_a", "w_b", "fate"), "grid-pairs")
        whole.append(pairs.filter("fate = 'whole'").withColumn("height", F.lit(height)))
    return whole, pairs.filter("fate = 'split'")


def join_blocks(min_cosine: float, eps: float, axes: np.ndarray, leaf: int) -> Callable[[pa.Table], pa.Table]:
    """Function on the rows of two blocks (or of one): per vector the weight of its links and one link of a spanning forest."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        raw, w = matrix(rows["v"]), rows["w"].to_numpy()
        node, side = rows["node"].to_numpy(), rows["side"].to_numpy()
        unit = unit_rows(raw)
        place = _project(unit, axes)
        links, root, known = np.zeros(len(w), np.int64), np.arange(len(w)), {}

        def bounds(low: int, high: int) -> tuple:
            if (low, high) not in known:
                part = unit[low:high]
                centre = part.mean(axis=0)
                radius = math.sqrt(((part - centre) ** 2).sum(axis=1).max())
                known[low, high] = place[low:high].min(axis=0), place[low:high].max(axis=0), centre, radius
            return known[low, high]

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def tie(a0: int, a1: int, b0: int, b1: int, linked: np.ndarray | None) -> None:
            one = np.array([top(x) for x in range(a0, a1)])
            other = np.array([top(x) for x in range(b0, b1)])
            while True:
                new = one[:, None] != other[None, :]
                if linked is not None:
                    new &= linked
                held = np.flatnonzero(new.any(axis=1))
                if not len(held):
                    return
                for x, y in zip(one[held], other[new[held].argmax(axis=1)], strict=True):
                    x, y = sorted((top(int(x)), top(int(y))))
                    root[y] = x
                one, other = np.array([top(x) for x in one]), np.array([top(x) for x in other])

        def compare(a0: int, a1: int, b0: int, b1: int) -> None:
            cosine = unit[a0:a1] @ unit[b0:b1].T
            linked = cosine >= min_cosine
            for i, j in np.argwhere(np.abs(cosine - min_cosine) < CLOSE):
                a, b = raw[a0 + i] / np.abs(raw[a0 + i]).max(), raw[b0 + j] / np.abs(raw[b0 + j]).max()
                exact = math.fsum(a * b) / math.sqrt(math.fsum(a * a)) / math.sqrt(math.fsum(b * b))
                linked[i, j] = exact >= min_cosine
            if a0 == b0:
                np.fill_diagonal(linked, False)
            links[a0:a1] += linked @ w[b0:b1]
            if a0 != b0:
                links[b0:b1] += linked.T @ w[a0:a1]
            tie(a0, a1, b0, b1, linked)

        def intervals(a0: int, a1: int, b0: int, b1: int) -> None:
            """Both intervals are the same or do not overlap."""
            lo_a, hi_a, centre_a, radius_a = bounds(a0, a1)
            lo_b, hi_b, centre_b, radius_b = bounds(b0, b1)
            apart = math.sqrt(((centre_a - centre_b) ** 2).sum())
            box = np.maximum(np.maximum(lo_a - hi_b, lo_b - hi_a), 0)
            if a0 != b0 and max(math.sqrt((box * box).sum()), apart - radius_a - radius_b) > eps + SLACK:
                return
            if apart + radius_a + radius_b <= eps - SLACK:
                links[a0:a1] += w[b0:b1].sum()
                if a0 == b0:
                    links[a0:a1] -= w[a0:a1]
                else:
                    links[b0:b1] += w[a0:a1].sum()
                tie(a0, a1, b0, b1, None)
            elif max(a1 - a0, b1 - b0) <= leaf:
                compare(a0, a1, b0, b1)
            elif a0 == b0:
                half = (a0 + a1) // 2
                intervals(a0, half, a0, half)
                intervals(a0, half, half, a1)
                intervals(half, a1, half, a1)
            elif a1 - a0 >= b1 - b0:
                half = (a0 + a1) // 2
                intervals(a0, half, b0, b1)
                intervals(half, a1, b0, b1)
            else:
                half = (b0 + b1) // 2
                intervals(a0, a1, b0, half)
                intervals(a0, a1, half, b1)

        cut = int((side == 0).sum())
        if cut == len(w):
            intervals(0, cut, 0, cut)
        else:
            intervals(0, cut, cut, len(w))
        tied = node[np.array([top(x) for x in range(len(w))])] if len(w) else node
        kept = (links > 0) | (tied != node)
        return pa.table({"node": node[kept], "n": links[kept], "other": tied[kept]})

    return run


def grid_links(found: DataFrame, min_cosine: float, block: int, fan: int, dims: int, leaf: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct vectors as numbered nodes, the weight of each one's links in parts (``node``, ``n``), and links that connect
    what is connected (``a``, ``b``)."""
    eps = math.sqrt(2 - 2 * min_cosine)
    found = materialize(found, "distinct-vectors")
    common = found.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    axes = principal_axes(found, common["size"], dims) if common else np.zeros((1, 1))
    marked = blocks(in_grid_order(found, axes, eps), axes, block)
    nodes = marked.filter("kind = 0").select(*_GROUP, "block", "node", "one", "two", "v", "low", "w")
    blocks_at, *levels = interval_tree(marked, fan)
    whole, pairs = interval_pairs(levels, eps, axes.shape[1], fan)

    named = pairs.select(*_GROUP, "at_a", "at_b")
    sides = []
    for side, name in enumerate("ab"):
        rows = named if side == 0 else named.filter("at_a <> at_b")
        rows = rows.join(blocks_at.withColumnRenamed("at", f"at_{name}"), [*_GROUP, f"at_{name}"])
        sides.append(rows.select(*_GROUP, "at_a", "at_b", "block", F.lit(side).alias("side")))
    dealt = nodes.select("block", "node", "v", "w").join(sides[0].unionByName(sides[1]), "block")
    compared = dealt.groupBy(*_GROUP, "at_a", "at_b").applyInArrow(
        join_blocks(min_cosine, eps, axes, leaf), "node long, n long, other long")
    compared = materialize(compared, "grid-links")
    counts, links = [compared.select("node", "n")], [compared.filter("other <> node").select(F.col("other").alias("a"), F.col("node").alias("b"))]

    whole = materialize(reduce(DataFrame.unionByName, whole), "whole-intervals")
    if not whole.isEmpty():
        # Every vector of both intervals is linked with all of the other; within one interval, with all but itself.
        twice = F.when(F.col("at_a") == F.col("at_b"), F.array(F.struct(F.col("at_a").alias("at"), F.col("w_a").alias("n"), F.col("first_a").alias("first"), F.lit(1).alias("own"))))
        twice = twice.otherwise(F.array(
            F.struct(F.col("at_a").alias("at"), F.col("w_b").alias("n"), F.col("first_a").alias("first"), F.lit(0).alias("own")),
            F.struct(F.col("at_b").alias("at"), F.col("w_a").alias("n"), F.col("first_b").alias("first"), F.lit(0).alias("own"))))
        spread = whole.select(*_GROUP, "height", F.inline(twice))
        spread = spread.groupBy(*_GROUP, "height", "at").agg(F.sum("n").alias("n"), F.max("own").alias("own"), F.min("first").alias("first"))
        above = F.explode(F.sequence(F.lit(0), F.lit(len(levels) - 1))).alias("height")
        climbed = blocks_at.select(*_GROUP, "block", F.col("at").alias("_at"), above)
        climbed = climbed.withColumn("at", F.floor(F.col("_at") / F.pow(F.lit(fan), F.col("height"))))
        of_block = climbed.join(spread, [*_GROUP, "height", "at"]).groupBy("block").agg(
            F.sum("n").alias("n"), F.max("own").alias("own"), F.max_by("first", "height").alias("first"))
        settled = materialize(nodes.select("block", "node", "w").join(of_block, "block"), "whole-links")
        counts.append(settled.select("node", (F.col("n") - F.col("own") * F.col("w")).alias("n")))
        links += [
            settled.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")),
            whole.filter("at_a <> at_b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b")),
        ]
    return nodes, reduce(DataFrame.unionByName, counts), reduce(DataFrame.unionByName, links)


def near_vectors(
    embeddings: DataFrame, min_cosine: float = MIN_COSINE, block: int = BLOCK, fan: int = FAN, dims: int = DIMS, leaf: int = LEAF,
) -> DataFrame:
    """Per row ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (smallest id reachable), ``kept``.

    Rows of one label are linked if the cosine of their vectors, in doubles, is at least ``min_cosine``. Vectors are sorted by
    cells of the grid whose width is the greatest distance of linked unit vectors, on ``dims`` principal axes, and cut into
    blocks of at most ``block``. Intervals of that sequence are joined by recursion: level by level as joins of small tables down
    to pairs of blocks, then within the task that gets the rows of two blocks, down to ``leaf`` vectors. Intervals that boxes
    or balls prove distant are skipped; those proven near throughout are counted without a comparison. A task holds two
    blocks and returns one link a vector at most, so a large group of near copies makes many tasks and no list of pairs.

    Equal vectors are one, with a weight. Vectors that are null, empty, all zero, or hold null or non-finite entries, and those
    without label, are linked with nothing; neither are vectors of different lengths. A missing id comes last, and a component
    of such rows alone has no id. Repeated rows count each as a vector, under the same id or not. Other columns are dropped.
    """
    rows, found = _distinct(embeddings)
    nodes, counts, links = grid_links(found, min_cosine, block, fan, dims, leaf)
    groups = components(links).withColumnRenamed("component", "comp")
    joined = nodes.select("node", "one", "two", "low", "w").join(counts.groupBy("node").agg(F.sum("n").alias("n")), "node", "left")
    joined = joined.join(groups, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    joined = materialize(joined, "linked-vectors")
    lows = joined.groupBy("comp").agg(F.min("low").alias("component_id"))
    answers = joined.join(lows, "comp").select(
        "one", "two", "w", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    answers = materialize(answers, "vector-answers")
    total = answers.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    tied = bring_back(rows.filter("one is not null"), answers, ["one", "two"], total).select("vec_id", "n_links", "component_id")
    tied = tied.withColumn("component_id", F.when((F.col("component_id") < LAST_ID) | (F.col("vec_id") == LAST_ID), F.col("component_id")))
    alone = rows.filter("one is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = tied.unionByName(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op13_embedding_near_dedup", """
    with recursive v as (
        select vec_id, label, list_transform(embedding, lambda c: c::double) as e, row_number() over (order by vec_id) as pos from embeddings),
      u as (select pos, vec_id, label, e, sqrt(list_sum(list_transform(e, lambda c: c * c))) as norm from v
        where label is not null and len(e) > 0 and len(list_filter(e, lambda c: c is null or not isfinite(c))) = 0
          and len(list_filter(e, lambda c: c <> 0)) > 0),
      links as (select a.pos as a, b.pos as b from u a join u b on a.label = b.label and len(a.e) = len(b.e) and a.pos <> b.pos
        where list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) / (a.norm * b.norm) >= 0.98),
      reach as (select pos as a, pos as b from v union select r.a, l.b from reach r join links l on r.b = l.a),
      low as (select r.a, min(t.vec_id) as component_id from reach r join v t on r.b = t.pos group by r.a),
      n as (select a, count(*) as n_links from links group by a)
    select v.vec_id, coalesce(n.n_links, 0) as n_links, low.component_id, v.vec_id is not distinct from low.component_id as kept
    from v join low on v.pos = low.a left join n on v.pos = n.a""")
def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
