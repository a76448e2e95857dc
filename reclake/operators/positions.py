"""Row positions, running values and quantiles for groups of any size, all by one rule.

Rows are range-partitioned on (group, order), so that a large group covers many partitions. Each partition is a numbered block:
values run within a block, and every block is handed what the group's earlier blocks come to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reclake.session import materialize


def _blocks(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` range-partitioned on ``keys``, each partition a numbered block; written, so that blocks stay as they are."""
    return materialize(df.repartitionByRange(*keys).withColumn("_block", F.spark_partition_id()), "blocks")


def _positions_at_once(df: DataFrame, group: list[str], order: list[str], name: str, size: str | None) -> DataFrame:
    """:func:`group_positions` by one shuffle and one sort; each group is in one task."""
    whole = Window.partitionBy(*group)
    placed = df.withColumn(name, F.row_number().over(whole.orderBy(*order)).cast("bigint"))
    return placed.withColumn(size, F.count("*").over(whole)) if size else placed


def group_positions(
    df: DataFrame, group: list[str], order: list[str], name: str = "pos", size: str | None = None, few: int | None = None,
) -> DataFrame:
    """Add the 1-based position by ``order`` and, if ``size`` is given, the number of rows of the group.

    ``group`` and ``order`` together identify a row; rows without a group are left out. A task holds one block; the sizes of a
    group's blocks are at most one row per partition. With ``few``, groups of at most so many rows are kept whole, in one task
    each, and only larger ones are cut into blocks: for tables most of whose groups are small, that is a shuffle and a write less.
    """
    if few is not None:
        keyed = df.filter(reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in group]))
        large = keyed.groupBy(*group).agg(F.count("*").alias("_n")).filter(F.col("_n") > few).select(*group)
        large = materialize(large, "large-groups")
        names = [*group, *[column for column in df.columns if column not in group], name, *([size] if size else [])]
        if large.isEmpty():
            return _positions_at_once(keyed, group, order, name, size).select(names)
        small = _positions_at_once(keyed.join(large, group, "left_anti"), group, order, name, size)
        return small.select(names).unionByName(group_positions(keyed.join(large, group, "left_semi"), group, order, name, size).select(names))
    blocks = _blocks(df, [*group, *order])
    sizes = blocks.groupBy(*group, "_block").agg(F.count("*").alias("_size"))
    by_block = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = [F.coalesce(F.sum("_size").over(by_block), F.lit(0)).alias("_shift")]
    if size:
        shifts.append(F.sum("_size").over(Window.partitionBy(*group)).alias(size))
    inside = Window.partitionBy(*group, "_block").orderBy(*order)
    placed = blocks.withColumn(name, F.row_number().over(inside).cast("bigint"))
    placed = placed.join(sizes.select(*group, "_block", *shifts), [*group, "_block"])
    return placed.withColumn(name, F.col(name) + F.col("_shift")).drop("_block", "_shift")


def _fold(how: str, value: str) -> Column:
    return {"min": F.min, "max": F.max, "sum": F.sum, "last": F.last}[how](value)


def running(df: DataFrame, group: list[str], order: str | list[str], value: str, how: str, name: str) -> DataFrame:
    """``min``, ``max``, ``sum`` or ``last`` of ``value`` over the rows before each row, by ``order`` within its group.

    ``last`` is the value of the row just before. A row combines the rows before it in its block with what all earlier blocks
    hand on; null where there is nothing before it.
    """
    order = [order] if isinstance(order, str) else order
    spread = _blocks(df, [*group, *order])
    whole = F.max_by(value, F.struct(*order)) if how == "last" else _fold(how, value)
    handed = spread.groupBy(*group, "_block").agg(whole.alias("_whole"))
    by_block = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    handed = handed.select(*group, "_block", _fold(how, "_whole").over(by_block).alias("_handed"))
    inside = Window.partitionBy(*group, "_block").orderBy(*order)
    spread = spread.withColumns({
        "_inside": _fold(how, value).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
        "_first": F.row_number().over(inside) == 1,
    }).join(handed, [*group, "_block"])
    combined = {
        "min": F.least("_inside", "_handed"),
        "max": F.greatest("_inside", "_handed"),
        "sum": F.coalesce(F.col("_inside") + F.col("_handed"), "_inside", "_handed"),
        "last": F.when(F.col("_first"), F.col("_handed")).otherwise(F.col("_inside")),
    }[how]
    return spread.withColumn(name, combined).drop("_block", "_inside", "_first", "_handed")


def group_quantiles(df: DataFrame, group: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, for groups of any size.

    Equal values are counted first; the counts are then range-partitioned and summed block by block, so no task needs
    all values of a group.
    """
    counts = df.groupBy(*group, value).agg(F.count("*").alias("_n"))
    blocks = _blocks(counts, [*group, value])
    sizes = blocks.groupBy(*group, "_block").agg(F.sum("_n").alias("_size"))
    by_block = Window.partitionBy(*group).orderBy("_block")
    shifts = sizes.select(
        *group, "_block",
        F.coalesce(F.sum("_size").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"),
        F.sum("_size").over(Window.partitionBy(*group)).alias("_total"),
    )
    inside = Window.partitionBy(*group, "_block").orderBy(value)
    placed = blocks.withColumn("_upto", F.sum("_n").over(inside)).join(shifts, [*group, "_block"])
    placed = placed.withColumn("_upto", F.col("_upto") + F.col("_shift"))
    picks = []
    for name, probability in probabilities.items():
        place = F.lit(probability) * (F.col("_total") - 1)
        picks += [
            F.min(F.when(F.col("_upto") > F.floor(place), F.col(value))).alias(f"_{name}_low"),
            F.min(F.when(F.col("_upto") > F.ceil(place), F.col(value))).alias(f"_{name}_high"),
            F.max(place - F.floor(place)).alias(f"_{name}_part"),
        ]
    return placed.groupBy(*group).agg(*picks).select(*group, *[
        (F.col(f"_{name}_low") + (F.col(f"_{name}_high") - F.col(f"_{name}_low")) * F.col(f"_{name}_part")).alias(name)
        for name in probabilities
    ])
