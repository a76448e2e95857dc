"""Registration of queries and expansion of the shared SQL views."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.workloads.tables import Tables
from reclake.workloads.views import VIEWS

Build = Callable[[Tables], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def expand(sql: str) -> str:
    """``sql`` with the definitions of the views it names, and of those that they name, in a WITH clause."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name not in needed and name in VIEWS:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} as ({VIEWS[name]})" for name in needed)
    body = sql.strip()
    body = f",\n{body[5:]}" if body.lower().startswith("with ") else f"\n{body}"
    return f"with {views}{body}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """``df`` with all its doubles rounded, so that two engines' sums can be compared."""
    return df.select([
        F.round(F.col(f"`{name}`"), digits).alias(name) if kind == "double" else F.col(f"`{name}`") for name, kind in df.dtypes
    ])


def query(name: str, sql: str | None = None, digits: int | None = None) -> Callable[[Build], Build]:
    """Register a query; ``sql`` is left out where the result cannot be stated in SQL. ``digits`` rounds its doubles."""

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        if digits is None:
            QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        else:
            QUERIES[name] = lambda spark, sf_dir: rounded(build(Tables(spark, sf_dir)), digits)
        if sql is not None:
            ORACLES[name] = expand(sql)
        return build

    return register
