"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: blanks that separate words, ASCII letters ----
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[ \\t-\\r]+"
WORD = re.compile("[^ \t-\r]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)
LAST_ID = (1 << 63) - 1
# ---- end of fixed values ----


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty), the columns ``more`` and two internal keys; all other columns go.

    ``_key`` orders documents (a missing id comes last), ``_ver`` tells apart rows that share an id but not the text.
    Rows repeated with id and text are one document and get the same result each.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), *more).withColumns({
        "_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "_ver": F.xxhash64("text"),
    })


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, other letters as they are. Pure ASCII takes the faster built-in."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def strip_blanks(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def word_array(text: Column) -> Column:
    """Words of a text without nulls; an empty array when there are none."""
    stripped = strip_blanks(text)
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, BLANK_RUN))


def rest(array: Column, n: int) -> Column:
    """``array`` without its first ``n`` elements."""
    return F.slice(array, F.lit(n + 1), F.greatest(F.size(array) - n, F.lit(0)))


def two_hashes(*cols: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes, so that equal pairs mean equal values at any corpus size."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(7), *cols)
