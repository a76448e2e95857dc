"""Text and list expressions; all native, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclake.contracts import NO_SYNOPSIS, UNKNOWN

# ---- fixed values: characters counted as blank, labels of the semantic text ----
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# label, source column, holds a list, text used when the table lacks the column
SEMANTIC_PARTS = [
    ("title", "titulo", False, UNKNOWN),
    ("tagline", "frase_promocional", False, ""),
    ("director", "director", False, UNKNOWN),
    ("cast", "actores", True, ""),
    ("keywords", "palabras_clave", True, ""),
    ("sinopsis", "sinopsis", False, NO_SYNOPSIS),
]
# ---- end of fixed values ----


def strip(col: Column) -> Column:
    """Remove blanks, Unicode ones included, from both ends."""
    return F.btrim(col, F.lit(BLANKS))


def clean_text(col: Column) -> Column:
    """One-line text: line separators become spaces, carriage returns go, ends are stripped, null is empty."""
    one_line = F.translate(col, "\u2028\u2029\n\r", "   ")
    return F.coalesce(strip(one_line), F.lit(""))


def pipe_join(col: Column, is_array: bool = True) -> Column:
    """``a|b|c`` out of an array; the unknown label when nothing is left. A string passes through."""
    if not is_array:
        return F.when(strip(col) != "", col).otherwise(F.lit(UNKNOWN))
    kept = F.filter(F.transform(col, strip), lambda part: part.isNotNull() & (part != ""))
    return F.when(F.size(kept) > 0, F.array_join(kept, "|")).otherwise(F.lit(UNKNOWN))


def pipe_split(col: Column) -> Column:
    """Array out of ``a|b|c``: parts stripped, empty parts dropped."""
    return F.filter(F.transform(F.split(col, r"\|"), strip), lambda part: part != "")


def list_text(col: Column, is_array: bool = True) -> Column:
    """``a, b`` out of an array or of a string that looks like a list; null and ``nan`` give the empty text."""
    if is_array:
        return F.coalesce(F.array_join(col, ", "), F.lit(""))
    parsed = F.when(strip(col).startswith("["), F.from_json(col, "array<string>"))
    return (
        F.when(col.isNull() | (F.lower(col) == "nan"), F.lit(""))
        .when(parsed.isNotNull(), F.array_join(parsed, ", "))
        .otherwise(F.translate(col, "[]", ""))
    )


def semantic_text(df: DataFrame, parts: list[tuple[str, str, bool, str]] | None = None) -> Column:
    """Labelled description of an item, ``label: value`` parts joined by ``. ``; blank parts are left out."""
    pieces = []
    for label, name, is_list, default in parts or SEMANTIC_PARTS:
        if name not in df.columns:
            value = F.lit(default)
        elif is_list:
            value = list_text(F.col(name), df.schema[name].dataType.typeName() == "array")
        else:
            value = F.col(name).cast("string")
        usable = (strip(value) != "") & (F.lower(value) != "nan")
        pieces.append(F.when(usable, F.concat(F.lit(f"{label}: "), value)))
    return F.concat_ws(". ", *pieces)
