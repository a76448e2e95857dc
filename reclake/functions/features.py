"""Scalar feature expressions: labels, star scale, record keys, attention JSON, seeded hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reclake.contracts import EVENT_TIME_FORMAT, STARS_MIN, STARS_RANGE

PERMUTE_PRIME = 2**31 - 1
PERMUTE_KEYS = 8


def interaction_label(scaled: Column) -> Column:
    """1.0 for a scaled rating above zero, else 0.0. The lowest rating scales to zero, so it counts as negative."""
    return F.when(scaled > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def to_stars(scaled: Column, low: float = STARS_MIN, span: float = STARS_RANGE) -> Column:
    return scaled * span + low


def from_stars(stars: float, low: float = STARS_MIN, span: float = STARS_RANGE) -> float:
    """Scaled threshold for a number of stars."""
    return (stars - low) / span


def event_time(epoch_seconds: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` in UTC, whatever the session time zone is."""
    utc = F.to_utc_timestamp(F.timestamp_seconds(epoch_seconds), F.current_timezone())
    return F.date_format(utc, EVENT_TIME_FORMAT)


def record_id(user: Column, item: Column) -> Column:
    return F.concat_ws("_", user.cast("string"), item.cast("string"))


def attention_json(category: Column, text: Column, image: Column) -> Column:
    return F.to_json(F.struct(category.alias("category"), text.alias("text"), image.alias("image")))


def hash_int(*parts: Column) -> Column:
    """Seeded draw in [0, 2**60): the first fifteen hex digits of the md5 of the joined parts."""
    digest = F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash_unit(*parts: Column) -> Column:
    """Seeded draw in [0, 1)."""
    return hash_int(*parts) / F.lit(float(2**60))


def hash_keys(count: int, *parts: Column) -> list[Column]:
    """``count`` seeded numbers in [0, 2**31 - 1): groups of eight hex digits of md5 digests of the joined parts."""
    joined = F.concat_ws("|", *[part.cast("string") for part in parts])
    digests = [F.md5(F.concat(F.lit(f"{number}|"), joined)) for number in range(-(-count // 4))]
    # sixteen digits are read at once, as a signed number, and cut into two
    wholes = [F.conv(F.substring(digests[at // 2], 16 * (at % 2) + 1, 16), 16, -10).cast("bigint") for at in range(-(-count // 2))]
    halves = [F.shiftrightunsigned(wholes[at // 2], 32) if at % 2 == 0 else wholes[at // 2].bitwiseAND(2**32 - 1) for at in range(count)]
    return [half % PERMUTE_PRIME for half in halves]


def permute(number: Column, rows: Column, cols: Column, keys: list[Column]) -> Column:
    """Keyed permutation of 0 .. rows * cols - 1: a Feistel network whose halves are row and column of the number.

    Each round adds a keyed hash of one half to the other, so it can be undone and no number comes up twice. The hash is linear
    modulo a prime, with two keys a round.
    """
    halves = [F.floor(number / cols), number % cols]
    for step, size in enumerate((rows, cols, rows, cols)):
        moved, other = step % 2, 1 - step % 2
        add, times = keys[2 * step], keys[2 * step + 1] % (PERMUTE_PRIME - 1) + 1
        hashed = (halves[other] + add) % PERMUTE_PRIME * times % PERMUTE_PRIME
        halves[moved] = (halves[moved] + hashed) % size
    return halves[0] * cols + halves[1]
