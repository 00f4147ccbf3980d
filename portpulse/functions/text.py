"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Distinct lower-case words of a text; none for null."""
    tokens = F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != "")
    return F.coalesce(tokens, F.array().cast("array<string>"))


def share_a_word(left: Column, right: Column) -> Column:
    return F.arrays_overlap(words(left), words(right))


def safe_name(text: Column) -> Column:
    """Keep letters, digits and underscores; null becomes ``unknown``."""
    return F.coalesce(F.regexp_replace(text, "[^a-zA-Z0-9_]", ""), F.lit("unknown"))


def place_text(address: Column, suburb: Column, postcode: Column) -> Column:
    """``address, suburb, postcode``; null when any part is null."""
    return F.concat(address, F.lit(", "), suburb, F.lit(", "), postcode.cast("string"))


def program_label(program: Column, round_: Column) -> Column:
    return F.concat_ws(" ", program, round_.cast("string"))
