"""Score and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def odds_score(count: Column, total: Column) -> Column:
    """Odds of a trait value in percent, truncated: ``count / (total - count) * 100``.

    A value that every holder of the trait type shares scores 0. The arithmetic is done
    in DOUBLE from left to right and cut to INT before any summing, which decides the
    result at the last digit. Odds above about 2.1e7 do not fit INT and are NULL.
    """
    return F.when(count == total, F.lit(0)).otherwise(
        (count / (total - count) * 100).try_cast("int")
    )


def collection_label(address: Column) -> Column:
    """Display name of a collection. Not unique: it keeps 8 characters of the address."""
    # The prefix and the number of address characters in a label.
    return F.concat(F.lit("collection_"), F.lower(F.substring(address, 1, 8)))


def fallback_text(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))
