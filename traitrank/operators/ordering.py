"""Positions, ranks and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitrank.sources.staging import Staging

# Largest group that one window task is trusted to sort.
WINDOW_ROWS = 4_000_000

_INDEX = "__index"
_PART = "__part"
# monotonically_increasing_id keeps the partition number above this many bits.
_PART_BITS = 33


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group; only the maximum reaches the driver."""
    if not keys:
        return df.count()
    top = df.groupBy(*keys).count().agg(F.max("count").alias("m")).first()["m"]
    return top or 0


def window_positions(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "position"
) -> DataFrame:
    """``row_number`` per group. Each group is sorted by one task."""
    by = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    return df.withColumn(name, F.row_number().over(by.orderBy(*order)))


def ranged_positions(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    name: str = "position",
    staging: Staging | None = None,
) -> DataFrame:
    """``row_number`` per group where a group may be larger than a task.

    All rows are range-partitioned by group and order and numbered as they lie; a group
    then covers consecutive ranges, and the rows it has in earlier ranges are added. The
    numbered rows are staged first, because both the counts and the result read them and
    must see the same ranges. The order has to be total for the result to be unique.
    """
    staging = staging or Staging.of(df)
    numbered = staging.write(
        df.orderBy(*groups, *order).withColumn(_INDEX, F.monotonically_increasing_id()),
        "numbered",
    ).withColumn(_PART, F.shiftright(_INDEX, _PART_BITS))

    # At most (ranges + groups) rows: a range holds many groups or a group many ranges.
    ranges = numbered.groupBy(*groups, _PART).agg(
        F.min(_INDEX).alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    # Without a group this window holds one row per range, not per input row.
    by = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = by.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranges.select(
        *[F.col(c).alias(f"__of_{c}") for c in groups],
        F.col(_PART).alias("__of_part"),
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__shift"),
    )
    same_range = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in groups]
    return numbered.join(shifts, [*same_range, F.col(_PART) == F.col("__of_part")]).select(
        *df.columns, (F.col(_INDEX) + F.col("__shift")).alias(name)
    )


def positions(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    name: str = "position",
    *,
    group_rows: int | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """``row_number`` per group as INT, by window or by ranges after the largest group.

    ``group_rows`` bounds the rows of the largest group if the caller knows it.
    """
    if group_rows is None:
        group_rows = largest_group(df, groups)
    if group_rows <= WINDOW_ROWS:
        numbered = window_positions(df, groups, order, name)
    else:
        numbered = ranged_positions(df, groups, order, name, staging)
    return numbered.withColumn(name, F.col(name).cast("int"))


def top_k(df: DataFrame, k: int, order: Sequence[Column], name: str | None = None) -> DataFrame:
    """First ``k`` rows over everything; each task keeps only its own best ``k``."""
    best = df.orderBy(*order).limit(k)
    if name is None:
        return best
    return window_positions(best, [], order, name).withColumn(name, F.col(name).cast("int"))


def top_k_per_group(
    df: DataFrame, groups: Sequence[str], k: int, order: Sequence[Column], name: str = "position"
) -> DataFrame:
    """First ``k`` rows of each group. Rows beyond ``k`` are dropped before the shuffle."""
    return (
        window_positions(df, groups, order, name)
        .filter(F.col(name) <= k)
        .withColumn(name, F.col(name).cast("int"))
    )
