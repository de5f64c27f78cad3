"""Reconciliation of listed, enriched and ranked tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank.operators.joins import lookup_join
from traitrank.schemas import TOKEN_KEYS
from traitrank.sources.staging import Staging


def _presence(sides: dict[str, DataFrame]) -> DataFrame:
    """Distinct tokens of all ``sides`` with a flag per side.

    The tables are tagged and meet in one aggregation, whose first half runs before the
    shuffle, so copies of a token are cheap and nothing is joined.
    """
    tagged = [
        df.select(*TOKEN_KEYS, *[F.lit(side == tag).alias(tag) for tag in sides])
        for side, df in sides.items()
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(*TOKEN_KEYS)
        .agg(*[F.bool_or(tag).alias(tag) for tag in sides])
    )


def only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct tokens of ``left`` that ``right`` lacks, as EXCEPT gives them."""
    both = _presence({"left": left, "right": right})
    return both.filter(F.col("left") & ~F.col("right")).select(*TOKEN_KEYS)


def token_counts(**tables: DataFrame) -> DataFrame:
    """Rows and distinct tokens of each table, one row per table, from one pass over each."""

    def counted(label: str, df: DataFrame) -> DataFrame:
        per_token = df.groupBy(*TOKEN_KEYS).agg(F.count(F.lit(1)).alias("n"))
        return per_token.agg(
            F.lit(label).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_tokens"),
        )

    return reduce(DataFrame.unionByName, (counted(k, df) for k, df in tables.items()))


def observed_counts(staging: Staging, **tables: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``token_counts`` taken while each table is written by token, and what was written.

    A table is staged as one row per token with its number of rows, ``n``; both counts are observed
    on that write, so none of it is read for them. Two numbers per table reach the driver.
    """
    counts, written = [], {}
    for label, df in tables.items():
        per_token = df.groupBy(*TOKEN_KEYS).agg(F.count(F.lit(1)).alias("n"))
        sums = {"n_rows": F.coalesce(F.sum("n"), F.lit(0)), "n_tokens": F.count(F.lit(1))}
        written[label], seen = staging.write_counted(per_token, label, sums)
        counts.append((label, seen["n_rows"], seen["n_tokens"]))
    return staging.spark.createDataFrame(counts, "table_name string, n_rows long, n_tokens long"), written


def audit_tokens(base: DataFrame, rarity: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """One row per collection: distinct tokens on either side and on one side only.

    With ``metadata`` it also counts listed tokens that were never enriched.
    """
    sides = {"base": base, "rarity": rarity}
    if metadata is not None:
        sides["metadata"] = metadata
    measures = {
        "n_base": F.col("base"),
        "n_rarity": F.col("rarity"),
        "n_missing": F.col("base") & ~F.col("rarity"),
        "n_extra": F.col("rarity") & ~F.col("base"),
    }
    if metadata is not None:
        measures["n_without_metadata"] = F.col("base") & ~F.col("metadata")
    return _presence(sides).groupBy("collection_id").agg(
        *[F.count_if(test).alias(name) for name, test in measures.items()]
    )


# A collection's ids are kept in bitmaps if a bitmap of 32,768 ids holds so many of them on average.
_DENSE = 64
_BITMAP = 1 << 15


def _number() -> Column:
    """The id as a positive number of at most 63 bits; NULL if it is not the plain text of one."""
    number = F.col("token_id").try_cast("long")
    return F.when((number > 0) & (number.cast("string") == F.col("token_id")), number)


def audit_by_bitmaps(base: DataFrame, rarity: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """``audit_tokens``, by a bitmap per collection, side and 32,768 ids where ids are dense numbers.

    Copies of a token and the tokens of a bitmap meet before the shuffle, in four KB. What only one
    side has is a union's count less the other side's. Ids that are no number of 63 bits, and
    collections whose ids lie too far apart, go the way of ``audit_tokens``.
    """
    sides = {"base": base, "rarity": rarity} | ({} if metadata is None else {"metadata": metadata})
    tagged = reduce(
        DataFrame.unionByName, (df.select(*TOKEN_KEYS, F.lit(side).alias("side"), _number().alias("id")) for side, df in sides.items())
    )
    spans = tagged.groupBy("collection_id").agg(
        F.count("id").alias("n"), (F.max("id") - F.min("id")).alias("span")
    )
    dense = spans.filter((F.col("n") > 0) & (F.col("span") <= F.col("n") * F.lit(_BITMAP // _DENSE))).select("collection_id")
    dense = Staging.of(base).write(dense, "dense")
    by_bitmap = lookup_join(tagged.filter("id IS NOT NULL"), dense, ["collection_id"], how="left_semi", spread=["token_id"])

    def bits(*of: str) -> Column:
        here = F.when(F.col("side").isin(*of), F.expr("bitmap_bit_position(id)"))
        return F.bitmap_count(F.bitmap_construct_agg(here))

    pairs = [("base", "rarity")] + ([("base", "metadata")] if metadata is not None else [])
    buckets = by_bitmap.groupBy("collection_id", F.expr("bitmap_bucket_number(id)").alias("bucket")).agg(
        *[bits(s).alias(s) for s in sides], *[bits(*p).alias("_".join(p)) for p in pairs]
    )
    measures = {
        "n_base": F.col("base"),
        "n_rarity": F.col("rarity"),
        "n_missing": F.col("base_rarity") - F.col("rarity"),
        "n_extra": F.col("base_rarity") - F.col("base"),
    }
    if metadata is not None:
        measures["n_without_metadata"] = F.col("base_metadata") - F.col("metadata")
    counted = buckets.groupBy("collection_id").agg(*[F.sum(m).alias(name) for name, m in measures.items()])

    marked = dense.withColumn("dense", F.lit(True))

    def rest(df: DataFrame) -> DataFrame:
        joined = lookup_join(df.select(*TOKEN_KEYS), marked, ["collection_id"], how="left", spread=["token_id"])
        return joined.filter(F.col("dense").isNull() | _number().isNull()).select(*TOKEN_KEYS)

    others = audit_tokens(rest(base), rest(rarity), None if metadata is None else rest(metadata))
    return counted.unionByName(others).groupBy("collection_id").agg(*[F.sum(name).alias(name) for name in measures])
