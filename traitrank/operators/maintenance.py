"""Ranks kept up to date by signed changes, without scoring whole collections again.

A change adds (+1) or withdraws (-1) trait rows and listings. It moves the frequencies of its trait
values and the totals of their types, so only values of these types can get another score. What a
token's score changes by is the sum of the moves of its own trait values, plus what the changed rows
bring or take at the new scores. So trait rows are read, not shuffled by token, unless their value
moved; only collections that the change touches are read or written, and only they are ranked anew.

    traits     (collection, token, type, value, n)      n rows alike
    frequency  (collection, type, value, trait_count)
    tokens     (collection, token, score, unknown, n_traits, n_listed)
    rarity     (collection, token, rarity_score, rank)

Every number of a token is a sum, so changes add up in any order. ``unknown`` counts trait rows
whose value score does not fit INT; such a collection has no ranks, as in a full computation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitrank import schemas
from traitrank.operators.joins import lookup_join, measure, restrict
from traitrank.operators.rarity import COLLECTION, TOKEN, TYPE, VALUE, rank_tokens, trait_scores, usable_traits
from traitrank.operators.upsert import create_table, replace_groups
from traitrank.sources.staging import Staging
from traitrank.sources.tables import fresh_table

SIGN = "sign"
_VALUE_KEYS = [COLLECTION, TYPE, VALUE]
_TYPE_KEYS = [COLLECTION, TYPE]
_TOKEN_KEYS = [COLLECTION, TOKEN]
_TOKEN_SUMS = ["score", "unknown", "n_traits", "n_listed"]
_INT = (1 << 31) - 1


def _schema(texts: list[str], longs: list[str]) -> T.StructType:
    fields = [T.StructField(n, T.StringType()) for n in texts] + [T.StructField(n, T.LongType()) for n in longs]
    return T.StructType([*fields, T.StructField(COLLECTION, T.StringType())])


_TABLES = {
    "traits": _schema([TOKEN, TYPE, VALUE], ["n"]),
    "frequency": _schema([TYPE, VALUE], ["trait_count"]),
    "tokens": _schema([TOKEN], _TOKEN_SUMS),
    "rarity": schemas.RARITY,
}
_TRAIT_KEYS = [*_TOKEN_KEYS, TYPE, VALUE]


def _known(score: str) -> tuple[Column, Column]:
    """A value's score, 0 if it is unknown or the value is gone, and whether it is unknown."""
    gone = F.col(f"{score}_there").isNull()
    return F.coalesce(F.col(score), F.lit(0)).cast("long"), F.when(~gone & F.col(score).isNull(), 1).otherwise(0).cast("long")


def moved_values(old: DataFrame, change: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """The new frequencies of the types in ``change``, and every value of them whose score moves.

    ``old`` are the stored frequencies, ``change`` the signed sums per value. The second result has
    ``move`` and ``unknown_move``, the differences of score and of being unknown, and ``now`` and
    ``unknown_now``. Values that are new or gone count as 0 before or after.
    """
    types = staging.write(change.select(*_TYPE_KEYS).distinct(), "types")
    before = staging.write(lookup_join(old, types, _TYPE_KEYS, how="left_semi", spread=[VALUE]), "before")
    after = staging.write(
        before.unionByName(change).groupBy(*_VALUE_KEYS).agg(F.sum("trait_count").alias("trait_count")).filter("trait_count <> 0"),
        "after",
    )
    if not after.filter("trait_count < 0").isEmpty():
        raise ValueError("a change withdraws trait rows that are not there")

    def scored(frequency: DataFrame, name: str) -> DataFrame:
        scores = trait_scores(frequency)
        return scores.select(*_VALUE_KEYS, F.col("rarity_score").alias(name), F.lit(True).alias(f"{name}_there"))

    both = scored(before, "was").join(scored(after, "is"), _VALUE_KEYS, "full")
    (was, unknown_was), (now, unknown_now) = _known("was"), _known("is")
    moves = both.select(
        *_VALUE_KEYS, (now - was).alias("move"), (unknown_now - unknown_was).alias("unknown_move"),
        now.alias("now"), unknown_now.alias("unknown_now"),
    )
    return after, staging.write(moves, "moves")


@dataclass
class MaintainedRarity:
    """The four tables, ``prefix`` in front of their names."""

    spark: SparkSession
    prefix: str

    def name(self, kind: str) -> str:
        return f"{self.prefix}.maintained_{kind}"

    def table(self, kind: str) -> DataFrame:
        return fresh_table(self.spark, self.name(kind))

    def create_tables(self) -> None:
        for kind, schema in _TABLES.items():
            create_table(self.spark, self.name(kind), schema, COLLECTION)

    def apply(self, traits: DataFrame, base: DataFrame) -> None:
        """Add and withdraw trait rows (collection, token, type, value, sign) and listings
        (collection, token, sign), and rank the collections that they touch.

        Trait rows that lack token, type or value, and listings without a token, count for nothing. A
        change is not idempotent: apply each once. Withdrawing what is not there is an error, found
        before anything is written.
        """
        staging = Staging(self.spark)
        rows = staging.write(
            usable_traits(traits, SIGN).groupBy(*_TRAIT_KEYS).agg(F.sum(F.col(SIGN).cast("long")).alias("n")).filter("n <> 0"),
            "change",
        )
        listed = staging.write(
            base.filter(F.col(TOKEN).isNotNull()).groupBy(*_TOKEN_KEYS).agg(F.sum(F.col(SIGN).cast("long")).alias("n_listed")), "listed"
        )
        touched = staging.write(rows.select(COLLECTION).unionByName(listed.select(COLLECTION)).distinct(), "touched")
        if touched.isEmpty():
            return
        stored = {k: restrict(self.table(k), touched, COLLECTION, [s]) for k, s in (("traits", TOKEN), ("frequency", VALUE), ("tokens", TOKEN))}

        change = rows.groupBy(*_VALUE_KEYS).agg(F.sum("n").alias("trait_count"))
        after, moves = moved_values(stored["frequency"].select(*_VALUE_KEYS, "trait_count"), change, staging)
        moving = moves.filter("move <> 0 OR unknown_move <> 0")
        size, all_moves = measure(moving), measure(moves)
        kept = lookup_join(stored["traits"], moving.select(*_VALUE_KEYS, "move", "unknown_move"), _VALUE_KEYS, spread=[TOKEN], size=size)
        brought = lookup_join(rows, moves.select(*_VALUE_KEYS, "now", "unknown_now"), _VALUE_KEYS, spread=[TOKEN], size=all_moves)
        none = F.lit(0).cast("long")

        def sums(df: DataFrame, score: Column, unknown: Column, n_traits: Column, n_listed: Column) -> DataFrame:
            return df.select(*_TOKEN_KEYS, *[c.alias(n) for n, c in zip(_TOKEN_SUMS, (score, unknown, n_traits, n_listed))])

        n = F.col("n")
        parts = (
            sums(stored["tokens"], *[F.col(c) for c in _TOKEN_SUMS])
            .unionByName(sums(kept, n * F.col("move"), n * F.col("unknown_move"), none, none))
            .unionByName(sums(brought, n * F.col("now"), n * F.col("unknown_now"), n, none))
            .unionByName(sums(listed, none, none, none, F.col("n_listed")))
        )
        tokens = staging.write(
            parts.groupBy(*_TOKEN_KEYS).agg(*[F.sum(c).alias(c) for c in _TOKEN_SUMS]).filter("n_traits <> 0 OR n_listed <> 0"), "tokens"
        )
        if not tokens.filter("n_traits < 0 OR n_listed < 0").isEmpty():
            raise ValueError("a change withdraws tokens that are not there")
        trait_rows = (
            stored["traits"].select(*_TRAIT_KEYS, "n").unionByName(rows).groupBy(*_TRAIT_KEYS).agg(F.sum("n").alias("n")).filter("n <> 0")
        )
        types = after.select(*_TYPE_KEYS).unionByName(change.select(*_TYPE_KEYS)).distinct()
        others = lookup_join(stored["frequency"].select(*_VALUE_KEYS, "trait_count"), types, _TYPE_KEYS, how="left_anti", spread=[VALUE])
        results = {"traits": trait_rows, "frequency": others.unionByName(after), "tokens": tokens, "rarity": self._ranked(tokens, staging)}
        staged = {kind: staging.write(df, kind) for kind, df in results.items()}
        for kind, df in staged.items():
            self._replace(kind, df, touched)

    def _ranked(self, tokens: DataFrame, staging: Staging) -> DataFrame:
        listed = tokens.filter("n_listed > 0")
        beyond = (F.col("unknown") > 0) | (F.abs("score") > _INT)
        overflowing = listed.filter(beyond).select(COLLECTION).distinct()
        sound = lookup_join(listed, overflowing, [COLLECTION], how="left_anti", spread=[TOKEN])
        return rank_tokens(sound.select(*_TOKEN_KEYS, F.col("score").cast("int").alias("rarity_score")), staging=staging)

    def _replace(self, kind: str, rows: DataFrame, touched: DataFrame) -> None:
        """The touched collections hold ``rows`` from now on; one that has none left loses its partition."""
        table = self.name(kind)
        replace_groups(rows, table, COLLECTION)
        gone = touched.join(rows.select(COLLECTION).distinct(), COLLECTION, "left_anti")
        for row in gone.toLocalIterator():
            value = row[0].replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({COLLECTION} = '{value}')")
