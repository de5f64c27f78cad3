"""Joins of many rows to a relation with one row per key, safe against hot keys.

The small-looking side is measured before a plan is chosen:

* within ``BROADCAST_BYTES``, estimated from the rows and not from compressed files, it is
  broadcast and the many rows are not shuffled at all;
* beyond that, keys that carry a large share of the rows are split off and, measured again, broadcast -
  there are at most ``1 / HOT_SHARE`` of them - and the rest is shuffled, where by
  construction no key is hot;
* where the rows per key are not known, the key is salted instead.

A side measured as too large is also kept from being broadcast on the strength of its file
size, hence the merge hints.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 128 << 20
# A key is hot from this share of the rows on; by arithmetic there are at most 1/share.
HOT_SHARE = 1 / 1024
SALTS = 32
# Up to this many key values are turned into a filter, which prunes partitions and files.
FILTER_VALUES = 1000

_ROW_OVERHEAD = 48
_SALT = "__salt"
_HOT = "__hot"


@dataclass(frozen=True)
class Size:
    """Measured size of a keyed relation and of the rows that will look it up."""

    rows: int
    bytes: int
    weight: int = 0
    largest: int = 0

    @property
    def broadcastable(self) -> bool:
        return self.bytes <= BROADCAST_BYTES

    @property
    def hot_from(self) -> int:
        return max(1, int(self.weight * HOT_SHARE))

    @property
    def has_hot_keys(self) -> bool:
        return self.largest >= self.hot_from


def row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of a row: the text and binary columns plus a fixed overhead."""
    text = [
        F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        for name, kind in df.dtypes
        if kind in ("string", "binary")
    ]
    fixed = _ROW_OVERHEAD + 8 * (len(df.columns) - len(text))
    return sum(text, F.lit(fixed)).cast("long")


def measure(df: DataFrame, weight: str | None = None) -> Size:
    """Rows and bytes of ``df``; with ``weight``, the rows each key stands for as well.

    One aggregate comes back to the driver, never the rows.
    """
    carried = F.col(weight) if weight else F.lit(1)
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b"),
        F.coalesce(F.sum(carried), F.lit(0)).alias("w"),
        F.coalesce(F.max(carried), F.lit(0)).alias("m"),
    ).first()
    return Size(row["n"], row["b"], row["w"], row["m"])


def split_hot_join(
    rows: DataFrame, keyed: DataFrame, keys: Sequence[str], weight: str, hot_from: int, spread: Sequence[str] = ()
) -> DataFrame:
    """Inner join in two parts: hot keys by broadcast, all others by shuffle.

    ``weight`` counts the rows per key, so at most ``total / hot_from`` keys are hot. Their rows
    are measured; beyond ``BROADCAST_BYTES`` only hashes of the keys are broadcast, which tell the
    two parts apart on both sides, and the hot part is salted by ``spread``.
    """
    hot = keyed.filter(F.col(weight) >= hot_from)
    if measure(hot).broadcastable:
        cold = keyed.filter(F.col(weight) < hot_from)
        hot_keys = F.broadcast(hot.select(*keys))
        return rows.join(F.broadcast(hot), list(keys)).unionByName(
            rows.join(hot_keys, list(keys), "left_anti").join(cold.hint("merge"), list(keys))
        )
    name = F.xxhash64(*[F.col(k) for k in keys])
    names = F.broadcast(hot.select(name.alias(_HOT)).distinct())

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.withColumn(_HOT, name).join(names, _HOT, how).drop(_HOT)

    return salted_join(part(rows, "left_semi"), part(keyed, "left_semi"), keys, spread or rows.columns).unionByName(
        part(rows, "left_anti").join(part(keyed, "left_anti").hint("merge"), list(keys))
    )


def salted_join(
    rows: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join on the keys and a salt taken from ``spread``; ``keyed`` is repeated per salt.

    The salt is a hash of row content, so a task that is run again salts the same way.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts)).cast("int")
    repeated = keyed.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn(_SALT, salt).join(repeated.hint("merge"), [*keys, _SALT], how).drop(_SALT)


def lookup_join(
    rows: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    *,
    spread: Sequence[str] = (),
    weight: str | None = None,
    how: str = "inner",
    size: Size | None = None,
) -> DataFrame:
    """Join ``rows`` to ``keyed``, which holds one row per key, by its measured size.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. ``weight`` names a
    column of ``keyed`` with the number of ``rows`` per key; ``spread`` names columns of
    ``rows`` that differ within a hot key and serve as the salt where no weight is known.
    The columns of ``rows`` keep their order, those of ``keyed`` follow.
    """
    size = size or measure(keyed, weight)
    if size.broadcastable:
        joined = rows.join(F.broadcast(keyed), list(keys), how)
    elif weight and how == "inner" and size.has_hot_keys:
        joined = split_hot_join(rows, keyed, keys, weight, size.hot_from, spread)
    elif spread and not weight:
        joined = salted_join(rows, keyed, keys, spread, how)
    else:
        joined = rows.join(keyed.hint("merge"), list(keys), how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in keyed.columns if c not in keys]
    return joined.select(*rows.columns, *added)


def restrict(rows: DataFrame, keyed: DataFrame, key: str, spread: Sequence[str] = ()) -> DataFrame:
    """``rows`` whose ``key`` occurs in ``keyed``, reading no more partitions than needed.

    A few values become a filter, which a table partitioned by ``key`` prunes with. No more
    than ``FILTER_VALUES`` of them are fetched; beyond that a semi join does it.
    """
    wanted = keyed.select(key).distinct()
    values = [row[0] for row in wanted.limit(FILTER_VALUES + 1).collect()]
    if len(values) <= FILTER_VALUES:
        return rows.filter(F.col(key).isin(values))
    return lookup_join(rows, wanted, [key], how="left_semi", spread=spread)
