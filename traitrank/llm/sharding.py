"""Shards of near equal bytes by sampled splitters.

Records lie on a line in order of a hash of their text, then of their id, so equal texts lie next
to each other. Keys drawn in proportion to size give splitters, which cut the line into ranges;
ranges that prove overfull - a text with very many copies, say - are cut again, by keys drawn inside
them, now between ids as well. Each range then adds up its own records, and the sums of the ranges
before it place every record on the line exactly, so that shards end where their share of bytes
does and not where a sample guessed.

A record above 1/``FINE`` of a shard would overhang its end. There are at most ``FINE`` times as
many of these as shards; they are dealt out first, the largest to the emptiest shard, and the line
fills up what is left.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitrank.sources.staging import Staging

SHARDS = 40
# Ranges per shard that the splitters aim at, and the part of a shard that counts as large.
FINE = 64
# Keys drawn per range.
DRAWS = 4
# A range above so many times its due is cut again, in so many rounds at most.
OVERFULL = 2
ROUNDS = 4
# What a record takes besides its text.
OVERHEAD = 16
_LEAST = -(1 << 63)
_OURS = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _longs(values: list[int]) -> Column:
    """A list as one literal."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _count_below(keys: list[tuple], *columns: str) -> Column:
    """How many of the ascending ``keys`` are at or below the row's, by bisection."""
    lists = [_longs([k[i] for k in keys]) for i in range(len(columns))]
    steps = []
    step = 1 << max(0, len(keys).bit_length() - 1)
    while step and keys:
        steps.append(step)
        step //= 2

    def forward(at: Column, step: Column) -> Column:
        probe = F.least(at + step, F.lit(len(keys))).cast("int")
        here = F.struct(*[F.element_at(values, probe).alias(c) for values, c in zip(lists, columns)])
        return F.when((at + step <= len(keys)) & (here <= F.struct(*columns)), at + step).otherwise(at)

    if not keys:
        return F.lit(0)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), forward)


def _draw(rows: DataFrame, bytes_a_key: float, salt: int) -> DataFrame:
    """Rows with ``draws`` > 0: how often keys drawn at one per so many bytes hit them.

    The chance comes from a hash of the key, so a repeated task draws the same rows.
    """
    chance = F.shiftrightunsigned(F.xxhash64("__hash", "__id", F.lit(salt)), 11) / F.lit(float(1 << 53))
    draws = F.floor(F.col("__size") / F.lit(float(bytes_a_key)) + chance)
    return rows.withColumn("draws", draws.cast("long")).filter("draws > 0")


def _quantiles(sample: list[tuple], every: int) -> list[tuple]:
    """Each ``every``-th drawn key of ascending (key, draws)."""
    out, seen = [], 0
    for key, draws in sample:
        if (seen + draws) // every > seen // every and (not out or out[-1] < key):
            out.append(key)
        seen += draws
    return out


def _splitters(light: DataFrame, total: int, ranges: int) -> list[tuple]:
    """Ascending (hash, id) at which ranges begin; at most a few times ``ranges`` of them.

    The first draw cuts between hashes only. What is overfull then is cut between ids.
    """
    due = total / ranges
    drawn = _draw(light, due / DRAWS, 0).groupBy("__hash").agg(F.sum("draws").alias("draws"))
    keys = _quantiles(sorted(((r["__hash"], _LEAST), r["draws"]) for r in drawn.collect()), DRAWS)
    for salt in range(1, ROUNDS):
        placed = light.withColumn("__range", _count_below(keys, "__hash", "__id"))
        full = placed.groupBy("__range").agg(F.sum("__size").alias("b"), F.max(F.struct("__hash", "__id")).alias("top"),
            F.min(F.struct("__hash", "__id")).alias("low")).filter((F.col("b") > OVERFULL * due) & (F.col("low") < F.col("top")))
        overfull = [r["__range"] for r in full.select("__range").collect()]
        if not overfull:
            break
        inside = placed.filter(F.array_contains(_longs(overfull), F.col("__range").cast("long")))
        more = _draw(inside, due / DRAWS, salt).groupBy("__range", "__hash", "__id").agg(F.sum("draws").alias("draws"))
        by_range: dict[int, list] = {}
        for r in more.collect():
            by_range.setdefault(r["__range"], []).append(((r["__hash"], r["__id"]), r["draws"]))
        keys = sorted({*keys, *(k for sample in by_range.values() for k in _quantiles(sorted(sample), DRAWS))})
    return keys


def _deal(sizes: list[int], shards: int) -> list[int]:
    """Shard of each of descending ``sizes``: the emptiest so far, ties by number."""
    loads = [(0, s) for s in range(shards)]
    out = []
    for size in sizes:
        load, s = heapq.heappop(loads)
        out.append(s)
        heapq.heappush(loads, (load + size, s))
    return out


def _shares(loads: list[int], total: int) -> list[float]:
    """What each shard still takes of ``total`` so that all are filled to one level, as far as can be."""
    ordered = sorted(loads)
    level, left = 0.0, float(total)
    for n, load in enumerate(ordered, 1):
        above = ordered[n] if n < len(ordered) else float("inf")
        level = load + left / n
        if level <= above:
            break
        left -= n * (above - load)
    return [max(0.0, level - load) for load in loads]


def shard_by_bytes(
    records: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard[, keep]): a row per row of ``records``.

    ``size`` is the text's UTF-8 bytes plus ``OVERHEAD``; a null text is as the empty one. Shards
    differ by about 1/``FINE`` of a shard, or by the largest record if one exceeds a shard. Equal
    texts share a shard while together they are below that part. ``slot`` counts a shard's rows
    from 0. ``key`` is a whole number; null comes first, and rows that agree in id and text follow
    each other. With few records some shards stay empty; an empty table gives an empty result.
    Columns to ``keep`` must not bear a name of the result. Of ``records`` only sums and at most
    some thousand drawn or large keys reach the driver, whatever their number.
    """
    if clash := set(keep) & set(_OURS):
        raise ValueError(f"columns to keep bear names of the result: {sorted(clash)}")
    staging = Staging.of(records)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # Names of ours cannot clash with those to keep, which travel in one struct.
    rows = staging.write(
        records.select(
            F.col(key).cast("long").alias("__key"),
            F.coalesce(F.col(key).cast("long"), F.lit(_LEAST)).alias("__id"),
            (F.octet_length(body) + OVERHEAD).cast("long").alias("__size"),
            F.crc32(body.cast("binary")).alias("__crc"),
            F.xxhash64(body).alias("__hash"),
            F.struct(F.lit(0).alias("__none"), *[F.col(c) for c in keep]).alias("__kept"),
        ),
        "records",
    )
    total = rows.agg(F.sum("__size")).first()[0] or 0
    ranges = shards * FINE
    large = F.col("__size") > total / ranges
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("__size"), "__hash", "__id")
    # Fewer than ``ranges`` rows can be above that size.
    heavy = staging.write(rows.filter(large).withColumn("__nth", F.row_number().over(order) - 1), "large")
    sizes = [r["__size"] for r in heavy.select("__nth", "__size").orderBy("__nth").collect()]
    homes = _deal(sizes, shards)
    loads, heads, places = [0] * shards, [0] * shards, []
    for size, home in zip(sizes, homes):
        places.append(heads[home])
        heads[home] += 1
        loads[home] += size

    light = rows.filter(~large)
    left = total - sum(sizes)
    line = None
    if left:
        keys = _splitters(light, left, ranges)
        placed = light.withColumn("__range", _count_below(keys, "__hash", "__id"))
        n, b = [0] * (len(keys) + 1), [0] * (len(keys) + 1)
        for r in placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("b")).collect():
            n[r["__range"]], b[r["__range"]] = r["n"], r["b"]
        first_row, first_byte = [0], [0]
        for rows_in, bytes_in in zip(n, b):
            first_row.append(first_row[-1] + rows_in)
            first_byte.append(first_byte[-1] + bytes_in)
        ends, filled = [], 0.0
        for share in _shares(loads, left)[:-1]:
            filled += share
            ends.append((round(2 * filled),))

        in_range = Window.partitionBy("__range").orderBy("__hash", "__id", "__size")
        alike = Window.partitionBy("__range", "__hash")
        at = F.element_at(_longs(first_byte), (F.col("__range") + 1).cast("int"))
        before = F.sum("__size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
        line = (
            placed.withColumn("__before", at + before)
            .withColumn("__row", F.element_at(_longs(first_row), (F.col("__range") + 1).cast("int")) + F.row_number().over(in_range) - 1)
            .withColumn("__start", F.min("__before").over(alike))
            .withColumn("__weight", F.sum("__size").over(alike))
        )
        # Twice the middle of the record, or of its equal texts where they are few enough to stay together.
        middle = F.when(
            F.col("__weight") <= F.lit(total / ranges), 2 * F.col("__start") + F.col("__weight")
        ).otherwise(2 * F.col("__before") + F.col("__size"))
        line = staging.write(
            line.withColumn("__middle", middle).withColumn("__shard", _count_below(ends, "__middle").cast("int"))
            .select("__key", "__size", "__crc", "__kept", "__shard", "__row"),
            "line",
        )
        starts = [0] * shards
        for r in line.groupBy("__shard").agg(F.min("__row").alias("r"), F.count(F.lit(1)).alias("n")).collect():
            starts[r["__shard"]] = r["r"]
            for nth, home in enumerate(homes):
                places[nth] += r["n"] if home == r["__shard"] else 0
        line = line.withColumn("__slot", F.col("__row") - F.element_at(_longs(starts), F.col("__shard") + 1)).drop("__row")

    nth = (F.col("__nth") + 1).cast("int")
    dealt = heavy.select(
        "__key", "__size", "__crc", "__kept",
        F.element_at(_longs(homes), nth).cast("int").alias("__shard"), F.element_at(_longs(places), nth).alias("__slot"),
    )
    everything = dealt if line is None else line.unionByName(dealt)
    return everything.select(
        F.col("__key").alias("doc_id"), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *[F.col(f"__kept.{c}").alias(c) for c in keep],
    )


def write_shards(records: DataFrame, folder: str, **options) -> DataFrame:
    """Writes ``records`` as Parquet under ``folder/shard=N``, rows in order of their slot, and hands
    back what was written; ``options`` as for ``shard_by_bytes``."""
    dealt = shard_by_bytes(records, **options)
    per_shard = records.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt.repartitionByRange(int(per_shard), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return records.sparkSession.read.schema(dealt.schema).parquet(folder)
