"""Hard negatives from Hilbert-ordered blocks with zone maps.

All vectors are ordered by label and, within it, along a Hilbert curve through their components,
and written as Parquet, a block of at most ``BLOCK`` neighbouring vectors per row, with the least
and greatest value of every component (its zone map). Interval arithmetic on a zone map bounds the
inner products of an anchor with a whole block from both sides, so an anchor reads only blocks that
may hold scores inside one of its windows and above what it has already found there.

A search first lets every anchor read the most promising block of each group of zone maps. The k-th
best score found in a window then raises the window's lower end, and all blocks that still reach
into it are read. Anchors are packed like blocks, so whatever label or anchor is frequent, a task
meets pairs of packs of bounded size; of a pair only the first k per anchor and window go on.

Two searches are made: first for the positives, among the anchor's label, then for negatives, among
the others, in windows that the positives' scores set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitrank.llm.common import shuffle_partitions
from traitrank.llm.vectors import packed, whole_numbers
from traitrank.sources.staging import Staging

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# Tenths of a positive's score between which its negatives lie.
LOW, HIGH = 3, 9
# Vectors in a block, anchors in a pack, zone maps in a group.
BLOCK = 256
PACK = 256
ZONES = 256
# Bits per component of the place on the curve.
BITS = 4
_FAR = 1 << 62
# Whole numbers up to here are exact in double precision.
_EXACT = 1 << 53


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of ``cells`` (whole numbers below 2**bits) on the Hilbert curve.

    Bit by bit from the top, the axes are turned so that the curve's piece in the sub-cube has its
    standard form; what is left is the Gray code of the place.
    """
    axes = cells.T.astype(np.uint8)
    for level in reversed(range(1, bits)):
        top, below = np.uint8(1 << level), np.uint8((1 << level) - 1)
        for axis in axes:
            flip = (axis & top) != 0
            swap = np.where(flip, 0, (axes[0] ^ axis) & below).astype(np.uint8)
            axes[0] ^= np.where(flip, below, 0).astype(np.uint8) ^ swap
            axis ^= swap
    np.bitwise_xor.accumulate(axes, axis=0, out=axes)
    odd = np.zeros(axes.shape[1], np.uint8)
    for level in reversed(range(1, bits)):
        odd ^= np.where(axes[-1] & np.uint8(1 << level), np.uint8((1 << level) - 1), 0).astype(np.uint8)
    axes ^= odd
    levels = np.arange(bits - 1, -1, -1, dtype=np.uint8)
    spread = (axes.T[:, None, :] >> levels[None, :, None]) & 1
    return [row.tobytes() for row in np.packbits(spread.reshape(len(cells), -1), axis=1)]


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``left`` with all rows of ``right``."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    kind = np.float64 if most < _EXACT else np.int64
    return (left.astype(kind) @ right.T.astype(kind)).astype(np.int64)


def bounds(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any vector inside each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _products(up, lows) + _products(down, highs), _products(up, highs) + _products(down, lows)


def _keyed(shape: dict[str, list]):
    """Adds the place on the curve; cells span two standard deviations to either side of the mean."""
    low = np.array(shape["mean"]) - 2 * np.array(shape["spread"])
    width = np.maximum(4 * np.array(shape["spread"]), 1e-9)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = packed(batch["ints"])
                cells = np.clip(np.floor((rows - low) / width * (1 << BITS)), 0, (1 << BITS) - 1).astype(np.uint8)
                yield pd.DataFrame({
                    "vec_id": batch["vec_id"], "label": batch["label"], "place": hilbert_keys(cells, BITS),
                    "vector": [r.tobytes() for r in rows],
                })

    return keyed


def _blocks(size: int):
    """Rows in order, cut into blocks of one label, with their zone maps."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for label, rows in batch.groupby("label", sort=False):
                for start in range(0, len(rows), size):
                    part = rows.iloc[start : start + size].sort_values("vec_id")
                    vectors = packed(part["vector"])
                    yield pd.DataFrame({
                        "block": [number], "label": [label], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                        "vectors": [vectors.tobytes()],
                        "lows": [vectors.min(axis=0).tobytes()], "highs": [vectors.max(axis=0).tobytes()],
                    })
                    number += 1

    return blocks


_BLOCK = "block long, label int, ids binary, vectors binary, lows binary, highs binary"


def _packs(width: int, size: int):
    """Anchors in order, packed; windows that an anchor does not have are empty ones."""

    def packs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, len(batch), size):
                part = batch.iloc[start : start + size]
                windows = np.tile(np.array([1, 0], np.int64), (len(part), width, 1))
                for i, (lows, highs) in enumerate(zip(part["lows"], part["highs"])):
                    windows[i, : len(lows), 0], windows[i, : len(highs), 1] = lows, highs
                yield pd.DataFrame({
                    "pack": [number], "anchors": [part["anchor_id"].to_numpy(np.int64).tobytes()],
                    "labels": [part["label"].to_numpy(np.int32).tobytes()],
                    "asked": [b"".join(part["vector"])], "windows": [windows.tobytes()],
                })
                number += 1

    return packs


_PACK = "pack long, anchors binary, labels binary, asked binary, windows binary"


def _opened(row, width: int) -> tuple[np.ndarray, ...]:
    anchors = np.frombuffer(row.anchors, np.int64)
    return (
        anchors, np.frombuffer(row.labels, np.int32), np.frombuffer(row.asked, np.int32).reshape(len(anchors), -1),
        np.frombuffer(row.windows, np.int64).reshape(len(anchors), width, 2),
    )


def _choose(width: int, same: bool, best_only: bool):
    """The blocks of a group of zone maps that anchors of a pack must read, a bit per anchor."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                _, labels, asked, windows = _opened(row, width)
                zones = row.zones
                theirs = np.array([z["label"] for z in zones], np.int32)
                least, most = bounds(
                    asked, packed(pd.Series([z["lows"] for z in zones])), packed(pd.Series([z["highs"] for z in zones]))
                )
                wanted = np.zeros(least.shape, bool)
                for w in range(width):
                    wanted |= (most >= windows[:, w, 0, None]) & (least <= windows[:, w, 1, None]) & (
                        windows[:, w, 0] <= windows[:, w, 1]
                    )[:, None]
                wanted &= (labels[:, None] == theirs) == same
                if best_only:
                    best = np.where(wanted, most, -_FAR).argmax(axis=1)
                    wanted &= np.arange(len(theirs)) == best[:, None]
                read = np.flatnonzero(wanted.any(axis=0))
                yield pd.DataFrame({
                    "pack": np.full(len(read), row.pack, np.int64),
                    "block": np.array([zones[z]["block"] for z in read], np.int64),
                    "which": [np.packbits(wanted[:, z]).tobytes() for z in read],
                    "n_which": wanted.sum(axis=0)[read].astype(np.int32),
                })

    return choose


_CHOSEN = "pack long, block long, which binary, n_which int"
_FOUND = "anchor_id long, window int, found_id long, score long"


def _first(found: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The first k rows per anchor and window."""
    rows = pd.concat(found)
    rows = rows.iloc[np.lexsort((rows["found_id"], -rows["score"], rows["window"], rows["anchor_id"]))]
    return rows[rows.groupby(["anchor_id", "window"]).cumcount() < k]


def _read(width: int, k: int):
    """The first k of a batch of blocks in every window of the anchors that read them."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.itertuples():
                anchors, _, asked, windows = _opened(row, width)
                which = np.flatnonzero(np.unpackbits(np.frombuffer(row.which, np.uint8), count=len(anchors)))
                ids = np.frombuffer(row.ids, np.int64)
                vectors = np.frombuffer(row.vectors, np.int32).reshape(len(ids), -1)
                scores = _products(asked[which], vectors)
                scores[anchors[which][:, None] == ids] = -_FAR - 1  # itself, outside of any window
                # Ids ascend within a block, so a stable order puts ties by id.
                order = np.argsort(-scores, axis=1, kind="stable")
                scores = np.take_along_axis(scores, order, axis=1)
                for w in range(width):
                    low, high = windows[which, w, 0], windows[which, w, 1]
                    at = (scores > high[:, None]).sum(axis=1)[:, None] + np.arange(k)
                    there = np.minimum(at, len(ids) - 1)
                    got = np.take_along_axis(scores, there, axis=1)
                    i, j = np.nonzero((at < len(ids)) & (got >= low[:, None]))
                    if len(i):
                        found.append(pd.DataFrame({
                            "anchor_id": anchors[which][i], "window": np.full(len(i), w, np.int32),
                            "found_id": ids[order[i, there[i, j]]], "score": got[i, j],
                        }))
                if len(found) > 64 * width:
                    found = [_first(found, k)]
            if found:
                yield _first(found, k)

    return read


def _search(
    asking: DataFrame, blocks: DataFrame, zones: DataFrame, groups: int, *, width: int, k: int, same: bool, pack: int, staging: Staging
) -> DataFrame:
    """(anchor_id, window, found_id, score, rank): the first ``k`` of every window of ``asking``
    (anchor_id, label, place, vector, lows, highs) among the blocks of the same or of other labels."""
    tasks = shuffle_partitions(asking.sparkSession)

    def once(asking: DataFrame, best_only: bool) -> DataFrame:
        packs = staging.write(
            asking.repartitionByRange(tasks, "place", "anchor_id").sortWithinPartitions("place", "anchor_id")
            .select("anchor_id", "label", "vector", "lows", "highs").mapInPandas(_packs(width, pack), _PACK),
            "packs",
        )
        meets = packs.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(zones, "group")
        chosen = staging.write(
            meets.repartition(tasks, "pack", "group").mapInPandas(_choose(width, same, best_only), _CHOSEN), "chosen"
        )
        pairs = chosen.join(blocks.select("block", "ids", "vectors"), "block").join(packs, "pack")
        found = pairs.select("which", "ids", "vectors", "anchors", "labels", "asked", "windows").mapInPandas(_read(width, k), _FOUND)
        order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "found_id")
        return staging.write(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "found")

    first = once(asking, True)
    raised = (
        first.filter(F.col("rank") == k).groupBy("anchor_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("raised"))
    )
    lows = F.transform("lows", lambda low, w: F.greatest(low, F.coalesce(F.try_element_at("raised", w), low)))
    return once(asking.join(raised, "anchor_id", "left").withColumn("lows", lows).drop("raised"), False)


def _tenths(score: str, tenths: int, up: bool) -> Column:
    """Whole number at or above (``up``) or at or below so many tenths of the score."""
    part = F.col(score) * tenths
    floor = part - F.pmod(part, F.lit(10))
    whole = F.expr(f"({score} * {tenths} - pmod({score} * {tenths}, 10)) div 10")
    return F.when(floor < part, whole + 1).otherwise(whole) if up else whole


def candidate_blocks(vectors: DataFrame, staging: Staging, *, key: str, vector: str, label: str, size: int) -> tuple[DataFrame, DataFrame]:
    """The vectors that take part, in order of the curve's place, and the written blocks of them."""
    given = vectors.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("int").alias("given"), F.col(vector).alias("embedding")
    ).filter("vec_id IS NOT NULL AND given IS NOT NULL")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("given") + 1) % 10).otherwise(F.col("given"))
    once = (
        whole_numbers(given, "embedding", SCALE).groupBy("vec_id").agg(F.min(F.struct(moved.alias("label"), "ints")).alias("row"))
        .select("vec_id", "row.label", "row.ints")
    )
    whole = staging.write(once, "vectors")
    dims = whole.agg(F.max(F.size("ints"))).first()[0]
    if not dims:
        return whole.select("vec_id", "label", F.lit(b"").alias("place"), F.lit(b"").alias("vector")).filter("false"), None
    padded = whole.withColumn("ints", F.concat("ints", F.array_repeat(F.lit(0), F.lit(dims) - F.size("ints"))))
    per_dim = padded.select(F.posexplode("ints")).groupBy("pos").agg(F.avg("col").alias("mean"), F.stddev_pop("col").alias("spread"))
    shape = per_dim.orderBy("pos").toPandas()
    tasks = shuffle_partitions(vectors.sparkSession)
    keyed = staging.write(
        padded.mapInPandas(_keyed(shape.to_dict("list")), "vec_id long, label int, place binary, vector binary"), "keyed"
    )
    order = ["label", "place", "vec_id"]
    blocks = staging.write(
        keyed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInPandas(_blocks(size), _BLOCK), "blocks"
    )
    return keyed, blocks


def hard_negatives(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 100,
    block: int = BLOCK,
    pack: int = PACK,
    zones_a_group: int = ZONES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows without id, label or vector, or with a null or non-finite component, take no part, nor do
    components of 2**27 / ``SCALE`` or more, whose products would not fit 63 bits. Of rows that
    repeat an id the smallest by label, then vector, counts. Shorter vectors go on with zeros. Anchors are the ids divisible by
    ``every``. A positive without negatives gives no row, so an empty table gives none. Ties go by
    smaller id. Further columns are not looked at.
    """
    staging = Staging.of(vectors)
    rows, blocks = candidate_blocks(vectors, staging, key=key, vector=vector, label=label, size=block)
    anchors = rows.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "anchor_id")
    if blocks is None:
        none = F.lit(None).cast("long")
        return anchors.select(
            "anchor_id", none.alias("positive_id"), F.lit(0).alias("rank"), none.alias("negative_id"),
            none.alias("positive_score"), none.alias("negative_score"),
        )
    groups = -(-blocks.count() // zones_a_group)
    zones = staging.write(
        blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"))
        .agg(F.collect_list(F.struct("block", "label", "lows", "highs")).alias("zones")),
        "zones",
    )
    anywhere = anchors.withColumn("lows", F.array(F.lit(-_FAR))).withColumn("highs", F.array(F.lit(_FAR)))
    positives = _search(anywhere, blocks, zones, groups, width=1, k=POSITIVES, same=True, pack=pack, staging=staging).select(
        "anchor_id", (F.col("rank") - 1).alias("window"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    windows = positives.groupBy("anchor_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct("window", _tenths("positive_score", LOW, True).alias("low"), _tenths("positive_score", HIGH, False).alias("high"))
            )
        ).alias("windows")
    )
    asking = anchors.join(windows, "anchor_id").select(
        "anchor_id", "label", "place", "vector", F.col("windows.low").alias("lows"), F.col("windows.high").alias("highs")
    )
    negatives = _search(asking, blocks, zones, groups, width=POSITIVES, k=NEGATIVES, same=False, pack=pack, staging=staging)
    return negatives.join(positives, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


ORACLE = f"""
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {10 * LOW} * positive_score <= 100 * score AND 100 * score <= {10 * HIGH} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= {NEGATIVES}
"""
