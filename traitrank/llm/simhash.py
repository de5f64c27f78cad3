"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints within ``distance`` bits agree on at least one of ``distance + 1`` bands, so
each distinct fingerprint is stored once per band, rotated so that the band leads. Every copy
of the table is sorted by Gray rank: neighbours in that order differ in few bits and share the
leading band. Runs of one band are cut into leaves, and the bits that all codes of a leaf share
form the leaf's masked pattern. Whole leaves, then groups within leaves, are discarded as soon
as the differences summed over the shared patterns exceed the distance; only what is left is
compared code by code.

A leaf holds at most ``LEAF`` codes. A band value that many codes have just fills more leaves,
whose pairs are separate rows for separate tasks. A pair of leaves gives a spanning forest of
its links, never the links of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank.llm.common import shuffle_partitions, without
from traitrank.llm.components import components, spanning_forest
from traitrank.sources.staging import Staging

SHINGLE = 3
DISTANCE = 3
LEAF = 1024
_FAN_OUT = (64, 8)
_HASHED_AT_ONCE = 1 << 16


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """64 bits; bit j is set if it is set in over half of the hashes of all word shingles.

    Words are separated by space and the control characters 9 to 13; only A-Z are folded.
    bytes.lower and bytes.split do exactly this. Fewer words than ``shingle`` form one
    shingle, no word gives 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return _majority([xxhash.xxh64_intdigest(b" ".join(words), seed)])
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return _majority(
        [digest(s, seed) for s in map(join, zip(*(words[i:] for i in range(shingle))))]
    )


def _majority(hashes: list[int]) -> int:
    h = np.array(hashes, dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(h), _HASHED_AT_ONCE):
        part = h[start : start + _HASHED_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """SimHash of a text column as LONG; null and empty texts give 0."""

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint_of(t.as_buffer().to_pybytes() if t.is_valid else None, shingle) for t in batch]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return simhash(text)


def _gray_rank(code: Column) -> Column:
    """Position of a code in the Gray sequence; its leading bits depend on the code's only."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _rotated(code: Column, bits: int) -> Column:
    if bits == 0:
        return code
    return F.shiftleft(code, bits).bitwiseOR(F.shiftrightunsigned(code, 64 - bits))


def _nodes(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits that all codes of a node share, and the node's bits, per ``size`` codes."""
    starts = np.arange(0, len(codes), size)
    low, high = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    return ~(low ^ high), low


def near_pairs(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with at most ``distance`` differing bits between a[i] and b[j].

    Both arrays are in Gray order. Pairs of upper nodes are dropped by the differences on the
    bits that both share; the sum is carried to their lower nodes, which add the differences
    on the bits that became shared there.
    """
    one = len(a) * len(b) <= 4096
    pairs_a = pairs_b = np.zeros(1, dtype=np.int64)
    above = known = None
    size_above = None
    for size in () if one else _FAN_OUT:
        (mask_a, low_a), (mask_b, low_b) = _nodes(a, size), _nodes(b, size)
        if size_above is None:
            pairs_a, pairs_b = (x.ravel() for x in np.indices((len(low_a), len(low_b))))
            above, known = np.zeros(len(pairs_a), dtype=np.int64), np.zeros(len(pairs_a), dtype=np.uint64)
        else:
            pairs_a, pairs_b, keep = _expand(pairs_a, pairs_b, size_above // size, len(low_a), len(low_b))
            above, known = above[keep], known[keep]
        shared = mask_a[pairs_a] & mask_b[pairs_b]
        above = above + np.bitwise_count((low_a[pairs_a] ^ low_b[pairs_b]) & shared & ~known)
        alive = above <= distance
        pairs_a, pairs_b, above, known = pairs_a[alive], pairs_b[alive], above[alive], shared[alive]
        size_above = size
    if one:
        i, j = (x.ravel() for x in np.indices((len(a), len(b))))
    else:
        i, j, _ = _expand(pairs_a, pairs_b, size_above, len(a), len(b))
    near = np.bitwise_count(a[i] ^ b[j]) <= distance
    return i[near], j[near]


def _expand(x: np.ndarray, y: np.ndarray, fan: int, nx: int, ny: int):
    """All child pairs of the node pairs, and the parent pair of each."""
    kids = np.arange(fan)
    i = np.broadcast_to((x * fan)[:, None, None] + kids[:, None], (len(x), fan, fan)).ravel()
    j = np.broadcast_to((y * fan)[:, None, None] + kids, (len(y), fan, fan)).ravel()
    parent = np.repeat(np.arange(len(x)), fan * fan)
    real = (i < nx) & (j < ny)
    return i[real], j[real], parent[real]


def _forest_edges(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    label = spanning_forest(len(nodes), i, j)
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[tied], nodes[label[tied]]


_LEAF_SCHEMA = "a long, b long, turn int, band long, leaf long, low long, high long, codes binary, nodes binary"
_LEAF_ARROW = pa.schema(
    [(c, pa.int32() if c == "turn" else pa.int64()) for c in ("a", "b", "turn", "band", "leaf", "low", "high")]
    + [("codes", pa.binary()), ("nodes", pa.binary())]
)


class _LeafCutter:
    """Cuts one partition of sorted codes into leaves of one band each.

    Gives the links inside each leaf. A leaf is itself given as well unless its band surely
    has no other one: it was cut for its size, or lies at the partition's start or end.
    """

    def __init__(self, distance: int, leaf_size: int, band_bits: int):
        self.distance, self.leaf_size, self.shift = distance, leaf_size, np.uint64(64 - band_bits)
        self.first_leaf, self.made = TaskContext.get().partitionId() << 32, 0
        self.rest = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.continued = True  # the first band may have begun in the partition before
        self.edges: list[tuple] = []
        self.rows: list[dict] = []

    def _leaf(self, turn: int, band: int, codes: np.ndarray, nodes: np.ndarray, alone: bool) -> None:
        if len(codes) > 1:
            a, b = _forest_edges(nodes, *near_pairs(codes, codes, self.distance))
            if len(a):
                self.edges.append((a, b))
        if not alone:
            low, high = np.bitwise_and.reduce(codes), np.bitwise_or.reduce(codes)
            self.rows.append({
                "a": None, "b": None, "turn": turn, "band": band, "leaf": self.first_leaf + self.made,
                "low": int(low.view(np.int64)), "high": int(high.view(np.int64)),
                "codes": codes.tobytes(), "nodes": nodes.tobytes(),
            })
            self.made += 1

    def add(self, turn: np.ndarray, code: np.ndarray, node: np.ndarray, final: bool) -> None:
        turn, code, node = (np.concatenate(x) for x in zip(self.rest, (turn, code, node)))
        self.rest = turn[:0], code[:0], node[:0]
        if not len(code):
            return
        band = (code >> self.shift).astype(np.int64)
        changes = np.flatnonzero((turn[1:] != turn[:-1]) | (band[1:] != band[:-1])) + 1
        starts, ends = [0, *changes.tolist()], [*changes.tolist(), len(code)]
        for s, e in zip(starts, ends):
            where = int(turn[s]), int(band[s])
            while e - s > self.leaf_size:
                self._leaf(*where, code[s : s + self.leaf_size], node[s : s + self.leaf_size], False)
                s += self.leaf_size
                self.continued = True
            if e == len(code) and not final:
                self.rest = turn[s:], code[s:], node[s:]
                return
            alone = not self.continued and e < len(code)
            if not alone or e - s > 1:
                self._leaf(*where, code[s:e], node[s:e], alone)
            self.continued = False

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.edges:
            a, b = (np.concatenate(x) for x in zip(*self.edges))
            nothing = [pa.nulls(len(a), f.type) for f in list(_LEAF_ARROW)[2:]]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *nothing], schema=_LEAF_ARROW)
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, schema=_LEAF_ARROW)
        self.edges, self.rows = [], []


def _leaves(distance: int, leaf_size: int, band_bits: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _LeafCutter(distance, leaf_size, band_bits)
        for batch in batches:
            turn, code, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cutter.add(turn.astype(np.int64), code.view(np.uint64), node, False)
            yield from cutter.taken()
        cutter.add(*(x[:0] for x in cutter.rest), True)
        yield from cutter.taken()

    return cut


def _across(distance: int):
    """Links between the codes of two leaves of one band."""

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                x, y = (np.frombuffer(c, dtype=np.uint64) for c in (row.codes, row.codes_))
                nodes = np.concatenate([np.frombuffer(c, dtype=np.int64) for c in (row.nodes, row.nodes_)])
                i, j = near_pairs(x, y, distance)
                a, b = _forest_edges(nodes, i, j + len(x))
                if len(a):
                    yield pd.DataFrame({"a": a, "b": b})

    return link


def hamming_links(codes: DataFrame, staging: Staging, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) that connect exactly what links of at most ``distance`` bits connect.

    ``codes`` has distinct LONG values ``code`` and one LONG ``node`` for each.
    """
    bands = distance + 1
    band_bits = 64 // bands
    turns = F.explode(
        F.array(*[
            F.struct(F.lit(t).alias("turn"), _rotated(F.col("code"), t * band_bits).alias("code"))
            for t in range(bands)
        ])
    )
    n = shuffle_partitions(codes.sparkSession)
    ordered = (
        codes.select("node", turns.alias("r"))
        .select("r.turn", "r.code", "node", _gray_rank(F.col("r.code")).alias("rank"))
        .repartitionByRange(n, "turn", "rank").sortWithinPartitions("turn", "rank")
        .select("turn", "code", "node")
    )
    found = staging.write(ordered.mapInArrow(_leaves(distance, leaf, band_bits), _LEAF_SCHEMA), "leaves")
    leaves = found.filter("leaf IS NOT NULL").drop("a", "b")
    other = leaves.select("turn", "band", *[F.col(c).alias(f"{c}_") for c in ("leaf", "low", "high", "codes", "nodes")])
    # Bits on which both leaves agree within themselves and differ from one another.
    apart = F.expr("bit_count((low ^ low_) & ~(low ^ high) & ~(low_ ^ high_))")
    pairs = leaves.join(other.hint("merge"), ["turn", "band"]).filter("leaf < leaf_").filter(apart <= distance)
    across = pairs.select("codes", "nodes", "codes_", "nodes_").mapInPandas(_across(distance), "a long, b long")
    return found.filter("a IS NOT NULL").select("a", "b").unionByName(across)


def simhash_classes(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (LONG), ``component_id``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most
    ``distance`` bits. Null and empty texts have fingerprint 0 and link like any other. Rows
    that repeat an id are returned as often. A row without an id gets the component of its
    fingerprint, null if no row with an id is in it. An empty table gives an empty result;
    further columns of ``docs`` are not looked at.
    """
    staging = Staging.of(docs)
    marked = staging.write(
        docs.select(F.col(key).cast("long").alias("doc_id"), fingerprint(F.col(text), shingle).alias("fingerprint")),
        "fingerprints",
    )
    codes = staging.write(
        marked.groupBy(F.col("fingerprint").alias("code")).agg(F.min("doc_id").alias("node")).filter("node IS NOT NULL"),
        "codes",
    )
    joined = components(hamming_links(codes, staging, distance), staging)
    classes = codes.join(joined.hint("merge"), "node", "left").select(
        F.col("code").alias("fingerprint"), F.coalesce("component", "node").alias("component_id")
    )
    return marked.join(classes.hint("merge"), "fingerprint", "left").select("doc_id", "fingerprint", "component_id")


def drop_near_copies(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``docs`` with the smallest id of each class of near copies, all columns.

    Rows that repeat the kept id are the same document and stay; rows without an id stay.
    """
    staging = Staging.of(docs)
    classes = simhash_classes(docs, key=key, text=text, shingle=shingle, distance=distance)
    gone = staging.write(
        classes.filter("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct(), "copies"
    )
    return without(docs, gone, key, key)
