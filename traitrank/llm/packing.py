"""Packing of documents into windows by lexical retrieval.

Documents are tokenized and cut: whole windows of a long document are sequences by themselves,
what remains is a piece below the window's length. Pieces are sorted by their two heaviest terms
and dealt into shards, so that pieces on the same matter meet. Every shard builds an inverted
BM25 index over its pieces, with document frequencies counted over all pieces. Then the next
unused piece seeds a window, the index returns its unused neighbours by score, and they fill the
window greedily; the last one is cut where the window is full and its rest seeds the next one. A
shard's last, open window is cut into sequences whose lengths are powers of two.

A shard holds at most ``SHARD`` pieces of less than a window, whatever the input. Terms are token
ids, so the frequencies are an array no longer than the vocabulary.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitrank.llm.common import shuffle_partitions
from traitrank.sources.staging import Staging

WINDOW = 1024
END_ID = 0
SHARD = 1024
K1, B = 1.2, 0.75
# Share of a shard's pieces from which on a term is not looked up; None looks up all of them.
COMMON = None
# Terms in more than this share of a shard's pieces are kept as a weight for each of its pieces, the
# others as postings; that is for speed and leaves none out.
DENSE = 0.25
# Pieces, chosen by a hash, whose keys cut the order into tasks.
BOUNDS_SAMPLE = 16_384
_WRITTEN = 512
# Neighbours that are put in order at once; the others are when these do not fill the window.
AT_ONCE = 8
# A shard's index is made smaller when no more than this share of the pieces in it is unused.
KEPT = 0.75

# ``tiktoken`` looks for special tokens in every text, and without any for the empty string at every
# sign, which takes a third of its time. This one is looked for instead and never allowed as a token.
_NOT_ALLOWED = "<|not allowed|>"

# A run of white space that ends in front of something else gives its last sign to what follows.
_LOOK_AHEAD = r"|\s+(?!\S)|\s+"
_USUAL = "\n\t\r"
_UNUSUAL = "\x0b\x0c\x1c\x1d\x1e\x1f"
_WIDE = "".join(filter(str.isspace, map(chr, range(128, 0x10000))))
_BEFORE_LAST = re.compile(r"(?<=\s)(?=\s\S)")
# White space to Python's expressions and not to the tokenizer's.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")


def _single_spaced(text: str) -> bool:
    """No two signs of white space side by side, and none but the usual ones; by the cheapest searches."""
    if any(c in text for c in _UNUSUAL) or not text.isascii() and any(c in text for c in _WIDE):
        return False
    for c in _USUAL:
        text = text.replace(c, " ")
    return "  " not in text


class Encoder:
    """Ids of a text as bytes of unsigned 32-bit numbers, by the ranks of a byte-level BPE file.

    The ids are those of the ``tokenizers`` library for the same vocabulary without tokens around
    the text: texts are cut at the strings of ``special``, which have ids of their own. Ranks are
    looked up between the pattern's cuts alone, so where the pattern ends with the usual look-ahead,
    texts are cut in front of the last sign of a run of white space and a pattern without
    look-ahead does the rest, at nearly twice the speed.
    """

    def __init__(self, path: str, pattern: str, special: dict[str, int] | None = None):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(n) for a, n in map(bytes.split, file)}
        self.special = special or {}
        looked_for = {_NOT_ALLOWED: max(ranks.values()) + 1}
        self.exact = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=looked_for)
        self.fast = None
        if pattern.endswith(_LOOK_AHEAD):
            plain = pattern.removesuffix(_LOOK_AHEAD) + r"|\s+"
            self.fast = tiktoken.Encoding("plain", pat_str=plain, mergeable_ranks=ranks, special_tokens=looked_for)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.vocabulary = max([*ranks.values(), *self.special.values()]) + 1

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return b"".join(
                np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._ordinary(part)
                for part in self.cut.split(text)
            )
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if self.fast is None:
            return self._encoded(self.exact, text)
        if _single_spaced(text):
            return self._encoded(self.fast, text)
        if _SEPARATORS.search(text):
            return self._encoded(self.exact, text)
        return b"".join(self._encoded(self.fast, part) for part in _BEFORE_LAST.split(text))

    @staticmethod
    def _encoded(bpe, text: str) -> bytes:
        return bpe.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


@cache
def default_tokenizer() -> tuple[str, str, dict[str, int]]:
    """Path of the rank file, the splitting pattern and the tokens that the ``tokenizers`` file adds
    to them; any byte-level BPE can be given instead."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added


@cache
def _built(path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> Encoder:
    return Encoder(path, pattern, dict(special))


def encoder_of(tokenizer: tuple[str, str, dict[str, int]] | None = None) -> Encoder:
    """The encoder of (rank file, pattern, added tokens), built once in a Python process."""
    path, pattern, special = (*(tokenizer or default_tokenizer()), None)[:3]
    return _built(path, pattern, tuple((special or {}).items()))


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("ids", pa.binary()),
])
_PIECES_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
_KEYED_SQL = f"task int, top long, second long, {_PIECES_SQL}"
_LEAST = -(1 << 63)
_COUNTED = pa.schema([*_PIECES, ("term", pa.int64()), ("n", pa.int64())])
_COUNTED_SQL = f"{_PIECES_SQL}, term long, n long"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _occurrences(pieces: list[np.ndarray], by_piece: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each term of each piece, the piece and how often it occurs there, sorted by piece or by term.

    All pieces are sorted at once, which takes much less than a sort for each.
    """
    owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    ids = np.concatenate(pieces).astype(np.int64)
    high, low = (owner, ids) if by_piece else (ids, owner)
    bits = int(low.max()).bit_length()
    pair, counts = np.unique(high << bits | low, return_counts=True)
    high, low = pair >> bits, pair & ((1 << bits) - 1)
    return (low, high, counts) if by_piece else (high, low, counts)


def _tokenize(window: int, end_id: int, tokenizer: tuple[str, str, dict[str, int]] | None):
    """Pieces of every document; ids only with those shorter than a window.

    At the end of a partition come rows (term, n) of the terms in its short pieces, then the number
    of these pieces as term -1 and of their ids as -2, so no piece is read again to count them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer), np.array([end_id], "<u4").tobytes()
        df, short, total = np.zeros(max(end_id + 1, encoder.vocabulary), np.int64), 0, 0
        rows = []

        def counted() -> pa.RecordBatch:
            nonlocal short, total
            parts = [np.frombuffer(r[5], "<u4") for r in rows if r[5] is not None]
            if parts:
                seen = np.bincount(_occurrences(parts, by_piece=False)[0])
                df[: len(seen)] += seen
                short, total = short + len(parts), total + sum(map(len, parts))
            return _batch(rows, _COUNTED)

        for batch in batches:
            for key, text in zip(*batch.columns):
                ids = encoder.ids(text.as_py() or "") + end
                n, key = len(ids) // 4, key.as_py()
                for start in range(0, n, window):
                    part = ids[4 * start : 4 * (start + window)]
                    length = len(part) // 4
                    rows.append((key, start, length, zlib.crc32(part), n, part if length < window else None, None, None))
                if len(rows) >= _WRITTEN:
                    yield counted()
                    rows = []
        if rows:
            yield counted()
        if short:
            seen = np.flatnonzero(df)
            n = len(seen) + 2
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(n, f.type) for f in _PIECES), pa.array(np.r_[seen, -1, -2]), pa.array(np.r_[df[seen], short, total])],
                schema=_COUNTED,
            )

    return cut


@dataclass
class Statistics:
    rarity: np.ndarray
    mean_length: float

    def weights(self, terms: np.ndarray, counts: np.ndarray, length) -> np.ndarray:
        """BM25 weights of terms that occur ``counts`` times in pieces of ``length`` ids."""
        norm = K1 * (1 - B + B * length / self.mean_length)
        return self.rarity[terms] * counts * (K1 + 1) / (counts + norm)


def _heaviest(pieces: list[np.ndarray], stats: Statistics) -> tuple[np.ndarray, np.ndarray]:
    """The two heaviest terms of each piece, the smaller of equals, the key that brings like pieces
    together; -1 as the second where there is one term only."""
    terms, owner, counts = _occurrences(pieces, by_piece=True)
    weight = stats.weights(terms, counts, np.array([len(p) for p in pieces])[owner])
    numbers, found = np.arange(len(pieces)), []
    begin = np.searchsorted(owner, numbers)
    for _ in range(2):
        most = np.maximum.reduceat(weight, begin)
        at = np.flatnonzero(weight == most[owner])
        at = at[np.searchsorted(owner[at], numbers)]
        found.append(np.where(most > -np.inf, terms[at], -1))
        weight[at] = -np.inf
    return tuple(found)


def _keyed(shared, bounds: list[tuple] | None = None):
    """Adds the key of each piece and, given ascending (key, doc_id, start), the number of those at or below."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = shared.value
        for batch in (b.slice(at, _WRITTEN) for b in batches for at in range(0, b.num_rows, _WRITTEN)):
            pieces = [np.frombuffer(ids.as_buffer(), "<u4") for ids in batch.column("ids")]
            first, second = _heaviest(pieces, stats)
            places = zip(zip(first.tolist(), second.tolist()), batch.column("doc_id").to_pylist(), batch.column("start").to_pylist())
            task = [bisect_right(bounds or [], (*top, _LEAST if d is None else d, at)) for top, d, at in places]
            yield pa.RecordBatch.from_arrays(
                [pa.array(task, pa.int32()), pa.array(first), pa.array(second), *batch.columns], names=["task", "top", "second", *batch.schema.names]
            )

    return key


def _bounds(short: DataFrame, shared, n: int, tasks: int) -> list[tuple]:
    """Ascending (top, second, doc_id, start) that cut the ``n`` pieces into ``tasks`` about equal parts."""
    every = max(1, n // BOUNDS_SAMPLE)
    chosen = short.filter(F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(every)) == 0)
    keys = chosen.mapInArrow(_keyed(shared), _KEYED_SQL).select("top", "second", "doc_id", "start").collect()
    ordered = sorted((r.top, r.second, _LEAST if r.doc_id is None else r.doc_id, r.start) for r in keys)
    return [ordered[len(ordered) * t // tasks] for t in range(1, tasks)] if ordered else []


class Shard:
    """Inverted index over some pieces, and which of them are used.

    A piece never becomes unused again, so the index is made smaller as pieces are used up; what
    is added to the score of another piece, and in which order, stays the same.
    """

    def __init__(self, pieces: list[np.ndarray], stats: Statistics, common: float | None = COMMON):
        n, length = len(pieces), np.array([len(p) for p in pieces])
        most = n if common is None else max(2, common * n)
        term, owner, counts = _occurrences(pieces, by_piece=False)
        weight = stats.weights(term, counts, length[owner])
        begins = np.diff(term, prepend=-1) != 0
        # Number of the term of each posting, and of the terms of each piece that are looked up.
        self.nth = np.cumsum(begins) - 1
        size = np.bincount(self.nth)
        looked_up = (size <= most)[self.nth]
        by_piece = np.argsort(owner.astype(np.min_scalar_type(n)), kind="stable")
        self.terms = self.nth[by_piece[looked_up[by_piece]]]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(owner[looked_up], minlength=n))])
        # Row in ``rows`` of a term that many pieces have, -1 for one that has its postings only.
        many = size > DENSE * n
        self.row = np.where(many, np.cumsum(many) - 1, -1)
        self.rows = np.zeros((many.sum(), n))
        of = self.row[self.nth]
        self.rows[of[of >= 0], owner[of >= 0]] = weight[of >= 0]
        self.n, self.unused = n, np.ones(n, bool)
        # Pieces in the index; ``owner`` and the columns of ``rows`` are places among them.
        self.left = np.arange(n)
        self._list(self.nth[of < 0], owner[of < 0], weight[of < 0], len(size))

    def _list(self, nth: np.ndarray, owner: np.ndarray, weight: np.ndarray, terms: int):
        self.nth, self.owner, self.weight = nth, owner, weight
        self.size = np.bincount(nth, minlength=terms)
        self.begin = np.cumsum(self.size) - self.size

    def _drop_used(self):
        keep = self.unused[self.left]
        place, listed = np.cumsum(keep) - 1, keep[self.owner]
        self.left, self.rows = self.left[keep], self.rows[:, keep]
        self._list(self.nth[listed], place[self.owner[listed]], self.weight[listed], len(self.size))

    def _scores(self, seed: int) -> np.ndarray:
        """Scores of the pieces in ``left``, 0 for used ones."""
        if np.count_nonzero(self.unused) <= KEPT * len(self.left):
            self._drop_used()
        at = self.terms[self.first[seed] : self.first[seed + 1]]
        row = self.row[at]
        at = at[row < 0]
        size = self.size[at]
        end = np.cumsum(size)
        postings = np.arange(size.sum()) + np.repeat(self.begin[at] - end + size, size)
        score = np.bincount(self.owner.take(postings), self.weight.take(postings), len(self.left))
        return (score + self.rows.take(row[row >= 0], axis=0).sum(axis=0)) * self.unused[self.left]

    def best_first(self, seed: int) -> Iterator[int]:
        """Unused pieces that share a looked-up term with the seed, best first, ties by position."""
        score, left = self._scores(seed), self.left
        least = 0
        if len(score) > AT_ONCE:
            least = np.partition(score, len(score) - AT_ONCE)[-AT_ONCE]
        for chosen in (score >= least, score < least) if least > 0 else (score > 0,):
            found = np.flatnonzero(chosen & (score > 0))
            yield from left[found[np.argsort(-score[found], kind="stable")]].tolist()

    def neighbours(self, seed: int) -> np.ndarray:
        """All that ``best_first`` gives."""
        return np.fromiter(self.best_first(seed), np.int64)


def fill(
    pieces: list[np.ndarray], stats: Statistics, window: int, common: float | None = COMMON
) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (piece, from, to); only the last can be shorter than ``window``."""
    shard, following = Shard(pieces, stats, common), 0
    current, room = [], window
    seed = rest = None
    while True:
        if rest is None:
            while following < shard.n and not shard.unused[following]:
                following += 1
            if following == shard.n:
                break
            seed, rest = following, 0
            shard.unused[seed] = False
        # The seed opens the window, or goes on behind pieces that found no more neighbours.
        queue = iter(())
        piece, begin = seed, rest
        rest = None
        searched = False
        while True:
            taken = min(room, len(pieces[piece]) - begin)
            current.append((piece, begin, begin + taken))
            room -= taken
            if not room:
                yield current
                current, room = [], window
                if begin + taken < len(pieces[piece]):
                    seed, rest = piece, begin + taken
                break
            if not searched:
                queue, searched = shard.best_first(seed), True
            piece, begin = next(queue, None), 0
            if piece is None:
                break
            shard.unused[piece] = False
    if current:
        yield current


def by_powers_of_two(open_window: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """An open window as full sequences, one for each power of two in its length."""
    left = sum(e - s for _, s, e in open_window)
    parts = list(open_window)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            piece, begin, end = parts.pop(0)
            taken = min(room, end - begin)
            sequence.append((piece, begin, begin + taken))
            room -= taken
            if begin + taken < end:
                parts.insert(0, (piece, begin + taken, end))
        yield sequence


_PLACED = pa.schema([(c, pa.int64()) for c in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
)])
_PLACED_SQL = ", ".join(f"{c} long" for c in _PLACED.names)


def _pack(window: int, shard_size: int, common: float | None, shared):
    def packed(rows: list[tuple], first: int) -> tuple[list[tuple], int]:
        pieces = [np.frombuffer(r[-1], "<u4") for r in rows]
        placed, sequence = [], first
        for filled in fill(pieces, shared.value, window, common):
            whole = sum(e - s for _, s, e in filled) == window
            for part in [filled] if whole else by_powers_of_two(filled):
                offset = 0
                for piece, begin, end in part:
                    key, start, _, _, tokens, ids = rows[piece]
                    crc = zlib.crc32(ids[4 * begin : 4 * end])
                    placed.append((key, start + begin, end - begin, crc, tokens, 2 * sequence, offset))
                    offset += end - begin
                sequence += 1
        return placed, sequence

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sequence = [], TaskContext.get().partitionId() << 36
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns))
            while len(rows) >= shard_size:
                placed, sequence = packed(rows[:shard_size], sequence)
                rows = rows[shard_size:]
                yield _batch(placed, _PLACED)
        if rows:
            yield _batch(packed(rows, sequence)[0], _PLACED)

    return pack


def pack_by_retrieval(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard: int = SHARD,
    end_id: int = END_ID,
    common: float | None = COMMON,
    tokenizer: tuple[str, str, dict[str, int]] | None = None,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece.

    Every id of every document, ``end_id`` included, lies in exactly one piece; the pieces of a
    sequence lie side by side from offset 0. ``tokenizer`` is (rank file, pattern, added tokens); strings of added
    tokens in a text become these tokens. Neighbours are found by full BM25 scores; a caller may name
    with ``common`` a share of a shard's pieces from which on a term is not looked up. Null and
    empty texts are the end id alone. Null ids and rows that repeat an id are packed like any
    other. An empty table gives an empty result; further columns are not looked at.
    """
    spark, staging = docs.sparkSession, Staging.of(docs)
    written = staging.write(
        docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .mapInArrow(_tokenize(window, end_id, tokenizer), _COUNTED_SQL),
        "pieces",
    )
    pieces = written.filter("term IS NULL").drop("term", "n")
    # Odd numbers are for windows of one document, even ones for packed sequences.
    alone = pieces.filter(F.col("ids").isNull()).select(
        *_PLACED.names[:5], (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = pieces.filter(F.col("ids").isNotNull())
    vocabulary = max(end_id + 1, encoder_of(tokenizer).vocabulary)
    counted = {
        r.term: r.n for r in written.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).collect()
    }
    n, total = counted.pop(-1, 0), counted.pop(-2, 0)
    df = np.zeros(vocabulary)
    df[list(counted)] = list(counted.values())
    rarity = np.log(1 + (n - df + 0.5) / (df + 0.5))
    shared = spark.sparkContext.broadcast(Statistics(rarity, max(total / max(n, 1), 1.0)))
    order = ["top", "second", "doc_id", "start"]
    tasks = shuffle_partitions(spark)
    # Spark's own ranges would key every piece twice, once to draw the bounds.
    bounds = _bounds(short, shared, n, tasks)
    dealt = (
        short.mapInArrow(_keyed(shared, bounds), _KEYED_SQL).repartitionById(tasks, "task")
        .sortWithinPartitions(*order, "ids_crc32").drop("task", "top", "second")
    )
    return dealt.mapInArrow(_pack(window, shard, common, shared), _PLACED_SQL).unionByName(alone)
