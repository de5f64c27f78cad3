"""Rows that come before what they belong to, held in keyed state until it has come.

``held_until_open`` meets rows and openings by key. A row whose key is open goes through; another
one waits in the state store, and leaves it once, when the opening comes. Keys are handed to the
operator by the bucket, since a call to the state costs more than the work on a row. What comes is
appended to a list of its bucket in one call, up to 256 rows as one value. The first batch that has
to ask a list takes what it needs and moves the rest to entries by key, so nothing is read from a
list twice; after that a batch touches the keys it brings and no others. State and progress are
committed together by the stream's checkpoint, so a batch that broke off is played again on the
state before it.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

# What runs on the executors travels with the job; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROW = "__row"
_OPENS = "__opens"
_BUCKET = "__bucket"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Groups in which keys are handed over. State is laid out by it: another number needs new checkpoints.
BUCKETS = 8192
# Rows that are handed to the state store at once, as one value of a list.
_CHUNK = 256
_CHUNKS = StructType().add("chunk", BinaryType())


def _packed(tuples: list[tuple]) -> tuple[bytes]:
    # A fixed protocol, as the state outlives the Python that wrote it.
    return (pickle.dumps(tuples, protocol=4),)


def _unpacked(chunks: Iterable[tuple[bytes]]) -> Iterator[tuple]:
    for (chunk,) in chunks:
        yield from pickle.loads(chunk)


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB, which the operator needs."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


class _Gate(StatefulProcessor):
    """Per bucket: lists of the rows that wait and of the keys that opened, in the order they came and
    some hundred to a value, and a map by key: whether it is open, how many rows wait for that, and the
    first of them. Further rows of a key are entries of their own.

    A key of ``opened`` has no entry in ``gates`` and no row that waits.
    """

    def __init__(self, keys: StructType, schema: StructType):
        self.keys = keys
        self.schema = schema
        self.places = [schema.names.index(name) for name in keys.names]

    def init(self, handle: StatefulProcessorHandle) -> None:
        gate = StructType().add("open", BooleanType()).add("stored", LongType()).add("first", self.schema)
        part = StructType([*self.keys.fields, StructField("__part", LongType())])
        self.waiting = handle.getListState("waiting", _CHUNKS)
        self.opened = handle.getListState("opened", _CHUNKS)
        self.gates = handle.getMapState("gates", self.keys, gate)
        self.further = handle.getMapState("further", part, self.schema)

    def _values(self, row: dict | Row) -> tuple:
        return tuple(row[name] for name in self.schema.names)

    def _row(self, values: tuple) -> Row:
        return Row(*self.schema.names)(*values)

    def _key(self, values: tuple) -> tuple:
        return tuple(values[place] for place in self.places)

    def _gate(self, key: tuple) -> tuple:
        """Whether the key is open, the number of rows in entries, and the first of them."""
        found = self.gates.getValue(key)
        if found is None:
            return False, 0, None
        return found[0], found[1], found[2] and self._plain(found[2])

    def _plain(self, values: Row | tuple) -> tuple:
        """Values as they came in: the state gives nested ones as rows, which it does not take back."""
        return self._values(Row(**dict(zip(self.schema.names, values))).asDict(recursive=True))

    def _move_opened(self) -> set:
        """Give every key of the list its entry."""
        moved = set(_unpacked(self.opened.get())) if self.opened.exists() else set()
        for key in moved:
            self.gates.updateValue(key, (True, 0, None))
        if moved:
            self.opened.clear()
        return moved

    def _move_waiting(self, rows: dict, has_gates: bool) -> None:
        """Give rows, by key, their entries."""
        for key, values in rows.items():
            _, stored, first = self._gate(key) if has_gates else (False, 0, None)
            first = first if stored else values[0]
            for part, row in enumerate(values, stored):
                if part:
                    self.further.updateValue((*key, part), row)
            self.gates.updateValue(key, (False, stored + len(values), first))

    def _entries(self, key: tuple, stored: int, first: tuple | None) -> Iterator[tuple]:
        """The rows of a key, which leave their entries."""
        if stored:
            yield first
        for part in range(1, stored):
            yield self.further.getValue((*key, part))
            self.further.removeKey((*key, part))

    def _let_go(self, opening: Sequence[tuple], has_gates: bool) -> Iterator[tuple]:
        """Open keys; their rows leave the state."""
        rest = {}
        if self.waiting.exists():
            wanted = set(opening)
            for values in _unpacked(self.waiting.get()):
                key = self._key(values)
                if key in wanted:
                    yield values
                else:
                    rest.setdefault(key, []).append(values)
            self.waiting.clear()
        new = []
        for key in opening:
            is_open, stored, first = self._gate(key) if has_gates else (False, 0, None)
            if stored:
                yield from self._entries(key, stored, first)
                self.gates.updateValue(key, (True, 0, None))
            elif not is_open:
                new.append(key)
        if rest:
            self._move_waiting(rest, has_gates)
        for at in range(0, len(new), _CHUNK):
            self.opened.appendList([_packed(new[at : at + _CHUNK])])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Openings of earlier batches get their entries once anything comes, so the list is that of one batch.
        is_open = dict.fromkeys(self._move_opened(), True)
        has_gates = bool(is_open) or self.gates.exists()
        opening, came = {}, []
        for row in rows:
            at = tuple(row[name] for name in self.keys.names)
            if row[_OPENS]:
                opening[at] = True
                continue
            if at not in is_open and at not in opening:
                is_open[at] = has_gates and self._gate(at)[0]
            if at in opening or is_open[at]:
                yield self._row(self._values(row[_ROW]))
                continue
            came.append(self._values(row[_ROW]))
            if len(came) == _CHUNK:
                self.waiting.appendList([_packed(came)])
                came = []
        new = [at for at in opening if not is_open.get(at)]
        if new:
            yield from (self._row(values) for values in came if self._key(values) in opening)
            came = [values for values in came if self._key(values) not in opening]
            yield from map(self._row, self._let_go(new, has_gates))
        if came:
            self.waiting.appendList([_packed(came)])

    def close(self) -> None:
        pass


def held_until_open(rows: DataFrame, openings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The streamed ``rows`` whose key has come in ``openings``, now or earlier; the others wait.

    ``keys`` are columns of both sides, of atomic types. Start the query inside ``keyed_state``. Rows
    with a null in their key wait for ever; filter them out before. The state of a key is one task's,
    so salt keys that hold many rows.
    """
    schema = rows.schema
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias(_BUCKET)
    tagged = rows.select(bucket, *keys, F.struct(*schema.names).alias(_ROW), F.lit(False).alias(_OPENS))
    opening = openings.select(bucket, *keys, F.lit(None).cast(StructType(schema.fields)).alias(_ROW), F.lit(True).alias(_OPENS))
    gates = _Gate(StructType([schema[name] for name in keys]), schema)
    return tagged.unionByName(opening).groupBy(_BUCKET).transformWithState(gates, schema, "Append", "None")
