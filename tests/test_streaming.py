"""Early arrivals in keyed state, streams of tables, and the paged stream."""

from random import Random

import pytest
from comparing import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitrank import schemas
from traitrank.plans.rarity_run import RarityRun
from traitrank.sources.staging import Staging
from traitrank.streaming import arrivals, incremental


@pytest.fixture
def gate(spark):
    """Lands rows and openings, and gives what a drain lets go."""
    staging = Staging(spark)
    paths = {k: staging.path(k) for k in ("rows", "openings", "seen")}
    shapes = {"rows": "k string, body string", "openings": "k string"}
    for name, shape in shapes.items():
        spark.createDataFrame([], shape).write.json(paths[name])

    def run(landed, opened, fail=False):
        for name, data in (("rows", landed), ("openings", [(k,) for k in opened])):
            if data:
                spark.createDataFrame(data, shapes[name]).coalesce(1).write.mode("append").json(paths[name])
        streams = [incremental.file_stream(spark, paths[n], spark.createDataFrame([], s).schema) for n, s in shapes.items()]
        got = []

        def batch(df):
            got.extend((r.k, r.body) for r in df.collect())
            if fail:
                raise RuntimeError("broken off")

        with arrivals.keyed_state(spark):
            incremental.drain(arrivals.held_until_open(*streams, ["k"]), paths["seen"], batch)
        return sorted(got)

    return run


def test_rows_wait_for_their_key(gate):
    assert gate([("a", "1"), ("b", "2"), ("a", "3")], []) == []
    assert gate([("c", "4")], ["a"]) == [("a", "1"), ("a", "3")]
    # What went through is not let go again; an open key lets rows through at once.
    assert gate([("a", "5")], ["a", "b"]) == [("a", "5"), ("b", "2")]
    assert gate([("d", str(n)) for n in range(600)], ["d"]) == sorted(("d", str(n)) for n in range(600))


def test_keys_are_handed_over_by_the_bucket(gate, monkeypatch, tmp_path):
    """300 keys in 8 buckets: eight calls a batch at most, not one for every key."""
    calls, handle = str(tmp_path / "calls"), arrivals._Gate.handleInputRows

    def counted(self, key, rows, timer_values):
        with open(calls, "a") as file:
            file.write("x")
        return handle(self, key, rows, timer_values)

    monkeypatch.setattr(arrivals, "BUCKETS", 8, raising=False)
    monkeypatch.setattr(arrivals._Gate, "handleInputRows", counted)
    keys = [f"k{n}" for n in range(300)]
    assert gate([(k, "1") for k in keys], keys[:50]) == sorted((k, "1") for k in keys[:50])
    # Rows of one key from several batches, some of its own open neighbours, some before the opening.
    assert gate([(k, "2") for k in keys], []) == sorted((k, "2") for k in keys[:50])
    assert gate([("k299", "3"), ("k299", "3")], keys[40:]) == sorted(
        [(k, b) for k in keys[50:] for b in "12"] + [("k299", "3")] * 2
    )
    assert len((tmp_path / "calls").read_text()) <= 24


class _State:
    """A map or list state that counts the calls and notes which entries are read."""

    def __init__(self, schema=None):
        self.schema, self.entries, self.rows, self.read, self.calls = schema, {}, [], [], 0

    def exists(self):
        return bool(self.entries or self.rows)

    def getValue(self, key):
        self.calls += 1
        self.read.append(key)
        return self.entries.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.entries[key] = value

    def removeKey(self, key):
        del self.entries[key]

    def get(self):
        self.read.extend(self.rows)
        return iter(list(self.rows))

    def appendList(self, rows):
        self.calls += 1
        self.rows.extend(rows)

    def clear(self):
        self.rows = []


class _Handle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, _State())

    getListState = getMapState


@pytest.fixture
def bucket():
    """Hands batches to one bucket and gives what it lets go, its states, and the calls that took."""
    schema = StructType().add("k", "string").add("body", "string")
    gate, handle = arrivals._Gate(StructType().add("k", "string"), schema), _Handle()
    gate.init(handle)

    def batch(*arrived):
        for state in handle.states.values():
            state.read, state.calls = [], 0
        given = [{"k": k, "__row": body and {"k": k, "body": body}, "__opens": body is None} for k, body in arrived]
        return [tuple(r) for r in gate.handleInputRows((0,), iter(given), None)]

    return batch, handle.states, lambda: sum(s.calls for s in handle.states.values())


def test_what_comes_together_takes_few_calls(bucket):
    batch, states, calls = bucket
    rows = [(f"k{n}", "x") for n in range(1000)]
    assert batch(*rows) == [] and calls() == 4
    assert batch(*((k, None) for k, _ in rows)) == rows and calls() == 4
    assert not states["waiting"].rows and not states["gates"].entries


def test_a_list_holds_many_rows_to_a_value(bucket):
    batch, states, _ = bucket
    rows = [(f"k{n}", "x") for n in range(1000)]
    assert batch(*rows) == [] and len(states["waiting"].rows) == 4
    assert batch(*((k, None) for k, _ in rows)) == rows and len(states["opened"].rows) == 4
    # What opened gets an entry per key, as before.
    assert batch(("k7", "y"), ("k1000", "y")) == [("k7", "y")]
    assert len(states["gates"].entries) == 1000 and not states["opened"].rows


def test_a_batch_reads_the_state_of_its_own_keys_only(bucket):
    batch, states, _ = bucket
    assert batch(*((f"k{n}", "x") for n in range(1000)), ("k1", "y")) == []
    # The first opening moves all others to entries by key; they are not read again.
    assert batch(("k2", "y"), ("k2", None)) == [("k2", "y"), ("k2", "x")]
    assert len(states["gates"].entries) == 999 and list(states["further"].entries) == [("k1", 1)]
    assert batch(("k1", "z"), ("k3", None), ("k2", "z")) == [("k2", "z"), ("k3", "x")]
    assert not states["waiting"].read[1:] and set(states["gates"].read) == {("k1",), ("k3",)}
    # More rows than are handed over at once; the opening comes last, and again.
    many = [("hot", str(n)) for n in range(700)]
    assert sorted(batch(*many, ("hot", None))) == sorted(many)
    assert batch(("hot", None), ("k1", None), ("k1", None)) == [("k1", "x"), ("k1", "y"), ("k1", "z")]
    assert batch(("hot", "a"), ("k1", "a"), ("k2", "a"), ("k3", "a")) == [("hot", "a"), ("k1", "a"), ("k2", "a"), ("k3", "a")]
    assert not states["further"].entries and not states["waiting"].rows and len(states["gates"].entries) == 1001


def test_openings_that_come_again_do_not_pile_up(bucket):
    batch, states, _ = bucket
    for _ in range(4):
        assert batch(("a", None), ("b", None), ("a", None)) == []
    assert len(states["opened"].rows) + len(states["gates"].entries) == 2


@pytest.mark.parametrize("seed", range(20))
def test_every_row_is_let_go_once_at_the_first_chance(bucket, monkeypatch, seed):
    """Random batches against a plain account of them."""
    monkeypatch.setattr(arrivals, "_CHUNK", 3)
    batch, _, _ = bucket
    draw, waits, is_open = Random(seed), [], set()
    for number in range(30):
        came = [(f"k{draw.randrange(12)}", None if draw.random() < 0.1 else f"{number}-{n}") for n in range(draw.randrange(12))]
        is_open |= {k for k, body in came if body is None}
        waits += [r for r in came if r[1] is not None]
        assert sorted(batch(*came)) == sorted(r for r in waits if r[0] in is_open)
        waits = [r for r in waits if r[0] not in is_open]


def test_nested_rows_wait_unchanged(spark):
    """Structs, lists and nulls of a row that is put into the state twice."""
    shape, staging = "k string, a struct<b: long, c: array<string>>, d double", Staging(spark)
    schema, paths = spark.createDataFrame([], shape).schema, {k: staging.path(k) for k in ("rows", "openings", "seen")}
    landed = [("a", (9007199254740993, ["x", None]), None), ("a", (None, None), 0.1), ("a", None, 2.0)]
    got = []

    def drain():
        streams = [incremental.file_stream(spark, paths[n], schema) for n in ("rows", "openings")]
        with arrivals.keyed_state(spark):
            incremental.drain(arrivals.held_until_open(*streams, ["k"]), paths["seen"], lambda df: got.extend(df.collect()))

    spark.createDataFrame([], schema).write.json(paths["openings"])
    for row in landed:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(paths["rows"])
        drain()
    assert got == []
    spark.createDataFrame([("a", None, None)], schema).coalesce(1).write.mode("append").json(paths["openings"])
    drain()
    assert sorted(map(repr, got)) == sorted(map(repr, spark.createDataFrame(landed, schema).collect()))


def test_a_batch_that_breaks_off_loses_nothing(gate, spark):
    assert gate([("a", "1")], []) == []
    with pytest.raises(Exception, match="broken off"):
        gate([], ["a"], fail=True)
    assert gate([], []) == [("a", "1")]
    assert gate([("b", "2")], []) == []


def test_the_setting_is_put_back(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with pytest.raises(ValueError), arrivals.keyed_state(spark):
        raise ValueError
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_a_failure_between_landing_and_writing_loses_nothing(spark, database, monkeypatch):
    """The write of a released document fails once; the next drain plays the batch again."""
    run = RarityRun(spark, schemas.TableNames(prefix=database))
    run.create_tables()
    run.register(spark.createDataFrame([("0xAAAAAAAA01", 0)], "contract_address string, ordinal int"))
    staging = Staging(spark)
    paths = {k: staging.path(k) for k in ("pages", "docs", "pages_seen", "docs_seen")}
    body = '{"raw":{"metadata":{"attributes":[{"trait_type":"hat","value":"red"}]}}}'
    spark.createDataFrame([("0xaaaaaaaa01", "7", 1, 200, body)], schemas.DOCUMENTS).coalesce(1).write.json(paths["docs"])
    spark.createDataFrame([("0xAAAAAAAA01", 0, 200, '{"nfts":[{"tokenId":"7"}]}')], schemas.PAGES).coalesce(1).write.json(paths["pages"])

    def documents():
        stream = incremental.file_stream(spark, paths["docs"], schemas.DOCUMENTS)
        incremental.drain_documents(stream, run.names, paths["docs_seen"])

    documents()
    incremental.drain_pages(incremental.file_stream(spark, paths["pages"], schemas.PAGES), run.names, paths["pages_seen"])
    with monkeypatch.context() as broken:
        broken.setattr(RarityRun, "ingest_metadata", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division"):
            documents()
    assert run.table("metadata").isEmpty()
    documents()
    assert rows(run.table("metadata").select("token_id", "trait_value")) == [("7", "red")]


def test_a_table_as_a_stream_gives_new_rows_only(spark, database):
    from traitrank.operators import upsert

    table = f"{database}.t"
    upsert.create_table(spark, table, schemas.RARITY, schemas.PARTITION)
    seen, got = Staging(spark).path("seen"), []

    def drain(token):
        upsert.append(spark.createDataFrame([("c", token, 1, 1)], schemas.RARITY), table, schemas.PARTITION)
        stream = incremental.table_stream(spark, table, ["token_id", "collection_id"])
        incremental.drain(stream, seen, lambda batch: got.extend(batch.select("collection_id", "token_id").collect()))
        return [tuple(r) for r in got]

    assert drain("1") == [("c", "1")]
    assert drain("2") == [("c", "1"), ("c", "2")]


def test_filters_reach_the_paged_source(spark, tmp_path):
    """Only contracts that a filter names are fetched; other filters stay with Spark."""
    from traitrank.sources.paged import PUSHDOWN, paged_source

    def fetch(contract, page_key):
        (tmp_path / f"{contract}-{page_key}").touch()
        return 200, '{"nfts":[{"tokenId":"1"}]' + (',"pageKey":"2"}' if page_key is None else "}")

    spark.dataSource.register(paged_source(fetch, "counted", pushdown=True))

    def fetched(condition):
        for file in tmp_path.iterdir():
            file.unlink()
        before = spark.conf.get(PUSHDOWN)
        spark.conf.set(PUSHDOWN, "true")
        try:
            df = spark.read.format("counted").option("contracts", '["a","b","c"]').load().filter(condition)
            found = sorted((r.contract_address, r.page_no) for r in df.collect())
        finally:
            spark.conf.set(PUSHDOWN, before)
        return found, len(list(tmp_path.iterdir()))

    assert fetched("contract_address = 'b'") == ([("b", 0), ("b", 1)], 2)
    assert fetched("contract_address in ('a', 'c') and page_no = 1") == ([("a", 1), ("c", 1)], 4)
    assert fetched("contract_address = 'none'") == ([], 0)
    assert fetched("page_no = 0") == ([("a", 0), ("b", 0), ("c", 0)], 6)


@pytest.fixture
def paged(spark, tmp_path):
    """Runs one batch of a paged stream and gives all rows landed so far, by contract and page."""
    from traitrank.sources.paged import Marks, paged_stream

    staging = Staging(spark)
    marks, seen, landed = (staging.path(k) for k in ("marks", "seen", "pages"))

    def run(fetch, contracts, write=None):
        import json

        spark.dataSource.register(paged_stream(fetch, "paged_in_test"))
        read = spark.readStream.format("paged_in_test").options(contracts=json.dumps(contracts), marks=marks, pages="2").load()
        sink = read.writeStream.option("checkpointLocation", seen).trigger(availableNow=True)
        (sink.foreachBatch(write) if write else sink.format("parquet").option("path", landed)).start().awaitTermination()
        found = spark.read.schema(schemas.PAGES).parquet(landed) if not write else None
        return found and [r[:3] for r in rows(found)], Marks(marks).any_open(contracts)

    return run


def test_a_paged_stream_goes_on_where_it_was(paged, tmp_path):
    """Two pages a batch, each batch a new stream; page 3 of b fails once, c is not there."""

    def fetch(contract, page_key):
        at = int(page_key or 0)
        (tmp_path / f"{contract}-{at}").open("a").write("x")
        if contract == "c":
            return 404, ""
        if contract == "b" and at == 3 and (tmp_path / "b-3").read_text() == "x":
            return 503, ""
        return 200, '{"nfts":[{"tokenId":"1"}]' + (f',"pageKey":"{at + 1}"}}' if at < 4 else "}")

    contracts = ["a", "b", "c"]
    first, still = paged(fetch, contracts)
    assert first == [("a", 0, 200), ("a", 1, 200), ("b", 0, 200), ("b", 1, 200), ("c", 0, 404)] and still
    second, still = paged(fetch, contracts)
    assert ("b", 3, 503) in second and ("a", 3, 200) in second and still
    third, still = paged(fetch, contracts)
    whole = [("a", n, 200) for n in range(5)] + [("b", n, 200) for n in range(5)] + [("b", 3, 503), ("c", 0, 404)]
    assert third == sorted(whole) and not still
    assert paged(fetch, contracts) == (third, False)
    # Every page was fetched once, but for the one that failed.
    assert {f.name: len(f.read_text()) for f in tmp_path.iterdir()} == {
        **{f"{c}-{n}": 1 for c in "ab" for n in range(5)}, "b-3": 2, "c-0": 1,
    }


def test_a_paged_round_that_breaks_off_is_played_again(paged):
    def fetch(contract, page_key):
        return 200, '{"nfts":[{"tokenId":"1"}],"pageKey":"%d"}' % (int(page_key or 0) + 1)

    def broken(batch, number):
        batch.collect()
        raise RuntimeError("broken off")

    with pytest.raises(Exception, match="broken off"):
        paged(fetch, ["a"], broken)
    assert paged(fetch, ["a"]) == ([("a", 0, 200), ("a", 1, 200)], True)
    assert paged(fetch, ["a"])[0] == [("a", n, 200) for n in range(4)]


def test_a_paged_stream_leaves_a_circle(paged):
    def fetch(contract, page_key):
        return 200, '{"nfts":[{"tokenId":"1"}],"pageKey":"%d"}' % (1 + int(page_key or 0) % 3)

    for _ in range(8):
        found, still = paged(fetch, ["a"])
        if not still:
            break
    assert not still and found[-1][2] == 508 and len(found) <= 10


def test_a_growing_paged_stream_takes_few_batches(spark, tmp_path):
    """100 pages, 2 in the first round: 7 batches, each a new stream; a page that fails once comes again."""
    import json

    from traitrank.sources.paged import Marks, paged_stream

    def fetch(contract, page_key):
        at = int(page_key or 0)
        with (tmp_path / f"{contract}-{at}").open("a") as file:
            file.write("x")
        if contract == "b" and at == 9 and (tmp_path / "b-9").read_text() == "x":
            return 503, ""
        return 200, '{"nfts":[{"tokenId":"1"}]' + (f',"pageKey":"{at + 1}"}}' if at < (99 if contract == "a" else 11) else "}")

    staging, contracts = Staging(spark), ["a", "b"]
    marks, seen, landed = (staging.path(k) for k in ("marks", "seen", "pages"))
    spark.dataSource.register(paged_stream(fetch, "paged_growing"))
    batches = 0
    while Marks(marks).any_open(contracts) and batches < 8:
        read = spark.readStream.format("paged_growing").options(
            contracts=json.dumps(contracts), marks=marks, pages="2", growing="true"
        ).load()
        sink = read.writeStream.format("parquet").option("checkpointLocation", seen).trigger(availableNow=True)
        sink.start(landed).awaitTermination()
        batches += 1
    found = [r[:3] for r in rows(spark.read.schema(schemas.PAGES).parquet(landed))]
    assert found == sorted([("a", n, 200) for n in range(100)] + [("b", n, 200) for n in range(12)] + [("b", 9, 503)], key=repr)
    assert batches == 7 and {len(f.read_text()) for f in tmp_path.iterdir() if f.name != "b-9"} == {1}


@pytest.mark.parametrize(
    ("given", "meant"),
    [("file:/tmp/x", "file:///tmp/x"), ("file:///tmp/x", "file:///tmp/x"), ("s3a://b/x", "s3://b/x"), ("s3n://b/x", "s3://b/x")],
)
def test_names_of_folders(given, meant):
    from traitrank.sources.paged import pyarrow_uri

    assert pyarrow_uri(given) == meant
