"""Registry, writes, audit, reports, whole runs and streams on small tables."""

import json
from types import SimpleNamespace

import pytest
from comparing import rows
from pyspark.sql import functions as F

from traitrank import schemas
from traitrank.operators import audit, joins, ordering, registry, reports, upsert
from traitrank.plans.rarity_run import RarityRun
from traitrank.sources.staging import Staging, shared_folder
from traitrank.sources.tables import read_merged, read_table, use_namespace
from traitrank.streaming import incremental

RANKS = "token_id string, rarity_score int, rank int, collection_id string"
KEYS = schemas.TOKEN_KEYS


@pytest.fixture(params=["within bounds", "beyond bounds"])
def bounds(request, monkeypatch):
    if request.param == "beyond bounds":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(joins, "FILTER_VALUES", 0)
        monkeypatch.setattr(ordering, "WINDOW_ROWS", 0)


@pytest.fixture
def ranks(spark, database):
    table = f"{database}.ranks"
    upsert.create_table(spark, table, schemas.RARITY, schemas.PARTITION)
    old = [("1", 10, 1, "a"), ("2", 20, 2, "a"), ("1", 5, 1, "b"), ("7", 5, 2, "c")]
    upsert.append(spark.createDataFrame(old, RANKS), table, schemas.PARTITION)
    return table


def new_ranks(spark, data):
    return spark.createDataFrame(data, RANKS)


def files(spark, table, collection):
    df = spark.table(table).filter(F.col("collection_id") == collection)
    return {r[0] for r in df.select(F.input_file_name()).collect()}


def test_upsert(spark, ranks, bounds):
    source = new_ranks(spark, [("2", 99, 1, "a"), ("3", 30, 3, "a"), ("1", 6, 1, "d")])
    untouched = files(spark, ranks, "b")
    expected = sorted(
        [("1", 10, 1, "a"), ("2", 99, 1, "a"), ("3", 30, 3, "a"), ("1", 5, 1, "b"), ("7", 5, 2, "c"), ("1", 6, 1, "d")],
        key=repr,
    )
    for _ in range(2):
        upsert.merge_upsert(source, ranks, KEYS, schemas.PARTITION)
        assert rows(spark.table(ranks)) == expected
    assert files(spark, ranks, "b") == untouched
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.fixture
def bucketed(spark, database):
    table = f"{database}.bucketed"
    upsert.create_bucketed(spark, table, schemas.RARITY, schemas.PARTITION, "token_id", 4)
    old = [(str(i), i, i, "a") for i in range(40)] + [("1", 5, 1, "b"), ("7", 5, 2, "c"), ("7", 5, 3, "c")]
    upsert.append_bucketed(spark.createDataFrame(old, RANKS), table)
    return table


def test_upsert_into_buckets(spark, bucketed, bounds):
    before = rows(spark.table(bucketed))
    source = new_ranks(spark, [("2", None, None, "a"), ("300", 30, 3, "a"), ("1", 6, 1, "d"), ("8", 1, 1, "c")])
    untouched = files(spark, bucketed, "b")
    expected = sorted([r for r in before if (r[0], r[3]) != ("2", "a")] + [tuple(r) for r in source.collect()], key=repr)
    for _ in range(2):
        upsert.merge_upsert_bucketed(source, bucketed, KEYS, schemas.PARTITION)
        assert rows(spark.table(bucketed)) == expected
    assert files(spark, bucketed, "b") == untouched
    assert len(files(spark, bucketed, "a")) <= 4
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    assert spark.catalog.listTables(bucketed.split(".")[0])[0].name == "bucketed"
    with pytest.raises(ValueError, match="2 times"):
        upsert.merge_upsert_bucketed(source.union(source), bucketed, KEYS, schemas.PARTITION)
    upsert.merge_upsert_bucketed(source.limit(0), bucketed, KEYS, schemas.PARTITION)
    assert rows(spark.table(bucketed)) == expected


def test_a_table_in_buckets_is_not_shuffled(spark, bucketed, ranks):
    with upsert._settings(spark, upsert._BY_BUCKETS):
        target = spark.table(bucketed)
        source = new_ranks(spark, [("2", 99, 1, "a")]).repartition(3)
        plan = upsert.bucketed_merge(target, source, KEYS, target.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    with pytest.raises(ValueError, match="no buckets"):
        upsert.merge_upsert_bucketed(source, ranks, KEYS, schemas.PARTITION)


def test_upsert_rejects_repeated_keys(spark, ranks):
    before = rows(spark.table(ranks))
    with pytest.raises(ValueError, match="2 times"):
        upsert.merge_upsert(new_ranks(spark, [("2", 1, 1, "a"), ("2", 2, 1, "a")]), ranks, KEYS, schemas.PARTITION)
    assert rows(spark.table(ranks)) == before


def test_upsert_replacing_the_group(spark, ranks):
    upsert.merge_upsert(new_ranks(spark, [("3", 1, 1, "a")]), ranks, KEYS, schemas.PARTITION, replace_group=True)
    assert rows(spark.table(ranks)) == sorted([("3", 1, 1, "a"), ("1", 5, 1, "b"), ("7", 5, 2, "c")], key=repr)


def test_insert_missing(spark, ranks, bounds):
    source = new_ranks(spark, [("2", 99, 1, "a"), ("3", 30, 3, "a"), ("1", 6, 1, "d")])
    for _ in range(2):
        upsert.insert_missing(source, ranks, KEYS, schemas.PARTITION)
    assert rows(spark.table(ranks).filter("collection_id in ('a', 'd')")) == sorted(
        [("1", 10, 1, "a"), ("2", 20, 2, "a"), ("3", 30, 3, "a"), ("1", 6, 1, "d")], key=repr
    )


def test_update_writes_null_and_inserts_nothing(spark, database, bounds):
    table = f"{database}.registry"
    upsert.create_table(spark, table, schemas.REGISTRY)
    upsert.append(spark.createDataFrame([(1, "a", "x", "s"), (2, "b", "y", "s"), (3, "c", "z", "s")], schemas.REGISTRY), table)
    updates = spark.createDataFrame([("a", None), ("b", "t"), ("q", "t")], "collection_name string, status string")
    upsert.merge_update(updates, table, ["collection_name"], ["status"])
    assert rows(spark.table(table)) == [(1, "a", "x", None), (2, "b", "y", "t"), (3, "c", "z", "s")]


def test_append_evolves_the_schema(spark, ranks):
    upsert.append(spark.createDataFrame([("a", "8", 1.5)], "collection_id string, token_id string, extra double"), ranks)
    got = spark.table(ranks).filter("token_id in ('1', '8') and collection_id = 'a'")
    assert rows(got.select("token_id", "rank", "extra", "collection_id")) == [("1", 1, None, "a"), ("8", None, 1.5, "a")]
    # An upsert from a source without the new column leaves it NULL.
    upsert.merge_upsert(new_ranks(spark, [("8", 1, 1, "a")]), ranks, KEYS, schemas.PARTITION)
    assert rows(spark.table(ranks).filter("token_id = '8'").select("rank", "extra")) == [(1, None)]


def test_create_if_missing(spark, database):
    table = f"{database}.t"
    upsert.create_if_missing(new_ranks(spark, [("1", 1, 1, "a")]), table, schemas.PARTITION)
    upsert.create_if_missing(new_ranks(spark, [("2", 2, 2, "b")]), table, schemas.PARTITION)
    assert rows(spark.table(table)) == [("1", 1, 1, "a")]
    upsert.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


def test_collection_filter_prunes_partitions(spark, ranks):
    plan = read_table(spark, ranks, [1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(collection_id" in plan and "(collection_id" in plan
    assert "cast(collection_id" not in plan
    source = new_ranks(spark, [("2", 99, 1, "a")])
    plan = upsert.touched_rows(spark.table(ranks), source, KEYS, schemas.PARTITION)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(collection_id" in plan and "Join" not in plan


def test_register(spark, bounds):
    known = spark.createDataFrame([(4, "k", "0xAA", "FETCHED"), (2, "l", None, "FETCHED")], schemas.REGISTRY)
    incoming = spark.createDataFrame(
        [("0xCC", 1, "second"), ("0xcc", 0, "first"), ("0xaa", 2, "known"), ("0xBB", 3, "last")],
        "contract_address string, ordinal bigint, collection_name string",
    )
    got = registry.register_collections(known, incoming)
    assert got.schema.names == schemas.REGISTRY.names
    assert rows(got) == [(5, "first", "0xcc", "NOT_FETCHED"), (6, "last", "0xBB", "NOT_FETCHED")]
    empty = known.limit(0)
    assert [r[0] for r in rows(registry.register_collections(empty, incoming))] == [1, 2, 3]


def test_get_or_create_and_find(spark):
    known = spark.createDataFrame([(1, "a", "x", "s"), (2, "a", "y", "t"), (3, "b", "z", "u")], schemas.REGISTRY)
    names = spark.createDataFrame([("c", 2), ("a", 1), ("d", 0), ("c", 5)], "collection_name string, ordinal int")
    assert rows(registry.get_or_create(known, names).select("collection_name", "id", "created")) == [
        ("a", 1, False),
        ("c", 5, True),
        ("d", 4, True),
    ]
    found = registry.find(known, names.select("collection_name").distinct())
    assert rows(found) == [("a", 1, "x", "s"), ("c", None, None, None), ("d", None, None, None)]
    assert rows(registry.find_by_address(known, "Y").select("id")) == [(2,)]


def test_pending(spark):
    states = [None, schemas.NOT_FETCHED, schemas.FETCHING, schemas.FETCHED, schemas.METADATA_FETCHING, schemas.METADATA_FETCHED]
    known = spark.createDataFrame([(i, "n", "a", s) for i, s in enumerate(states)], schemas.REGISTRY)
    assert rows(registry.pending(known, "base").select("id")) == [(0,), (1,), (2,)]
    assert rows(registry.pending(known, "metadata").select("id")) == [(3,), (4,)]


def test_audit(spark):
    def tokens(*pairs):
        return spark.createDataFrame(pairs, "collection_id string, token_id string")

    base = tokens(("1", "a"), ("1", "a"), ("1", "b"), ("2", "a"))
    ranked = tokens(("1", "b"), ("1", "c"), ("3", "x"))
    assert rows(audit.only_in(base, ranked)) == [("1", "a"), ("2", "a")]
    assert rows(audit.only_in(ranked, base)) == [("1", "c"), ("3", "x")]
    summary = audit.audit_tokens(base, ranked, tokens(("1", "a")))
    assert summary.columns[1:] == ["n_base", "n_rarity", "n_missing", "n_extra", "n_without_metadata"]
    assert rows(summary) == [("1", 2, 2, 1, 1, 1), ("2", 1, 0, 1, 0, 1), ("3", 0, 1, 0, 1, 0)]
    assert rows(audit.token_counts(base=base, rarity=ranked)) == [("base", 4, 3), ("rarity", 3, 3)]


def test_counts_observed_while_writing(spark):
    base = spark.createDataFrame([("1", "1"), ("1", "1"), ("1", "2"), (None, "3"), (None, None)], "collection_id string, token_id string")
    counts, written = audit.observed_counts(Staging(spark), base=base, rarity=base.limit(0))
    assert rows(counts) == [("base", 5, 4), ("rarity", 0, 0)] == rows(audit.token_counts(base=base, rarity=base.limit(0)))
    assert rows(written["base"]) == sorted([("1", "1", 2), ("1", "2", 1), (None, "3", 1), (None, None, 1)], key=repr)


def test_reports(spark):
    data = [("1", str(t), s, r) for r, (t, s) in enumerate([(10, 0), (9, 1), (2**200, 5)], 1)]
    ranked = spark.createDataFrame(data + [("2", "5", 9, 1)], schemas.RARITY)
    assert [r["token_id"] for r in reports.top_common(ranked, 2).orderBy("position").collect()] == ["5", str(2**200)]
    assert rows(reports.top_rare(ranked, "1", 2).select("token_id")) == [("10",), ("9",)]
    numbers = reports.by_token_number(ranked.filter("collection_id = '1'")).collect()
    assert [r["token_id"] for r in numbers] == ["9", "10", str(2**200)]
    first = reports.first_by_token(ranked, "1", 2).orderBy("position").collect()
    assert [r["token_id"] for r in first] == ["10", str(2**200)]
    base = ranked.select("collection_id", "token_id", F.lit("0xA").alias("contract_address")).filter("collection_id = '1'")
    known = spark.createDataFrame([(1, "a", "0xA", None), (2, "b", "0xB2", None)], schemas.REGISTRY)
    report = reports.contract_report(known, base, base, ranked, "0XA")
    assert [r["rank"] for r in report["rarity"].collect()] == [1, 2, 3]
    assert rows(reports.of_contract(ranked, known, "0xB")) == []
    assert rows(reports.collection_report(base, base, ranked, ["2"])["rarity"]) == [("2", "5", 9, 1)]


CONTRACTS = [("0xAAAAAAAA01", 0), ("0xBBBBBBBB02", 1)]


def landed(spark):
    def page(number, tokens):
        return json.dumps({"nfts": [{"tokenId": t} for t in tokens], "pageKey": str(number)})

    def document(*values):
        attributes = [{"trait_type": "hat", "value": v} for v in values]
        return json.dumps({"raw": {"metadata": {"attributes": attributes}}})

    pages = [
        ("0xaaaaaaaa01", 0, 200, page(0, ["1", "2", "0x3"])),
        ("0xAAAAAAAA01", 1, 200, page(1, ["3", "4", "bad"])),
        ("0xBBBBBBBB02", 0, 500, ""),
        ("0xCCCCCCCC03", 0, 200, page(0, ["1"])),
    ]
    docs = [
        ("0xAAAAAAAA01", "1", 1, 200, document("red")),
        ("0xAAAAAAAA01", "2", 1, 200, document("red")),
        ("0xAAAAAAAA01", "3", 1, 200, document("blue")),
        ("0xAAAAAAAA01", "4", 1, 200, "broken"),
    ]
    return spark.createDataFrame(pages, schemas.PAGES), spark.createDataFrame(docs, schemas.DOCUMENTS)


RANKED = [("1", "1", 200, 3), ("1", "2", 200, 4), ("1", "3", 50, 2), ("1", "4", 0, 1)]


def test_everything_runs_twice(spark, database):
    run = RarityRun(spark, schemas.TableNames(prefix=database))
    pages, docs = landed(spark)
    contracts = spark.createDataFrame(CONTRACTS, "contract_address string, ordinal int")
    for _ in range(2):
        run.run(contracts, pages, docs)
        ranked = run.table("rarity").select(*schemas.RARITY.names)
        assert rows(ranked) == RANKED
        # The second contract had no good page and waits for the next run.
        assert rows(run.table("registry")) == [
            (1, "collection_0xaaaaaa", "0xAAAAAAAA01", "METADATA_FETCHED"),
            (2, "collection_0xbbbbbb", "0xBBBBBBBB02", "FETCHING"),
        ]
        assert rows(run.table("rejects").select("collection_id", "stage", "item", "reject_reason")) == [
            ("1", "base", "1/2", "token_id"),
            ("1", "metadata", "4", "unparsable"),
            ("2", "base", "0", "http_status"),
        ]
    assert run.table("base").count() == 4 and run.table("metadata").count() == 3
    run.reset()
    assert not spark.catalog.tableExists(f"{database}.nft_base_table")


def test_streams_pick_up_new_files_only(spark, database):
    run = RarityRun(spark, schemas.TableNames(prefix=database))
    run.create_tables()
    run.register(spark.createDataFrame(CONTRACTS, "contract_address string, ordinal int"))
    pages, docs = landed(spark)
    staging = Staging(spark)
    paths = {k: staging.path(k) for k in ("pages", "docs", "pages_seen", "docs_seen")}

    def drain():
        stream = incremental.file_stream(spark, paths["pages"], schemas.PAGES, files_per_batch=1)
        incremental.drain_pages(stream, run.names, paths["pages_seen"])
        stream = incremental.file_stream(spark, paths["docs"], schemas.DOCUMENTS, files_per_batch=1)
        incremental.drain_documents(stream, run.names, paths["docs_seen"])

    pages.filter("page_no = 0").coalesce(1).write.json(paths["pages"])
    docs.filter("token_id = '1'").coalesce(1).write.json(paths["docs"])
    drain()
    assert rows(run.table("base").select("token_id")) == [("1",), ("2",), ("3",)]
    assert rows(run.table("metadata").select("token_id")) == [("1",)]
    pages.coalesce(1).write.mode("append").json(paths["pages"])
    docs.repartition(2).write.mode("append").json(paths["docs"])
    drain()
    drain()
    assert rows(run.table("base").select("token_id")) == [("1",), ("2",), ("3",), ("4",)]
    assert rows(run.table("metadata").select("token_id")) == [("1",), ("2",), ("3",)]
    assert rows(run.table("rejects").select("stage", "item", "reject_reason")) == [
        ("base", "0", "http_status"),
        ("base", "1/2", "token_id"),
        ("metadata", "4", "unparsable"),
    ]
    run.rank()
    assert rows(run.table("rarity").select(*schemas.RARITY.names)) == RANKED


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert Staging(spark).folder.startswith(shared_folder(spark))


def test_a_cluster_must_name_its_shared_folder():
    def session(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_namespace(spark, database):
    before = spark.catalog.currentDatabase()
    use_namespace(spark, "spark_catalog", database)
    try:
        upsert.create_table(spark, "here", schemas.RARITY)
        assert spark.catalog.tableExists(f"{database}.here")
    finally:
        use_namespace(spark, database=before)


def test_newest_version_of_a_key_in_a_batch(spark, database):
    table = f"{database}.ranks"
    upsert.create_table(spark, table, schemas.RARITY, schemas.PARTITION)
    staging = Staging(spark)
    path = staging.path("versions")
    spark.createDataFrame([("1", "a", 5, 1), ("1", "a", 7, 2), ("1", "b", 1, 1)], schemas.RARITY).coalesce(1).write.json(path)
    stream = incremental.file_stream(spark, path, schemas.RARITY)
    incremental.drain_into(stream, table, schemas.TOKEN_KEYS, schemas.PARTITION, staging.path("seen"), newest_by="rank")
    assert rows(spark.table(table).select(*schemas.RARITY.names)) == [("1", "a", 7, 2), ("1", "b", 1, 1)]


def test_wide_updates_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1 << 20)
    updates = spark.range(200).select("id", F.repeat(F.lit("x"), F.lit(1 << 14)).alias("status"))
    target = spark.range(300).select("id", F.lit("old").alias("status"))
    plan = upsert.updated(target, updates, ["id"], ["status"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_merged_read_of_several_schemas(spark, tmp_path):
    """Other columns, spellings, types and partitions; a filter reaches every folder."""
    a, b, c = (str(tmp_path / n) for n in "abc")
    spark.createDataFrame([(1, "x", "p"), (2, None, "q")], "id int, name string, kind string").write.partitionBy("kind").parquet(a)
    spark.createDataFrame([(3_000_000_000, 7)], "ID long, name int").write.parquet(b)
    spark.createDataFrame([(2.5, True)], "id double, extra boolean").write.parquet(c)
    merged = read_merged(spark, [a, b, c])
    assert merged.dtypes == [("id", "double"), ("name", "string"), ("kind", "string"), ("extra", "boolean")]
    assert sorted(rows(merged), key=lambda r: r[0]) == [
        (1.0, "x", "p", None), (2.0, None, "q", None), (2.5, None, None, True), (3e9, "7", None, None)
    ]
    assert rows(read_merged(spark, [a]).filter("kind = 'q'")) == [(2, None, "q")]
    plan = merged.filter("kind = 'q' and extra is null").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and plan.count("FileScan") <= 1
    with pytest.raises(ValueError):
        read_merged(spark, [])


def test_sql_functions_on_tables(spark, database):
    from traitrank.plans import sql_functions

    run = RarityRun(spark, schemas.TableNames(prefix=database))
    run.create_tables()
    run.register(spark.createDataFrame([("0xAAAAAAAA01", 0), ("0xBBBBBBBB02", 1)], "contract_address string, ordinal int"))
    ranks = [("1", "7", 3, 1), ("1", "8", 4, 2), ("2", "7", 0, 1)]
    upsert.append(spark.createDataFrame(ranks, schemas.RARITY), run.names.full("rarity"), schemas.PARTITION)
    listed = spark.createDataFrame([(c, None, None, t, None, None, None) for c, t, *_ in ranks], schemas.BASE)
    upsert.append(listed, run.names.full("base"), schemas.PARTITION)
    sql_functions.install(spark, sql_functions.Relations.of(run.names))

    def asked(sql, **args):
        return rows(spark.sql(sql, args=args))

    assert asked("SELECT * FROM contract_rarity(:a)", a="0xaaaaaaaa01") == ranks[:2]
    assert asked("SELECT token_id FROM contract_base(:a)", a="0xBBBBBBBB02") == [("7",)]
    assert asked("SELECT * FROM contract_metadata(:a)", a="0xAAAAAAAA01") == []
    assert asked("SELECT * FROM contract_rarity(:a)", a="' OR true --") == asked("SELECT * FROM contract_rarity(NULL)") == []
    assert asked("SELECT id FROM pending_collections('base')") == [(1,), (2,)]
    assert asked("SELECT id FROM pending_collections('metadata')") == asked("SELECT id FROM pending_collections(NULL)") == []
    assert asked("SELECT * FROM pending_tokens('1')") == [("1", "7"), ("1", "8")]
    assert len(asked("SELECT * FROM pending_tokens(NULL)")) == 3
