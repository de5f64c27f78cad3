import json
import sys

import pytest
from comparing import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from traitrank import schemas
from traitrank.operators import ingest
from traitrank.sources.paged import LOOP, folder_fetch, land_documents, land_pages, page_chain, paged_source
from traitrank.sources.tables import read_pages, traits_from_columns
from traitrank.sources.staging import Staging

# The fetch function below runs in workers that do not have this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def documents(spark, bodies, status=200):
    data = [("1", "c", "0xA", str(i), status, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(
        data,
        "collection_id string, collection_name string, contract_address string, token_id string,"
        " http_status int, body string",
    )


def traits(spark, body):
    got = ingest.flatten_metadata(documents(spark, [body]))
    return rows(got.select("trait_type", "trait_value"))


def reason(spark, body, status=200):
    got = rows(ingest.rejected_documents(documents(spark, [body], status)).select("reject_reason"))
    return got[0][0] if got else None


@pytest.mark.parametrize(
    "body",
    [
        "{}",
        '{"raw": {}}',
        '{"raw": {"metadata": {}}}',
        '{"raw": {"metadata": {"attributes": []}}}',
        '{"raw": {"metadata": {"attributes": null}}}',
        '{"raw": {"metadata": {"attributes": 0}}}',
        '{"raw": {"metadata": {"attributes": {}}}}',
        '{"raw": {"metadata": {"attributes": ""}}}',
    ],
)
def test_document_without_attributes_keeps_one_row(spark, body):
    assert traits(spark, body) == [(None, None)]
    assert reason(spark, body) is None


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"raw": null}', "raw_not_an_object"),
        ('{"raw": "text"}', "raw_not_an_object"),
        ('{"raw": {"metadata": null}}', "metadata_not_an_object"),
        ('{"raw": {"metadata": "text"}}', "metadata_not_an_object"),
        ('{"raw": {"metadata": {"attributes": {"a": 1}}}}', "attributes_not_an_array"),
        ('{"raw": {"metadata": {"attributes": "abc"}}}', "attributes_not_an_array"),
        ('{"raw": {"metadata": {"attributes": [{"value": 1}, "{\\"value\\": 1}"]}}}', "attribute_not_an_object"),
        ('{"raw": {"metadata": {"attributes": [null]}}}', "attribute_not_an_object"),
        ("[1]", "not_an_object"),
        ('{"raw": {', "unparsable"),
        (None, "unparsable"),
    ],
)
def test_bad_documents_are_quarantined(spark, body, expected):
    assert traits(spark, body) == []
    assert reason(spark, body) == expected


def test_failed_response(spark):
    assert reason(spark, "{}", status=500) == "http_status"
    assert rows(ingest.flatten_metadata(documents(spark, ["{}"], status=500))) == []


def test_attributes_become_rows(spark):
    metadata = {
        "name": "Ape",
        "description": "",
        "image": 7,
        "attributes": [
            {"trait_type": "Hat", "value": "Red"},
            {"trait_type": "Hat", "value": "Red"},
            {"trait_type": 5, "value": 0},
            {"value": 1.0},
            {},
        ],
    }
    got = ingest.flatten_metadata(documents(spark, [json.dumps({"raw": {"metadata": metadata}})]))
    assert got.columns == schemas.METADATA.names
    assert rows(got.select("name", "description", "image_url").distinct()) == [("Ape", None, "7")]
    assert rows(got.select("trait_type", "trait_value")) == sorted(
        [("Hat", "Red"), ("Hat", "Red"), ("5", None), (None, "1.0"), (None, None)], key=repr
    )
    kept = got.select("attributes_json", "metadata_json").first()
    assert json.loads(kept["attributes_json"]) == metadata["attributes"]
    assert json.loads(kept["metadata_json"]) == metadata


def pages(spark, bodies, status=200):
    data = [("1", "c", "0xA", i, status, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(
        data,
        "collection_id string, collection_name string, contract_address string, page_no bigint,"
        " http_status int, body string",
    )


def test_listing_records(spark):
    records = [
        {"tokenId": "0x1f", "title": "t", "metadata": None, "raw": None, "image": "url"},
        {"tokenId": 7, "metadata": {"name": "n", "image": ""}, "raw": {"metadata": {"image": "r"}}},
        {"tokenId": 0},
        {"tokenId": "0", "image": {"cachedUrl": "i"}, "description": "d"},
        {"tokenId": "x"},
        "text",
        None,
    ]
    landed = pages(spark, [json.dumps({"nfts": records}), '{"nfts": []}', "{}", '{"nfts": 5}', "{", "[]"])
    listed = ingest.flatten_pages(landed).select("token_id", "name", "description", "image_url")
    assert rows(listed) == [("0", "", "d", "i"), ("31", "t", "", ""), ("7", "n", "", "r")]
    rejected = ingest.rejected_records(ingest.page_records(landed)).select("page_no", "record_no", "reject_reason")
    assert rows(rejected) == [
        (0, 2, "token_id"),
        (0, 4, "token_id"),
        (0, 5, "record_not_an_object"),
        (0, 6, "record_not_an_object"),
        (3, None, "tokens_not_an_array"),
        (4, None, "unparsable"),
        (5, None, "not_an_object"),
    ]


def test_failed_page(spark):
    landed = pages(spark, ['{"nfts": [{"tokenId": "1"}]}'], status=429)
    assert rows(ingest.flatten_pages(landed)) == []
    assert rows(ingest.rejected_records(ingest.page_records(landed)).select("reject_reason")) == [("http_status",)]


def test_first_listing_keeps_the_earliest(spark):
    one, two = ('{"nfts": [{"tokenId": "%s", "title": "%s"}, {"tokenId": "2"}]}' % p for p in (("1", "a"), ("0x1", "b")))
    got = ingest.first_listing(ingest.flatten_pages(pages(spark, [one, two])))
    assert rows(got.select("token_id", "name")) == [("1", "a"), ("2", "")]


def test_latest_document_prefers_good_responses(spark):
    landed = spark.createDataFrame(
        [
            ("0xA", "1", 1, 200, "first"),
            ("0xa", "1", 2, 200, "second"),
            ("0xA", "1", 3, 500, "failed"),
            ("0xA", "2", 1, 404, "none"),
        ],
        schemas.DOCUMENTS,
    )
    tokens = spark.createDataFrame(
        [("1", "c", "0xA", "1"), ("1", "c", "0xA", "2"), ("1", "c", "0xA", "3")],
        "collection_id string, collection_name string, contract_address string, token_id string",
    )
    got = ingest.wanted_documents(tokens, landed).select("token_id", "http_status", "body")
    assert rows(got) == [("1", 200, "second"), ("2", 404, "none")]


def test_join_documents(spark):
    base = spark.createDataFrame(
        [("1", "c", "0xA", t) for t in ("1", "1", "2", "3", "", None)] + [("2", "d", None, "1")],
        "collection_id string, collection_name string, contract_address string, token_id string",
    )
    landed = spark.createDataFrame(
        [("0xa", "1", 1, 200, "x"), ("0xA", "2", 1, 200, "y"), ("0xA", "", 1, 200, "z"), ("0xB", "3", 1, 200, "w")],
        schemas.DOCUMENTS,
    )
    got = ingest.join_documents(base, landed).select("contract_address", "token_id", "body")
    assert rows(got) == [("0xA", "1", "x"), ("0xA", "2", "y")]


def fetch(contract, page_key):
    """Three pages for a, a failing second page for b, nothing for others."""
    number = int(page_key or 0)
    if contract == "a" and number < 3:
        following = {"pageKey": str(number + 1)} if number < 2 else {}
        return 200, json.dumps({"nfts": [{"tokenId": str(number)}], **following})
    if contract == "b" and number == 0:
        return 200, json.dumps({"nfts": [{"tokenId": "9"}], "pageKey": "1"})
    return (429, "") if contract == "b" else (200, json.dumps({"nfts": [], "pageKey": "1"}))


def test_page_chain_ends():
    assert [r[1:3] for r in page_chain(fetch, "a")] == [(0, 200), (1, 200), (2, 200)]
    assert [r[1:3] for r in page_chain(fetch, "b")] == [(0, 200), (1, 429)]
    assert [r[1:3] for r in page_chain(fetch, "c")] == [(0, 200)]


def test_paged_source_and_land_pages_agree(spark):
    expected = sorted((r for c in "abc" for r in page_chain(fetch, c)), key=repr)
    source = paged_source(fetch, "fixture_listing")
    spark.dataSource.register(source)
    read = spark.read.format("fixture_listing").option("contracts", '["a", "b", "c", "a"]').load()
    assert read.schema == schemas.PAGES
    assert rows(read) == expected
    contracts = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "contract_address string")
    assert rows(land_pages(contracts, fetch)) == expected


def test_landed_pages_round_trip(spark):
    path = Staging(spark).path("pages")
    contracts = spark.createDataFrame([("a",)], "contract_address string")
    land_pages(contracts, fetch).write.json(path)
    assert rows(read_pages(spark, path)) == sorted(page_chain(fetch, "a"), key=repr)


def test_traits_from_columns(spark):
    df = spark.createDataFrame([(1, "x", None)], "id int, a string, b int")
    got = traits_from_columns(df, F.lit("c"), F.col("id"), {"a": F.col("a"), "b": F.col("b")})
    assert rows(got) == sorted([("c", "1", "a", "x"), ("c", "1", "b", None)], key=repr)


def attached(spark, bodies):
    data = [("1", "c", "0xA", i, 200, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(
        data, "collection_id string, collection_name string, contract_address string, page_no long, http_status int, body string"
    )


def test_no_size_of_a_body_costs_its_page(spark):
    long_text = "x" * 25_000_000
    mib = "y" * (1 << 20)
    bodies = spark.range(3).select(
        F.lit("1").alias("collection_id"), F.lit("c").alias("collection_name"), F.lit("0xA").alias("contract_address"),
        F.col("id").alias("page_no"), F.lit(200).alias("http_status"),
        F.when(F.col("id") == 0, F.concat(F.lit('{"nfts":[{"tokenId":"1","title":"'), F.repeat(F.lit("x"), F.lit(len(long_text))), F.lit('"},{"tokenId":"2"}]}')))
        .when(
            F.col("id") == 1,
            F.concat(F.lit('{"nfts":['), F.array_join(F.array_repeat(F.concat(F.lit('{"tokenId":"3","x":"'), F.repeat(F.lit("y"), F.lit(len(mib))), F.lit('"}')), 140), ","), F.lit("]}")),
        )
        .otherwise(F.lit('{"nfts":[{"tokenId":"4"}]}')).alias("body"),
    )
    records = ingest.page_records(bodies.repartition(3))
    found = records.groupBy("token_id", "reject_reason").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("name")).alias("name"))
    assert rows(found) == [("1", None, 1, 25_000_000), ("2", None, 1, 0), ("3", None, 140, 0), ("4", None, 1, 0)]


def test_the_last_of_repeated_keys_counts(spark):
    page = '{"nfts":[{"tokenId":"1","tokenId":"2","title":"a","title":"b"},"{\\"tokenId\\":\\"9\\"}"]}'
    got = ingest.page_records(attached(spark, [page])).select("token_id", "name", "reject_reason")
    assert rows(got) == [("2", "b", None), (None, "", "record_not_an_object")]
    body = '{"raw":{"metadata":{"name":"a","name":"b","attributes":[{"trait_type":"t","trait_type":"u","value":1}]}}}'
    assert traits(spark, body) == [("u", "1")]


def test_documents_are_chosen_without_their_bodies(spark):
    staging = Staging(spark)
    tokens = staging.write(
        spark.createDataFrame([("1", "c", "0xA", "1")], "collection_id string, collection_name string, contract_address string, token_id string"),
        "tokens",
    )
    landed = staging.write(spark.createDataFrame([("0xA", "1", 1, 200, "x")], schemas.DOCUMENTS), "landed")
    plan = ingest.wanted_documents(tokens, landed)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.split("\n") if "Aggregate" in line and "body" in line]


def test_ledger_tells_what_to_open(spark):
    schema = "collection_id string, page_no long, landed_no long, http_status int, body string"
    pages = [("1", 0, 1, 200, "a"), ("1", 1, 1, 500, ""), ("1", 1, 2, 200, "b"), ("1", 2, 1, 500, ""), ("1", 3, 3, 404, "")]
    ledger = [("1", "base", "0", 1, True), ("1", "base", "1", 1, False), ("1", "base", "2", 1, False)]
    got = ingest.wanted_pages(spark.createDataFrame(pages, schema), spark.createDataFrame(ledger, schemas.LEDGER))
    assert rows(got.select("page_no", "landed_no", "body")) == [(1, 2, "b"), (3, 3, "")]


def test_a_chain_that_turns_in_circles_ends_as_failed():
    def circle(contract, page_key):
        return 200, json.dumps({"nfts": [1], "pageKey": {None: "x", "x": "y", "y": "x"}[page_key]})

    assert [r[1:3] for r in page_chain(circle, "a")] == [(0, 200), (1, 200), (2, 200), (3, LOOP)]


def test_a_chain_goes_on_from_a_page(spark):
    starts = [("a", "2", 2), ("a", "1", 1), ("b", None, None)]
    contracts = spark.createDataFrame(starts, "contract_address string, page_key string, page_no long")
    got = [r[:3] for r in rows(land_pages(contracts, fetch))]
    assert got == [("a", 1, 200), ("a", 2, 200), ("b", 0, 200), ("b", 1, 429)]


def test_documents_land_on_executors(spark):
    def answer(contract, token):
        return (500, None) if token == "7" else (200, f"{contract}/{token}")

    tokens = spark.createDataFrame([("a", str(i % 150)) for i in range(200)], "contract_address string, token_id string")
    landed = land_documents(tokens.withColumn("body", F.lit(1)), answer, 4, tasks=3)
    assert landed.schema == schemas.DOCUMENTS
    got = rows(landed)
    assert len(got) == 150 and ("a", "7", 4, 500, None) in got and ("a", "8", 4, 200, "a/8") in got
    assert rows(land_documents(tokens.limit(0), answer, 4)) == []


def test_a_folder_is_read_whole_whatever_its_name(tmp_path, spark):
    name = "0x:1%/[b]"
    spark.createDataFrame([(name, 0, "{")], "contract_address string, page_no long, value string").write.partitionBy(
        "contract_address", "page_no"
    ).text(f"{tmp_path}/p")
    (folder,) = (tmp_path / "p").glob("*/page_no=0")
    (folder / "part-99999.txt").write_text("}\n")
    assert folder_fetch(f"{tmp_path}/p")(name, None) == (200, "{\n}")
    assert folder_fetch(f"{tmp_path}/p")(name, "1") == (404, "")


def test_whole_numbers_keep_all_digits(spark):
    """Numbers of any width beside strings, floats, nested values, repeated keys and odd members."""
    wide = 10**59 + 7
    values = [wide, -wide, 10**400, 10**37 + 1, 10**38 + 1, str(wide), 1.5, 1e60, True, None, 0]
    attributes = [{"trait_type": i, "value": v} for i, v in enumerate(values)]
    body = json.dumps({"raw": {"metadata": {"name": wide, "description": f"no {wide}", "attributes": attributes}}})
    got = rows(ingest.flatten_metadata(documents(spark, [body])).select("trait_value", "name", "description"))
    expected = [str(v) if v else None for v in values]
    assert [r[0] for r in got] == sorted(expected, key=lambda t: repr((t,))) and {r[1:] for r in got} == {(str(wide), f"no {wide}")}
    twice = '{"raw":{"metadata":{"attributes":[{"value":1,"trait_type":"a","value":%d},{},{"value":{"x":[1]}}]}}}' % wide
    got = ingest.flatten_metadata(documents(spark, [twice])).select("trait_type", "trait_value")
    assert rows(got) == sorted([("a", str(wide)), (None, None), (None, '{"x":[1]}')], key=repr)
    assert rows(ingest.rejected_documents(documents(spark, ['{"raw":{"metadata":%d}}' % wide])).select("reject_reason")) == [("metadata_not_an_object",)]
