import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from traitrank.llm.queries import llm_queries
from traitrank.llm.warc import parse, read_archives, record, write_archives
from traitrank.sources.staging import Staging

BIG = "<p>" + "same text " * 20
ROWS = [
    (3, "http://a/\n x", BIG), (1, None, BIG), (2, "http://b", "short"), (4, "http://c", "short"), (5, "u", None), (6, "u", ""),
    (None, "n", BIG), (7, "ü", "ünï\r\n\r\nWARC/1.1\r\n" * 30), (7, "again", BIG), (-9, "v", "x" * 300_000), (8, "w", "x" * 300_000),
]


def written(spark, df, **settings):
    staging = Staging(spark)
    folder = staging.path("archive")
    manifest = write_archives(df, folder, staging, **settings)
    return manifest, folder


def expected(rows):
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        same = [k for k, _, h in rows if k is not None and (h or "").encode() == payload]
        first = min(same) if same else None
        refers = first if len(payload) >= 100 and key is not None and key > first else None
        out.append((key, len(payload), hashlib.sha256(payload).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def result(df):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_round_trip_of_odd_rows(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    manifest, folder = written(spark, df, shard_records=4, roll_bytes=500)
    back = read_archives(manifest, folder)
    assert result(back) == expected(ROWS)
    texts = {(r.page_id, r.payload_digest): r.payload for r in back.collect() if r.record_type == "response"}
    for key, url, html in ROWS:
        digest = hashlib.sha256((html or "").encode()).hexdigest()
        assert texts.get((key, digest), (html or "").encode()) == (html or "").encode()
    files = sorted(r.file for r in manifest.collect())
    assert len({f.split("-")[0] for f in files}) == 3 and len(files) > 3
    again, _ = written(spark, df.repartition(7), shard_records=4, roll_bytes=500)
    assert sorted(again.collect()) == sorted(manifest.collect())
    empty, folder = written(spark, df.limit(0))
    assert empty.collect() == [] and read_archives(empty, folder).collect() == []


def test_files_roll_and_are_plain_gzip(spark, tmp_path):
    rows = [(i, "http://x", f"{i} " * 2000) for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest, folder = written(spark, df, roll_bytes=5000)
    for r in manifest.collect():
        with open(f"{folder.removeprefix('file://')}/{r.file}", "rb") as file:
            data = file.read()
        assert len(data) == r.bytes <= 5000 and hashlib.sha256(data).hexdigest() == r.sha256
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == r.records


def test_damage_is_noticed():
    whole = record(1, "http://a", b"payload", None)
    assert parse(whole)["payload"] == b"payload"
    for broken in (whole.replace(b"payload\r\n", b"pAyload\r\n"), whole[:-5], whole + b"x"):
        with pytest.raises(ValueError):
            parse(broken)


def test_query(spark, given):
    rows = [(r.page_id, r.url, r.html) for r in given("pages")]
    assert result(llm_queries()["op7_warc"](spark, "/root/testdata/sf0.001")) == expected(rows)
