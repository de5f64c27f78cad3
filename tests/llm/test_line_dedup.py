from pyspark.sql import functions as F

from comparing import compare, connect
from traitrank.llm.line_dedup import drop_boilerplate, html_text, url_host
from traitrank.llm.queries import llm_oracles, llm_queries


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    df = llm_queries()["op4_site_lines"](spark, sf_dir)
    assert compare(df, connect(sf_dir), llm_oracles()["op4_site_lines"]) is None


def test_lines_above_the_ratio_go(spark):
    rows = [(i, "h", f"own {i}\n menu \nmenu\n\nrare" if i < 2 else f"own {i}\nmenu") for i in range(20)]
    rows += [(50, None, "menu"), (51, "h", None), (52, "h", ""), (53, "small", "menu\nmenu"), (0, "h", "own 0")]
    df = spark.createDataFrame(rows, "id long, host string, text string").withColumn("n_lines", F.lit("x"))
    out = drop_boilerplate(df, text="text", host="host", counts=("a", "b"))
    assert out.columns == [*df.columns, "a", "b"]
    got = [(r.id, r.text, r.a, r.b) for r in out.collect()]
    assert (1, "own 1\n\nrare", 4, 2) in got and (19, "own 19", 2, 1) in got
    assert {g for g in got if g[0] >= 50} == {
        (50, "menu", 1, 0), (51, None, 0, 0), (52, "", 0, 0), (53, "menu\nmenu", 2, 0)
    }
    assert len(got) == len(rows)
    assert drop_boilerplate(df.limit(0), text="text", host="host").collect() == []


def test_salted_lookup_gives_the_same(spark, monkeypatch):
    from traitrank.llm import line_dedup

    df = spark.createDataFrame([(i, "h", f"own {i}\nmenu") for i in range(30)], "id long, host string, text string")
    monkeypatch.setattr(line_dedup, "SMALL_BYTES", 0)
    assert {r.text for r in drop_boilerplate(df, text="text", host="host").collect()} == {f"own {i}" for i in range(30)}


def test_html_and_host(spark):
    row = spark.sql("SELECT 1").select(
        html_text(F.lit("<head><title>t</title></head><p class='x'>a <b>b</b><br/>c<!-- <p>no -->d<script>x</script></p>")).alias("t"),
        *[url_host(F.lit(u)).alias(n) for n, u in (("a", "HTTP://u:p@Ex.org:8/x"), ("b", "no url"), ("c", None))],
    ).first()
    assert row.t.split("\n") == ["", "a b", "cd", ""]
    assert (row.a, row.b, row.c) == ("ex.org", None, None)
