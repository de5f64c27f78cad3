from pyspark.sql import functions as F

from comparing import compare
from traitrank.llm.queries import llm_oracles, llm_queries
from traitrank.llm.quotations import ORACLE, reply_order

THREAD = [
    (1, 0, "user", "First point, with words.\nSecond line.\n\nAnother paragraph"),
    (1, 1, "assistant", "Answer to all"),
    (1, 2, "user", "On Monday X wrote:\n> first POINT with words\n> second line\nI agree.\n>> nested unknown"),
    (1, 3, "assistant", "> > Another  paragraph!\n> I agree.\nDeeper"),
    (1, 5, "user", "> deeper\n>\n> Answer to all\nLate\n"),
    (1, 7, "user", "> Late\n> > Answer to all"),
    (2, 0, "user", "> Answer to all\nother talk"),
    (2, 4, "user", ""),
    (3, 9, None, "alone > not quoted\n >\tquoted"),
]


def test_query_equals_sql(spark, duck):
    df = llm_queries()["op3_quotations"](spark, "/root/testdata/sf0.001")
    assert compare(df, duck, llm_oracles()["op3_quotations"]) is None


def test_quotations_equal_sql(spark, tmp_path):
    import duckdb

    df = spark.createDataFrame(THREAD, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(1))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", THREAD)
    assert compare(reply_order(df), con, ORACLE) is None
    got = {(r.conv_id, r.turn): r for r in reply_order(df).collect()}
    assert got[1, 2].body == "I agree." and (got[1, 2].n_quoted, got[1, 2].n_linked, got[1, 2].reply_to) == (2, 1, 0)
    assert (got[1, 3].reply_to, got[1, 3].depth) == (2, 2) and got[1, 3].n_linked == 2
    assert got[1, 5].reply_to == 3 and got[1, 7].reply_to == 5
    assert got[2, 0].n_linked == 0 and got[2, 4].reply_to == 0 and got[3, 9].body == "alone > not quoted"


def test_odd_rows(spark):
    long = [(5, i, "user", f"> line {i - 1}\nline {i}" if i else "line 0") for i in range(70)]
    rows = long + [(None, 1, "user", "> x"), (6, None, "user", "y"), (7, 1, None, None), (5, 3, "user", "line 3")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = reply_order(df).collect()
    assert len(got) == len(rows)
    assert {(r.turn, r.depth, r.reply_to) for r in got if r.conv_id == 5} == {(i, i, i - 1 if i else None) for i in range(70)}
    assert [r.body for r in got if r.conv_id == 5 and r.turn == 69] == ["line 69"]
    odd = {(r.conv_id, r.turn): (r.body, r.n_quoted, r.depth, r.position) for r in got if r.conv_id != 5}
    assert odd == {(None, 1): ("", 1, None, None), (6, None): ("y", 0, None, None), (7, 1): (None, 0, 0, 1)}
    assert reply_order(df.limit(0)).collect() == []
