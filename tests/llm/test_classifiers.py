import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from traitrank.llm import quality, toxicity
from traitrank.llm.queries import llm_queries

SF_DIR = "/root/testdata/sf0.01"


def auc(scores, labels):
    rank = np.empty(len(scores))
    rank[np.argsort(scores)] = np.arange(len(scores))
    n1 = labels.sum()
    return (rank[labels == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(labels) - n1))


@pytest.mark.parametrize(
    "name, label, modulus, rest, least", [("op2_toxicity", "toxic", 5, 0, 0.8), ("op10_quality", "quality", 3, 1, 0.95)]
)
def test_held_out_documents(spark, name, label, modulus, rest, least):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    truth = {r.doc_id: r[label] for r in labels.collect()}
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    got = llm_queries()[name](spark, SF_DIR).collect()
    assert len(got) == len({r.doc_id for r in got}) == n
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert auc(np.array([r.score for r in held]), np.array([truth[r.doc_id] for r in held])) > least


@pytest.fixture
def few(spark):
    rows = [(i, f"the bad{i % 3} word is here {i}" if i % 2 else f"the fine word is here {i}", i % 2) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").withColumn("label", F.lit("x"))
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(1, 1), (None, 1), (2, None), (3, 7)], "doc_id long, y int"
    )
    return docs, labels


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_texts_and_tables(spark, few, module):
    docs, labels = few
    score = module.toxicity_score if module is toxicity else module.quality_score
    model = module.train(docs, labels, label="y")
    odd = spark.createDataFrame([(None,), ("",), ("?! …",), ("the bad1 word " * 30_000,), ("the bad1 word",)], "text string")
    found = [r[0] for r in odd.coalesce(1).select(score(spark, model, F.col("text"))).collect()]
    assert all(0 <= x <= 1 for x in found) and found[0] == found[1] and found[4] > 0.5
    assert odd.limit(0).select(score(spark, model, F.col("text"))).collect() == []
    again = module.train(docs.repartition(7), labels.repartition(3), label="y")
    assert [r[0] for r in odd.coalesce(1).select(score(spark, again, F.col("text"))).collect()] == found
    blank = module.train(docs, labels.limit(0), label="y")
    assert {r[0] for r in odd.select(score(spark, blank, F.col("text"))).collect()} == {0.5}


def test_pooling_in_stretches_equals_whole(monkeypatch):
    rng = np.random.default_rng(0)
    model = toxicity.Model.new()
    padded = toxicity._padded(rng.normal(size=(500, toxicity.DIMS)).astype(np.float32))
    whole = model.pooled(padded)
    monkeypatch.setattr(toxicity, "_AT_ONCE", 17)
    assert np.allclose(model.pooled(padded), whole)


def test_texts_side_by_side_pool_like_one_by_one():
    model = toxicity.Model.new()
    texts = [[], [b"a"], [b"the", b"word", b"and"] * 40, [], [b"und", b"kein" * 20], []]
    pooled, votes = model.pooled_texts(texts)
    for words, row, vote in zip(texts, pooled, votes):
        rows, told = toxicity.hashed(words)
        assert np.allclose(model.pooled(toxicity._padded(model.table[rows].mean(axis=1))), row, atol=1e-5)
        assert (told.sum(axis=0) == vote).all()


def test_long_texts_in_stretches_score_alike(monkeypatch):
    import pyarrow as pa

    model = toxicity.Model.new()
    batch = pa.array(["the und le " * 30 + "x", None, "one", " ".join(f"w{i}" for i in range(77))])

    def pooled():
        maxima, told = {}, {}
        for places, texts in toxicity._blocks(batch):
            for n, row, vote in zip(places, *model.pooled_texts(texts, toxicity._AT_ONCE)):
                maxima[n] = np.maximum(maxima.get(n, 0), row)
                told[n] = told.get(n, 0) + vote
        return maxima, told

    whole, votes = pooled()
    monkeypatch.setattr(toxicity, "_AT_ONCE", 13)
    again, counted = pooled()
    assert all(np.allclose(whole[n], again[n], atol=1e-5) and (votes[n] == counted[n]).all() for n in range(4))


def test_votes_equal_plain_loop():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(80, 6)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    labels = rng.integers(0, 2, 60).astype(float)
    model = quality.Model(np.zeros((1, 6)), unit[:60], labels)
    for row, got in zip(unit[60:], model.vote(unit[60:])):
        near = np.argsort(-(unit[:60] @ row))[: quality.NEIGHBOURS]
        weight = np.maximum((unit[:60] @ row)[near].astype(float), 0) ** quality.SHARPNESS
        assert got == pytest.approx((weight * labels[near]).sum() / weight.sum(), rel=1e-4)


def test_words_are_hashed_whole(monkeypatch):
    mixed = (1 << 64) - 1

    def plain(word):
        total = 0
        for at, sign in enumerate(word, 1):
            z = at * 0x9E3779B97F4A7C15 & mixed
            z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & mixed
            total += sign * ((z ^ z >> 27) | 1)
        return total & mixed

    words = [b"a", b"x" * 24 + b"1", b"x" * 24 + b"2", b"q" * 999 + b"1", b"q" * 999 + b"2", "漢字".encode() * 50, b"the"]
    expected = [plain(w) for w in words]
    assert toxicity._whole_sums(words).tolist() == expected and len(set(expected)) == len(words)
    rows = toxicity.hashed(words)[0]
    assert (rows[1] != rows[2]).any() and (rows[3] != rows[4]).any()
    monkeypatch.setattr(toxicity, "_HASHED", 7)
    assert toxicity._whole_sums(words).tolist() == expected


def test_scores_equal_a_plain_convolution(spark, few):
    """Word by word, position by position, filter by filter."""
    docs, labels = few
    model = toxicity.train(docs, labels, label="y")

    def plain(text):
        words = toxicity.words_of(text.encode())
        best = np.zeros(len(toxicity.WIDTHS) * toxicity.FILTERS)
        votes = np.array([sum(w.decode() in listed.split() for w in words) for listed in toxicity.LANGUAGES.values()])
        embedded = [model.table[toxicity.hashed([w])[0][0]].mean(axis=0) for w in words] + [np.zeros(toxicity.DIMS)] * 2
        for k, width in enumerate(toxicity.WIDTHS):
            for at in range(len(words)):
                seen = np.concatenate(embedded[at : at + width])
                for f in range(toxicity.FILTERS):
                    value = seen @ model.filters[k][:, f] + model.biases[k][f]
                    best[k * toxicity.FILTERS + f] = max(best[k * toxicity.FILTERS + f], value)
        told = int(votes.argmax()) if votes.any() else len(toxicity.LANGUAGES)
        return 1 / (1 + np.exp(-(best @ model.out + model.out_bias[0] - model.shifts[told])))

    texts = ["the bad1 word is here", "", "fine und nicht die " + "z" * 40, "bad2 " * 9]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [r[0] for r in df.select(toxicity.toxicity_score(spark, model, F.col("text"))).collect()]
    assert got == pytest.approx([plain(t) for t in texts], abs=1e-4)


def test_training_texts_are_bounded_by_bytes(spark, few):
    docs, labels = few
    long = docs.withColumn("text", F.when(F.col("doc_id") == 5, F.repeat("text", 10_000)).otherwise(F.col("text")))
    without = toxicity.train(docs.filter("doc_id <> 5"), labels, label="y", most_bytes=50_000)
    bounded = toxicity.train(long, labels, label="y", most_bytes=50_000)
    assert all((a == b).all() for a, b in zip(bounded.weights(), without.weights()))


def test_sample_takes_the_lowest_hashes(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    got = {(r.doc_id, r.y) for r in quality.labelled_sample(labels, "doc_id", "y", 50).collect()}
    ordered = labels.withColumn("h", F.xxhash64("doc_id")).orderBy("h").collect()
    assert got == {(r.doc_id, r.y) for y in (0, 1) for r in [r for r in ordered if r.y == y][:50]}
    assert quality.labelled_sample(labels, "doc_id", "y", 30_000).count() == 20_000
