import hashlib
import random

import pytest
import regex
from pyspark.sql import functions as F

from traitrank.llm import fingerprints
from traitrank.llm.fingerprints import COMMON_WORDS, alike_pairs, compare_with_neighbours
from traitrank.llm.queries import llm_queries


def slow_signatures(text, chain=2):
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    common = set(COMMON_WORDS)
    at = [i for i, w in enumerate(words) if w in common]
    if not at:
        return {tuple(words[i : i + 1 + chain]) for i in range(len(words))}
    return {(words[i], *[w for w in words[i + 1 :] if w not in common][:chain]) for i in at}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """doc_id -> what the comparison with the next text in descending order gives."""
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (key, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        sigs = [slow_signatures(t) for t in (text, edited, following)]
        out[key] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(),
            pytest.approx(jaccard(sigs[0], sigs[1])), pytest.approx(jaccard(sigs[0], sigs[2])),
        )
    return out


def shown(df):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in df.collect()}


def near_copies():
    """Twelve texts in five versions each, two of the texts without a rare word."""
    rng = random.Random(5)
    pools = [[f"w{rng.randint(0, 300)}" for _ in range(400)]] * 10 + [["red", "hat"]] * 2
    base = [[rng.choice(["the", "of", rng.choice(p)]) for _ in range(rng.choice([9, 60, 200]))] for p in pools]
    rows = []
    for words in base:
        for _ in range(5):
            changed = list(words)
            for _ in range(rng.randint(0, 2)):
                changed[rng.randrange(len(changed))] = f"new{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(changed)))
    return rows


def check_pairs(df, rows):
    """Pairs and classes are those of comparing all with all."""
    pairs, members = alike_pairs(df)
    of = {r.doc_id: r.class_id for r in members.collect()}
    sigs = {i: slow_signatures(t) for i, t in rows if i is not None and t}
    assert of == {i: min(j for j in sigs if sigs[j] == sigs[i]) for i in sigs}
    wanted = {(i, j) for i in set(of.values()) for j in set(of.values()) if i < j and jaccard(sigs[i], sigs[j]) >= 0.8}
    assert {(r.a, r.b) for r in pairs.collect()} == wanted and wanted


def test_hot_sets_and_signatures(spark, monkeypatch):
    """A third of all texts are copies, a passage is in all of them, blocks are small."""
    monkeypatch.setattr(fingerprints, "_MEETING", 4)
    monkeypatch.setattr(fingerprints, "_SALTS", 3)
    shared = " the red hat of blue shoes"
    rows = [(i, t + shared) for i, t in near_copies()] + [(1000 + i, "the one and same old text") for i in range(30)]
    rows += [(2000, shared), (2001, None), (2002, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit(3)).withColumn("set", F.lit(3))
    check_pairs(df, rows)


def test_query_equals_brute_force(spark, given):
    rows = [(r.doc_id, r.text) for r in given("documents")]
    df = llm_queries()["op1_spotsigs"](spark, "/root/testdata/sf0.001")
    assert shown(df) == expected(rows)
    prints = {}
    for r in df.collect():
        prints.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_odd_rows(spark):
    rows = [(9, None), (-4, ""), (7, "𝔘nicode the ünï x" * 50), (1 << 60, "the " * 5000), (3, "!!! ???"), (5, "no spots here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("next_text", F.lit(1))
    assert shown(compare_with_neighbours(df)) == expected(rows)
    assert shown(compare_with_neighbours(df.filter("doc_id = 5"))) == expected([(5, "no spots here")])
    assert compare_with_neighbours(df.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "the a b c"), (1, "the a b c"), (None, "the x")], "doc_id long, text string")
    assert sorted((r.doc_id or -1) for r in compare_with_neighbours(twice).collect()) == [-1, 1, 1]


def test_pairs_equal_all_pairs(spark):
    rows = near_copies()
    rows += [(900, None), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_pairs(df, rows)
