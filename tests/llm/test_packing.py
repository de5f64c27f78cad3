import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from traitrank.llm.packing import (
    _NOT_ALLOWED, AT_ONCE, B, COMMON, DENSE, K1, Encoder, Shard, Statistics, _heaviest, by_powers_of_two,
    default_tokenizer, encoder_of, fill, pack_by_retrieval,
)
from traitrank.llm.queries import llm_queries


@pytest.fixture(scope="module")
def exact():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers_library(exact, given):
    encoder, rng = Encoder(*default_tokenizer()), random.Random(3)
    texts = [r.text for r in given("documents")] + ["", " ", "a ", " a", "a\n b", "\n \n", "x \n  y", "it's  so", "日本 語 　 é"]
    texts += ["<|endoftext|> hi", "a<|endoftext|>", "<|endoftext|><|endoftext|>", " <|endoftext|>\n\n<|endoftext", "x\x1c \x1fy  z"]
    texts += ["".join(rng.choice(["a", "'s", " ", "\n", "\t", "é", "1", "_", " ", "!?"]) for _ in range(40)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == exact(text)


def verify(df, texts, exact, window=1024):
    """Every id once, gapless sequences, right checksums; gives the share of padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in df.collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for key, text in texts.items():
        ids, at = [*exact(text or ""), 0], 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = whole = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        whole += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / whole


def test_query_packs_everything(spark, given, exact):
    df = llm_queries()["op9_packing"](spark, "/root/testdata/sf0.001")
    assert verify(df, {r.doc_id: r.text for r in given("documents")}, exact) == 0


def test_odd_rows(spark, exact):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (None, "no id"), (4, "a" * 3000), (5, "  spaces   \n  "), (6, "<|endoftext|> hi")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    assert verify(pack_by_retrieval(df), dict(rows), exact) == 0
    assert verify(pack_by_retrieval(df, window=64, shard=2), dict(rows), exact, 64) == 0
    assert verify(pack_by_retrieval(df, common=None), dict(rows), exact) == 0
    assert pack_by_retrieval(df.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "same text")] * 2, "doc_id long, text string")
    assert sum(r.length for r in pack_by_retrieval(twice).collect()) == 2 * len([*exact("same text"), 0])


def some_pieces(seed, n=60):
    rng = np.random.default_rng(seed)
    return [(rng.zipf(1.3, rng.integers(1, 40)) % 500).astype("<u4") for _ in range(n)]


@pytest.mark.parametrize("common", [COMMON, None])
def test_neighbours_equal_plain_bm25(common):
    pieces = some_pieces(0)
    df = np.bincount(np.concatenate([np.unique(p) for p in pieces]), minlength=500)
    stats = Statistics(np.log(1 + (len(pieces) - df + 0.5) / (df + 0.5)), np.mean([len(p) for p in pieces]))
    shard = Shard(pieces, stats, common)
    shard.unused[[3, 5]] = False
    for seed in range(len(pieces)):
        score = {}
        for i, piece in enumerate(pieces):
            if shard.unused[i]:
                for t in set(pieces[seed].tolist()) & set(piece.tolist()):
                    if common is None or df[t] <= max(2, common * len(pieces)):
                        tf = (piece == t).sum()
                        part = stats.rarity[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(piece) / stats.mean_length))
                        score[i] = score.get(i, 0) + part
        got = shard.neighbours(seed).tolist()
        assert sorted(got) == sorted(score)
        assert all(score[a] >= score[b] - 1e-9 for a, b in zip(got, got[1:]))


def test_windows_are_filled_in_order_of_likeness():
    pieces = some_pieces(1)
    stats = Statistics(np.ones(500), 20.0)
    windows = list(fill(pieces, stats, 64))
    assert all(sum(e - s for _, s, e in w) == 64 for w in windows[:-1])
    used = [p for w in windows for p, s, _ in w if s == 0]
    assert sorted(used) == list(range(len(pieces)))
    cut = list(by_powers_of_two([(0, 0, 5), (1, 2, 8)]))
    assert [sum(e - s for _, s, e in part) for part in cut] == [8, 2, 1]


def test_terms_that_all_pieces_have_are_looked_up(spark):
    """Without being asked for: pieces that share nothing else are neighbours, in order of their scores."""
    pieces = [np.array([7] * n + [100 + n], "<u4") for n in range(1, 13)]
    stats = Statistics(np.ones(500), np.mean([len(p) for p in pieces]))
    weight = stats.weights(np.full(12, 7), np.arange(1, 13), np.arange(2, 14))
    for shard in (Shard(pieces, stats), Shard(pieces, stats, None)):
        shard.unused[0] = False
        assert shard.neighbours(0).tolist() == [i for i in np.argsort(-weight, kind="stable").tolist() if i]
    assert COMMON is None


def test_no_search_for_the_empty_string(exact):
    """tiktoken looks for its special tokens in every text, without any at every sign; the one given is no token."""
    assert encoder_of() is encoder_of(default_tokenizer())
    encoder = encoder_of()
    for bpe in (encoder.exact, encoder.fast):
        assert bpe.special_tokens_set == {_NOT_ALLOWED}
    wide = [f"a{c}{d}b {c}é" for c in "\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\t\r" for d in ("", " ", "\u2003")]
    for text in [_NOT_ALLOWED, f"a {_NOT_ALLOWED}<|endoftext|>  {_NOT_ALLOWED}\n\n", *wide]:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == exact(text)


def plain_order(pieces, stats, unused, seed):
    """Sums in the order of the terms, those of frequent terms by themselves."""
    has = np.bincount(np.concatenate([np.unique(p) for p in pieces]), minlength=500)
    rare, frequent = np.zeros(len(pieces)), np.zeros(len(pieces))
    for t in sorted(set(pieces[seed].tolist())):
        for i in np.flatnonzero(unused):
            if tf := (pieces[i] == t).sum():
                (frequent if has[t] > DENSE * len(pieces) else rare)[i] += stats.weights(t, tf, len(pieces[i]))
    score = rare + frequent
    return [int(i) for i in np.argsort(-score, kind="stable") if score[i] > 0]


def test_used_pieces_leave_the_index():
    """Scores and order stay those of all pieces, with copies and frequent terms among them."""
    pieces = some_pieces(2)
    pieces += [*pieces[:20], *pieces[:10], np.array([9] * 30, "<u4")]
    stats = Statistics(np.random.default_rng(3).uniform(0.1, 5, 500), 20.0)
    shard, order = Shard(pieces, stats), np.random.default_rng(4).permutation(len(pieces))
    postings = len(shard.owner)
    for used in range(0, len(pieces), 9):
        shard.unused[order[:used]] = False
        for seed in range(0, len(pieces), 7):
            expected = plain_order(pieces, stats, shard.unused, seed)
            assert list(shard.best_first(seed)) == shard.neighbours(seed).tolist() == expected
            if used == 0:
                assert len(expected) > AT_ONCE
    assert len(shard.left) < len(pieces) / 4 and len(shard.owner) < postings / 2


def test_heaviest_terms():
    pieces = [*some_pieces(5), np.array([3, 3], "<u4"), np.array([0], "<u4"), np.array([8, 7, 6], "<u4")]
    stats = Statistics(np.repeat(np.arange(1.0, 51), 10), 20.0)
    for piece, *got in zip(pieces, *(k.tolist() for k in _heaviest(pieces, stats))):
        terms, counts = np.unique(piece, return_counts=True)
        order = np.argsort(-stats.weights(terms, counts, len(piece)), kind="stable")[:2]
        assert got == [*terms[order].tolist(), -1][:2]
