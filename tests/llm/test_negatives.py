"""Hard negatives against plain loops and SQL, the curve, the bounds, and hard tables."""

import math

import numpy as np
import pytest
from comparing import compare

from traitrank.llm import negatives
from traitrank.llm.queries import llm_oracles, op13_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(given, every=100):
    once = {}
    for i, v, c in given:
        if i is None or v is None or c is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = ((c + 1) % 10 if i % 7 == 0 else c, [math.floor(256 * x) for x in v])
        once[i] = min(once.get(i, row), row)
    out = []
    for a, (label, v) in once.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, c) for i, (c, w) in once.items() if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            window = [r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s]
            out += [(a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(window[:10], 1)]
    return sorted(out)


def result(spark, given, schema=SCHEMA, **options):
    return sorted(map(tuple, negatives.hard_negatives(spark.createDataFrame(given, schema), **options).collect()))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_given_vectors_against_sql(spark, sf):
    from comparing import connect

    folder = f"/root/testdata/sf{sf}"
    assert compare(op13_negatives(spark, folder), connect(folder), llm_oracles()["op13_negatives"]) is None


def test_hot_label_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    given = [(i, (centres[i % 6] + rng.normal(size=8) / 3).tolist(), 3 if i % 3 else int(i % 5)) for i in range(2500)]
    given += [(5000 + i, given[100][1], i % 4) for i in range(700)]  # copies, hence ties
    given += [(100, given[1][1], 0), (100, given[2][1], 0), (100, None, 1), (None, given[0][1], 1)]
    given += [(6000, None, 1), (6100, given[0][1], None), (6200, [math.nan] * 8, 1), (6300, [None] * 8, 1)]
    given += [(6400, [], 1), (6500, [math.inf] * 8, 1), (6600, [1.0, 2.0], 2), (6700, [0.0] * 8, 2)]
    given += [(6800, [1e5] * 8, 2), (6801, [2e5] * 8, 3), (6802, [3e5] * 8, 2), (-700, given[7][1], 2)]
    assert result(spark, given) == plain(given)


def test_blocks_smaller_than_a_window(spark):
    """Many zone groups and packs, so that thresholds of the first reading decide the second."""
    rng = np.random.default_rng(4)
    given = [(i, (rng.normal(size=5) + (i % 4)).tolist(), i % 3) for i in range(160)]
    assert result(spark, given, every=10, block=4, pack=3, zones_a_group=2) == plain(given, 10)


@pytest.mark.parametrize("given", [[], [(100, None, 1)], [(100, [0.5], 1)], [(100, [], 1), (1, [], 2)], [(100, [1.0], 1), (101, [1.0], 1), (102, [0.5], 2)]])
def test_tiny_tables_and_other_columns(spark, given):
    assert result(spark, [(*g, 5) for g in given], SCHEMA + ", rank int") == plain(given)


def test_curve_visits_neighbouring_cells():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        side = np.arange(1 << bits)
        cells = np.stack(np.meshgrid(*[side] * dims), axis=-1).reshape(-1, dims)
        order = np.argsort(np.array([int.from_bytes(k, "big") for k in negatives.hilbert_keys(cells, bits)]))
        steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_bounds_hold_every_product():
    rng = np.random.default_rng(6)
    for scale in (10, 1 << 26):
        anchors, rows = rng.integers(-scale, scale, (20, 9)), rng.integers(-scale, scale, (30, 9))
        least, most = negatives.bounds(anchors, rows.min(axis=0)[None], rows.max(axis=0)[None])
        products = anchors @ rows.T
        assert (least <= products).all() and (products <= most).all()
        assert (negatives._products(anchors, rows) == products).all()


def test_zone_maps_spare_blocks():
    """Vectors in tight groups: an anchor's best blocks are few."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16)) * 256
    rows = np.floor(centres[rng.integers(0, 40, 8000)] + rng.normal(size=(8000, 16)) * 8).astype(np.int64)
    mean, spread = rows.mean(axis=0), rows.std(axis=0)
    cells = np.clip(np.floor((rows - mean + 2 * spread) / (4 * spread) * 16), 0, 15).astype(np.uint8)
    keys = negatives.hilbert_keys(cells, negatives.BITS)
    rows = rows[sorted(range(len(rows)), key=keys.__getitem__)]
    parts = [rows[s : s + 100] for s in range(0, len(rows), 100)]
    least, most = negatives.bounds(rows[::80], np.stack([p.min(axis=0) for p in parts]), np.stack([p.max(axis=0) for p in parts]))
    tenth = np.sort(rows[::80] @ rows.T, axis=1)[:, -10]
    assert (most >= tenth[:, None]).mean() < 0.35
