import random

import numpy as np
import pytest

from traitrank.llm.components import _large_star, components, spanning_forest
from traitrank.operators import joins
from traitrank.sources.staging import Staging


@pytest.mark.parametrize("broadcast", [True, False])
def test_hubs_chains_loops_and_repeats(spark, monkeypatch, broadcast):
    """A hub of 300 nodes, a chain, random links, loops, repeats and nulls, with and beyond broadcasts."""
    if not broadcast:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    rng = random.Random(3)
    links = [(150, i) for i in range(300)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)] + [(5, 5), (3000, 3000)]
    rng.shuffle(links)
    label = spanning_forest(3001, *np.array(links).T)
    expected = {int(n): int(label[n]) for a, b in links if a != b for n in (a, b)}
    edges = spark.createDataFrame(links + links[:50] + [(None, 1), (2, None)], "a long, b long")
    got = components(edges, Staging(spark))
    assert {r.node: r.component for r in got.collect()} == expected and got.count() == len(expected)
    assert components(edges.limit(0), Staging(spark)).collect() == []


def test_rows_of_a_hub_are_not_shuffled_to_it(spark):
    edges = Staging(spark).write(spark.createDataFrame([(0, i) for i in range(1, 50)], "a long, b long"), "edges")
    plan = _large_star(edges, 49)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
