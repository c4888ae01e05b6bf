"""Large groups: frequent surroundings are picked by name, lists taken whole as columns."""

import numpy as np

from martlane.llm import impact, repeats
from martlane.llm.vectors import NO_FLOOR


def test_frequent_surroundings_do_not_reach_the_join(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FREQUENT", 3)
    rows = [(1, 10, t, t) for t in range(50)] + [(1, 11, t, t) for t in range(2)] + [(2, 10, 7, 7)] + [(3, 12, 1, 1)] * 2
    mixed = spark.createDataFrame(rows, "gram long, around long, tid long, place long")
    kinds = mixed.groupBy("gram", "around").count().withColumnRenamed("count", "n")
    got = repeats._met_again(mixed, kinds)
    assert sorted(tuple(r) for r in got.collect()) == sorted(r for r in rows if rows.count(r) > 1 or r[0] == 1)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "1:10" in plan and "1:11" not in plan and "3:12" not in plan    # only the large group is named


def test_lists_that_a_band_takes_are_added_as_columns(monkeypatch):
    rng = np.random.default_rng(5)
    n, dims, k = 3000, 24, 7
    vectors = np.floor(16 * rng.standard_normal((n, dims)))
    vectors[:, 3] = 5                                # a component that is the same everywhere
    queries = vectors[:40].copy()
    queries[:, 4] = 0
    counted, real = [], np.bincount
    monkeypatch.setattr(impact.np, "bincount", lambda x, *a: counted.append(len(x)) or real(x, *a))
    q, c, s = impact.search_block(queries, np.arange(40), vectors, np.arange(n), np.arange(n), k, np.full(40, NO_FLOOR))
    for i in range(40):
        scores = (vectors @ queries[i]).astype(int)
        want = sorted((-scores[j], j) for j in range(n) if j != i)[:k]
        assert [(-a, b) for a, b in zip(s[q == i], c[q == i])] == want
    assert sum(counted) < 40 * n * dims / 4          # postings added one by one
