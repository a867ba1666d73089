import math
from collections import defaultdict

import numpy as np
import pytest

from cartwise.llm import topk


def brute_force(rows, k):
    v = {i: [math.floor(64 * x) for x in e] for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = {}
    for q in v:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v[q], e)), i) for i, e in v.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS score", "2 AS rank", "3 AS v", "4 AS block")


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    own = np.random.RandomState(4)
    rows = [(i, own.normal(0, 0.2, 16).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(50)]  # a common vector: ties
    rows += [(400, None), (420, [None] * 16), (440, [float("nan")] * 16), (441, [float("inf")] * 16),
             (460, [0.0] * 16), (480, [0.5] * 9), (500, []), (None, rows[1][1]), rows[3]]
    table = topk.quantised(vectors(spark, rows).repartition(3))
    found = defaultdict(list)
    for r in sorted(topk.search(table.where("vec_id % 20 = 0"), table, 5).collect(),
                    key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(found[r.query_id]) + 1
        found[r.query_id].append((r.vec_id, r.score))
    assert dict(found) == brute_force(rows, 5)


def test_few_and_no_vectors(spark):
    table = topk.quantised(vectors(spark, [(20, [1.0, 0.5]), (3, [0.25, -1.0])]))
    got = topk.search(table.where("vec_id % 20 = 0"), table).collect()
    assert [tuple(r) for r in got] == [(20, 1, 3, 64 * 16 - 32 * 64)]
    none = topk.quantised(vectors(spark, []))
    assert topk.search(none, none).collect() == []


def test_postings_are_those_of_the_block():
    data = np.random.RandomState(1).randint(-4, 5, (50, 7))
    index = topk.indexed(np.arange(50), data)
    ends = [*index["starts"][1:], len(index["rows"])]
    again, impacts = np.zeros_like(data), []
    for a, b, value, dim in zip(index["starts"], ends, index["values"], index["dims"]):
        again[index["rows"][a:b], dim] += value
        impacts.append(abs(value))
    assert np.array_equal(again, data) and impacts == sorted(impacts, reverse=True) and 0 not in impacts


def test_index_stops_early_on_spread_out_scores(monkeypatch):
    own = np.random.RandomState(0)
    data = own.randint(-3, 4, (2000, 16))
    data[:30] += own.randint(20, 30, (30, 16))
    block = topk.indexed(np.arange(2000), data)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                read.append(at.stop - at.start)
            return np.ndarray.__getitem__(self, at)

    block["rows"] = block["rows"].view(Watched)
    queries = np.abs(own.randint(1, 9, (4, 16)))
    found = {r: (ids, scores) for r, ids, scores in topk.top(block, np.full(4, -1), queries, 20, np.full(4, -np.inf))}
    for q in range(4):
        exact = data @ queries[q]
        want = np.lexsort((np.arange(2000), -exact))[:20]
        assert found[q][0].tolist() == want.tolist() and found[q][1].tolist() == exact[want].tolist()
    assert sum(read) < 0.1 * np.count_nonzero(data)


def test_large_components(spark):
    rows = [(20, [2.0 ** 25, 3.0]), (3, [2.0 ** 25, 1.0]), (4, [2.0 ** 25, 2.0]), (5, [-1.0, 0.0])]
    table = topk.quantised(vectors(spark, rows))
    got = topk.search(table.where("vec_id % 20 = 0"), table, 2).orderBy("rank").collect()
    big = (64 * 2 ** 25) ** 2
    assert topk._EXACT < big < 1 << 63
    assert [(r.vec_id, r.score) for r in got] == [(4, big + 64 * 64 * 6), (3, big + 64 * 64 * 3)]
    beyond = topk.quantised(vectors(spark, [(20, [1e8] * 8), (3, [1e8] * 8)]))
    with pytest.raises(Exception, match="64 bits"):
        topk.search(beyond.where("vec_id % 20 = 0"), beyond).collect()
