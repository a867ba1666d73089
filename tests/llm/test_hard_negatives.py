import math
from collections import defaultdict

import numpy as np
import pytest

from cartwise.llm import hard_negatives as hn


def brute_force(rows, every, positives=5, negatives=5):
    """rows (vec_id, label, vector) -> {(anchor, positive): (score, [(negative, score), ...])}."""
    v = {}
    for i, label, e in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        row = (label, [math.floor(256 * x) for x in e])
        v[i] = min(v.get(i, row), row)
    out = {}
    for a, (label, q) in v.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, w)), i, other) for i, (other, w) in v.items() if i != a)
        for p_score, p, _ in [s for s in scored if s[2] == label][:positives]:
            p_score = -p_score
            found = [(i, -s) for s, i, other in scored
                     if other != label and 80 * p_score <= 100 * -s <= 100 * p_score][:negatives]
            if found:
                out[a, p] = (p_score, found)
    return out


def result(rows):
    out = defaultdict(lambda: (None, []))
    for r in sorted(rows, key=lambda r: (r.anchor_id, r.positive_id, r["rank"])):
        score, found = out[r.anchor_id, r.positive_id]
        assert r["rank"] == len(found) + 1 and score in (None, r.positive_score)
        out[r.anchor_id, r.positive_id] = (r.positive_score, found + [(r.negative_id, r.negative_score)])
    return dict(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr(
        "*", "1 AS score", "2 AS rank", "3 AS v", "4 AS block", "5 AS n", "6 AS `row`", "7 AS slice")


def clustered(n, size, seed=4, labels=3):
    """Vectors around a few centres, so that rows of other labels come near."""
    own = np.random.RandomState(seed)
    centres = own.normal(0, 0.3, (6, size))
    return [(i, int(own.randint(labels)), (centres[own.randint(6)] + own.normal(0, 0.08, size)).astype(np.float32).tolist())
            for i in range(n)]


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 3)
    monkeypatch.setattr(hn, "PART", 2)
    rows = clustered(300, 20)
    rows += [(300 + i, 2, rows[7][2]) for i in range(60)]  # a common vector: ties
    rows += [(400, 1, None), (420, None, [0.1] * 20), (430, 1, [None] * 20), (440, 1, [float("nan")] * 20),
             (441, 2, [float("inf")] * 20), (460, 0, [0.0] * 20), (480, 0, [0.5] * 9), (500, 1, []),
             (None, 1, rows[1][2]), rows[3], (10, 2, rows[3][2]), (20, 0, rows[20][2])]
    got = hn.mine(hn.quantised(table(spark, rows).repartition(3)), "vec_id % 10 = 0").collect()
    assert result(got) == brute_force(rows, 10)


def test_registered_query(spark, tmp_path):
    rows = clustered(900, 64, seed=1, labels=4)
    table(spark, rows).select("vec_id", "embedding", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, e) for i, label, e in rows]
    assert result(hn.op11_hard_negatives(spark, str(tmp_path)).collect()) == brute_force(moved, 100)


def test_no_rows_and_no_partners(spark):
    assert hn.mine(hn.quantised(table(spark, [])), "vec_id % 10 = 0").collect() == []
    alone = [(10, 1, [0.5, 1.0]), (11, 2, [0.5, 1.0])]
    assert hn.mine(hn.quantised(table(spark, alone)), "vec_id % 10 = 0").collect() == []


@pytest.mark.parametrize("size", [1, 16, 64, 100, 300])
def test_intervals_hold_the_scores(size):
    own = np.random.RandomState(size)
    data = own.randint(-256, 256, (500, size))
    data[:5] = 0
    anchors = own.randint(-256, 256, (20, size))
    anchors[:5] = data[10:15]
    code, aligned, length = hn.codes(data)
    low, high = hn.Planes(anchors, code.shape[1]).intervals(np.arange(20), code, aligned, length)
    exact = anchors @ data.T
    assert ((low <= exact) & (exact <= high)).all()
    # Not trivial: narrower than what the lengths alone allow.
    bound = length * np.sqrt((anchors ** 2).sum(1))[:, None]
    assert (high - low)[5:, 5:].mean() < 1.3 * bound[5:, 5:].mean()


def test_rotation_keeps_products():
    own = np.random.RandomState(0)
    a, b = own.randint(-99, 99, (2, 4, 70))
    assert np.allclose(hn.rotated(a) @ hn.rotated(b).T, a @ b.T) and hn.rotated(a).shape == (4, 128)


def test_codes_leave_few_to_score(monkeypatch):
    """Where vectors form groups, most rows of a block are ruled out by their codes."""
    rows = clustered(3000, 64, seed=2)
    ids, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    data = np.floor(256 * np.array([r[2] for r in rows])).astype(np.int64)
    code, aligned, length = hn.codes(data)
    block = {"ids": ids, "labels": labels, "data": data, "code": code, "aligned": aligned, "length": length}
    asked = hn.Anchors({"ids": ids[:30], "labels": labels[:30], "data": data[:30]}, 5, 1)
    scored = []
    plain = hn.Anchors.score
    monkeypatch.setattr(hn.Anchors, "score", lambda self, a, b, m: scored.append(len(m)) or plain(self, a, b, m))
    hn.meet_own_label(asked, block)
    assert sum(scored) < 30 * 1000 * 0.4
    scored.clear()
    own = asked.best[:, 0]
    asked = hn.Anchors({"ids": ids[:30], "labels": labels[:30], "data": data[:30], "partner_scores": own,
                        "partners": np.full(30, 5)}, 5, 5)
    hn.meet_other_labels(asked, block)
    hn.meet_other_labels(asked, {**block, "ids": ids + 10_000})
    assert sum(scored) < 30 * 4000 * 0.4


def test_scores_beyond_64_bits(spark):
    rows = [(10, 1, [1e15] * 4), (11, 1, [1e15] * 4), (12, 2, [1.0] * 4)]
    with pytest.raises(Exception, match="64 bits"):
        hn.mine(hn.quantised(table(spark, rows)), "vec_id % 10 = 0").collect()
