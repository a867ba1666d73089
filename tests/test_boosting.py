import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.operators import boosting, explain, metrics, modeling
from cartwise.operators.boosting import PRIME, Draws, Settings, Trees
from cartwise.schemas import FEATURE_COLUMNS

from test_modeling import customers  # noqa: F401

FEW = Settings(rounds=30, bins=16)


def plain_fit(values, labels, draws_of, edges, settings, keep):
    """The trees of one fit grown row by row: lists of {node: (feature, threshold, value, cover, gain)}."""
    unit = 2.0 ** 30
    base = np.log(labels[keep].sum() / (1 - labels[keep]).sum())
    margin, trees = np.full(len(labels), base), []
    drawn = Draws(settings, values.shape[1])
    for columns, a, b in drawn.rounds:
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - labels) * unit), np.rint(p * (1 - p) * unit)
        tree, leaf = {}, np.zeros(len(labels), int)

        def grow(node, rows, mine, depth):
            total_g, total_h = g[mine].sum() / unit, h[mine].sum() / unit
            found = (-1, 0.0, 0.0)
            for f in columns if depth else ():
                for edge in edges[f]:
                    left = mine & (values[:, f] <= edge)
                    gl, hl = g[left].sum() / unit, h[left].sum() / unit
                    gr, hr = (g[mine].sum() - g[left].sum()) / unit, (h[mine].sum() - h[left].sum()) / unit
                    if min(hl, hr) < settings.least_weight:
                        continue
                    gain = (gl ** 2 / (hl + settings.penalty) + gr ** 2 / (hr + settings.penalty)
                            - total_g ** 2 / (total_h + settings.penalty))
                    if gain > max(found[2], 1e-6):
                        found = (f, edge, gain)
            f, edge, gain = found
            tree[node] = (f, edge, -total_g / (total_h + settings.penalty) * settings.rate, total_h, gain)
            leaf[rows] = node
            if f >= 0:
                low = values[:, f] <= edge
                grow(2 * node + 1, rows & low, mine & low, depth - 1)
                grow(2 * node + 2, rows & ~low, mine & ~low, depth - 1)

        taken = (a * draws_of + b) % PRIME < drawn.below
        grow(0, np.ones(len(labels), bool), keep & taken, settings.depth)
        margin = margin + np.array([tree[n][2] for n in leaf])
        trees.append(tree)
    return trees, margin


@pytest.mark.parametrize("refresh,rows", [(25, 200), (4, 200), (25, 10_000)])
def test_same_trees_as_row_by_row(customers, monkeypatch, refresh, rows):  # noqa: F811
    """Level by level over several partitions, and a task for every fit."""
    monkeypatch.setattr(boosting, "REFRESH", refresh)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 70)
    monkeypatch.setattr(boosting, "ROWS_PER_PARTITION", rows)
    settings = Settings(rounds=9, bins=12, seed=3)
    train = modeling.with_folds(customers.where("customer_id < 500"), folds=2)
    models, blocks = boosting.fit(train.repartition(3), settings, fold_column="fold", folds=2)
    rows = train.withColumn("draw", boosting.row_number()).toPandas().sort_values("customer_id")
    values = rows[list(FEATURE_COLUMNS)].to_numpy(float)
    edges = boosting.quantile_edges(train, bins=settings.bins)
    got = {r.customer_id: r for r in boosting.out_of_fold(blocks, 3).collect()}
    assert len(got) == 500
    for i, model in enumerate(models):
        trees, margin = plain_fit(values, rows.churned.to_numpy(), rows.draw.to_numpy(), edges, settings,
                                  rows.fold.to_numpy() != i)
        for t, tree in enumerate(trees):
            assert model._reached(t) == sorted(tree, key=model._reached(t).index)
            for node, (f, edge, value, cover, gain) in tree.items():
                assert model.feature[t][node] == f
                if f >= 0:
                    assert model.threshold[t][node] == edge and model.gain[t][node] == pytest.approx(gain)
                assert model.value[t][node] == pytest.approx(value, abs=1e-15)
                assert model.cover[t][node] == pytest.approx(cover)
        assert np.allclose(model.margins(values), margin)
        for customer, fold, m in zip(rows.customer_id, rows.fold, margin):
            if fold == i:
                assert got[customer].churn_probability == pytest.approx(1 / (1 + np.exp(-m)))


def test_result_does_not_depend_on_partitions(customers, monkeypatch):  # noqa: F811
    few = Settings(rounds=6)
    one = boosting.fit(customers, few)[0][0]
    monkeypatch.setattr(boosting, "ROWS_PER_PARTITION", 100)
    many = boosting.fit(customers.repartition(7), few)[0][0]
    assert np.array_equal(one.feature, many.feature) and np.array_equal(one.value, many.value)


def test_no_worse_than_first_order_trees(customers):  # noqa: F811
    train, test = modeling.stratified_split(customers)
    own = boosting.fit(train, Settings(rounds=100))[0][0]
    other = modeling.boosted_trees(rounds=100).fit(modeling.as_doubles(train))
    ours, theirs = (metrics.roc_auc(modeling.with_probability(m, test)).first()[0]
                    for m in (own, other))
    assert ours >= theirs - 0.005 and ours > 0.9


def test_probability_saving_and_leaves(spark, customers, tmp_path):  # noqa: F811
    model = boosting.fit(customers, FEW)[0][0]
    modeling.save_model(model, str(tmp_path / "trees"))
    again = modeling.load_model(str(tmp_path / "trees"))
    assert isinstance(again, Trees) and again.settings == FEW
    assert modeling.parameters(again)["rounds"] == "30"
    scored = modeling.with_probability(again, customers)
    rows = scored.toPandas()
    values = rows[list(FEATURE_COLUMNS)].to_numpy(float)
    assert np.allclose(rows.churn_probability, 1 / (1 + np.exp(-model.margins(values))))
    # Exactly one leaf of every tree holds a row.
    leaves = model.leaves()
    total = np.zeros(len(values))
    for value, path in leaves:
        inside = np.ones(len(values), bool)
        for f, (low, high, _) in path.items():
            inside &= (values[:, f] > low) & (values[:, f] <= high)
        total += value * inside
    assert np.allclose(total + model.base, model.margins(values))
    phi = explain.tree_attribution(customers, explain.tree_leaves(model)).groupBy("customer_id").agg(
        F.sum("phi").alias("phi"))
    logit = F.log(F.col("churn_probability") / (1 - F.col("churn_probability")))
    gap = scored.join(phi, "customer_id").agg(
        F.max(F.abs(F.col("phi") + explain.expected_margin(leaves) + model.base - logit))).first()[0]
    assert gap < 1e-9


def test_missing_and_constant_features(customers):  # noqa: F811
    odd = customers.withColumns({"monetary": F.lit(1.0), "is_uk": F.lit(None).cast("double"),
                                 "frequency": F.when(F.col("customer_id") % 5 > 0, F.col("frequency").cast("double"))})
    model = boosting.fit(odd, Settings(rounds=5))[0][0]
    assert not np.isin(model.feature, [FEATURE_COLUMNS.index("monetary"), FEATURE_COLUMNS.index("is_uk")]).any()
    assert modeling.with_probability(model, odd).where("churn_probability between 0 and 1").count() == 900


def test_labels_of_one_kind_are_an_error(customers):  # noqa: F811
    with pytest.raises(ValueError, match="both labels"):
        boosting.fit(customers.where("churned = 1"), FEW)


def test_a_rank_that_makes_sense(customers):  # noqa: F811
    """A customer who buys often and lately is less likely to go than one who bought once, long ago."""
    model = boosting.fit(customers, Settings(rounds=60))[0][0]
    loyal = [10, 11, 3000, 270, 300, 30, 1, 0.5, 1]
    once = [280, 1, 60, 60, 290, 2, 0, 0.5, 1]
    low, high = model.margins(np.array([loyal, once], float))
    assert low < 0 < high


def test_some_partitions_need_no_job_for_every_level(customers, monkeypatch):  # noqa: F811
    few = Settings(rounds=6)
    one = boosting.fit(customers, few)[0][0]
    monkeypatch.setattr(boosting, "ROWS_PER_PARTITION", 300)
    monkeypatch.setattr(boosting, "SumsByJob", None)
    some = boosting.fit(customers.repartition(5), few)[0][0]
    assert np.array_equal(one.feature, some.feature) and np.array_equal(one.value, some.value)


def test_nodes_by_column_and_by_row_are_the_same(monkeypatch):
    own = np.random.RandomState(1)
    bins = own.randint(0, 64, (5, 400)).astype(np.uint8)
    feature, cut = own.randint(0, 5, 15), own.choice([3, 20, 40, 255], 15)
    by_column = [boosting._reach(bins, feature, cut, levels) for levels in range(4)]
    monkeypatch.setattr(boosting, "_BY_NODE", 0)
    for levels, at in enumerate(by_column):
        assert np.array_equal(at, boosting._reach(bins, feature, cut, levels))
