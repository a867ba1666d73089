import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler

from cartwise.operators import clustering

COLUMNS = ("a", "b", "c")


def points(spark, rows):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(rows)],
                                 "customer_id long, a double, b double, c double")


def groups(n, seed=0, centres=5, spread=0.3):
    own = np.random.RandomState(seed)
    middle = own.normal(0, 2, (centres, 3))
    return middle[own.randint(centres, size=n)] + own.normal(0, spread, (n, 3))


def brute_silhouette(x, labels):
    distance = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    out = []
    for i, own in enumerate(labels):
        mean = {c: distance[i, labels == c].sum() / max((labels == c).sum() - (c == own), 1) for c in set(labels)}
        a, b = mean.pop(own), min(mean.values(), default=np.inf)
        alone = (labels == own).sum() == 1 or not np.isfinite(b) or max(a, b) == 0
        out.append(0.0 if alone else (b - a) / max(a, b))
    return np.mean(out)


def own_labels(x, centres):
    return ((x[:, None] - centres) ** 2).sum(-1).argmin(1)


def test_step_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 64)
    x = groups(500)
    blocks, n = clustering.blocks_of(points(spark, x).repartition(3), COLUMNS)
    assert n == 500
    runs = [x[:2], x[5:9], np.vstack([x[10:12], [[99.0] * 3]])]
    for centres, (sizes, moved, cost) in zip(runs, clustering.step(blocks, runs)):
        own = own_labels(x, centres)
        assert sizes.tolist() == np.bincount(own, minlength=len(centres)).tolist()
        want = [x[own == i].mean(0) if (own == i).any() else centres[i] for i in range(len(centres))]
        assert np.allclose(moved, want, atol=1e-6)
        assert cost == pytest.approx(((x - centres[own]) ** 2).sum(), rel=1e-5)


def test_as_good_as_the_best_of_single_fits(spark):
    df = points(spark, groups(800, seed=3, centres=6, spread=0.7))
    models, _ = clustering.fit(df, range(2, 7), COLUMNS, n_init=8)
    vectors = VectorAssembler(inputCols=list(COLUMNS), outputCol="features").transform(df).persist()
    for k in range(2, 7):
        single = min(KMeans(k=k, seed=i, maxIter=100).fit(vectors).summary.trainingCost for i in range(8))
        assert models[k].cost <= single * 1.005
        labelled = models[k].transform(df).toPandas()
        assert labelled.cluster.tolist() == own_labels(labelled[list(COLUMNS)].to_numpy(), models[k].centres).tolist()


def test_same_result_whatever_the_partitions(spark, monkeypatch):
    df = points(spark, groups(300, seed=5))
    one = clustering.fit(df, [3, 4], COLUMNS, n_init=3)[0]
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 50)
    monkeypatch.setattr(clustering, "ROWS_PER_PARTITION", 100)
    two = clustering.fit(df.repartition(5), [3, 4], COLUMNS, n_init=3)[0]
    assert all(np.array_equal(one[k].centres, two[k].centres) for k in one)


def test_fewer_points_than_clusters_and_none(spark):
    df = points(spark, [[0, 0, 0]] * 4 + [[1, 1, 1]])
    model = clustering.fit(df, [3], COLUMNS, n_init=2)[0][3]
    assert model.cost == 0 and len(model.centres) == 3
    with pytest.raises(ValueError):
        clustering.fit(points(spark, []), [2], COLUMNS)


@pytest.mark.parametrize("leaves,tolerance", [(4096, 0.002), (64, 0.002), (300, 0.05), (1, 1.0)])
def test_silhouette_is_within_its_error(spark, monkeypatch, leaves, tolerance):
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 200)
    x = np.vstack([groups(700, seed=2), [[40.0, 0, 0]], np.repeat(groups(3, seed=9), 40, 0)])
    df = points(spark, x)
    blocks, _ = clustering.blocks_of(df, COLUMNS)
    runs = [x[:2], x[3:8], np.vstack([x[20:22], [[40.0, 0, 0]]]), np.vstack([x[:2], [[999.0] * 3]])]
    found = clustering.silhouettes(df, blocks, runs, COLUMNS, leaves, tolerance)
    for centres, (value, error) in zip(runs, found):
        exact = brute_silhouette(x, own_labels(x, centres))
        assert abs(value - exact) <= error
        if leaves == 4096:
            assert error < 0.003


def test_silhouette_sums_fewer_cells_than_rows():
    x = groups(6000, seed=1)
    edges = [np.quantile(x[:, i], np.arange(1, 64) / 64) for i in range(3)]
    codes, counts = np.unique(clustering.grid_codes(x, edges), return_counts=True)
    cells = np.column_stack(np.unravel_index(codes, (64,) * 3))
    tree = clustering.Tree(edges, cells, counts, 512)
    leaf = tree.leaves(x)
    assert len(np.unique(leaf)) <= 512 and (tree.children[np.unique(leaf)] == -1).all()
    sums = {int(n): np.array([(leaf == n).sum(), *clustering._units((x[leaf == n] - tree.origin[n]).sum(0)),
                              clustering._units(((x[leaf == n] - tree.origin[n]) ** 2).sum())]) for n in np.unique(leaf)}
    moments = clustering.Moments(tree, sums, 1, 3, 1)
    assert moments.n[0, 0] == 6000 and np.allclose(moments.centre[0], x.mean(0), atol=1e-5)
    low, high = moments.distances(tree, x[:5], 0.01)
    exact = np.sqrt(((x[:5, None] - x) ** 2).sum(-1)).sum(1)
    assert ((low[:, 0] <= exact) & (exact <= high[:, 0])).all() and ((high - low)[:, 0] < 0.02 * 6000).all()


def test_coarser_grid_when_too_many_cells(spark):
    x = groups(400, seed=7)
    df = points(spark, x)
    blocks, _ = clustering.blocks_of(df, COLUMNS)
    edges, cells, counts = clustering.grid(blocks, clustering.quantile_edges(df, COLUMNS, 64), most=50)
    assert len(cells) <= 50 and counts.sum() == 400 and max(map(len, edges)) < 63


def test_rows_of_a_leaf_come_together_but_for_very_many(monkeypatch):
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 100)
    rows = np.array([0, 0, *[10] * 50, 5000, *[10] * 50])
    first, pieces = clustering.parts_of_leaves(rows, 8)
    assert (np.diff(first) >= 0).all() and first.max() <= 8
    assert pieces[52] == 2 and (np.delete(pieces, 52) == 1).all()
    assert len(np.unique(first[2:52])) > 2


def test_cells_are_looked_up_once_for_a_leaf(spark, monkeypatch):
    """Whatever the number of blocks, a leaf of few rows is in one group."""
    monkeypatch.setattr(clustering, "BLOCK_ROWS", 50)
    x = groups(600, seed=4)
    df = points(spark, x)
    blocks, _ = clustering.blocks_of(df.repartition(6), COLUMNS)
    found = []

    def summed(blocks, known, work, runs):
        tree, moments = known.value
        first, pieces = clustering.parts_of_leaves(np.where(tree.children[:, 0] < 0, moments.rows, 0), 8)
        found.append(pieces.max())
        return clustering_summed(blocks, known, work, runs)

    clustering_summed = clustering._summed_by_leaf
    monkeypatch.setattr(clustering, "_summed_by_leaf", summed)
    (value, error), = clustering.silhouettes(df, blocks, [x[:3]], COLUMNS, leaves=64)
    assert abs(value - brute_silhouette(x, own_labels(x, x[:3]))) <= error and found == [1]
