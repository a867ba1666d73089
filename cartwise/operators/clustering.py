"""KMeans with many starts in one pass, and the plain silhouette without all pairs.

All runs (every number of clusters with every start) step together: their centres are one small array that
goes to the tasks, and one aggregate per step brings back a row per (run, cluster). A run leaves when its
centres have settled. Up to TASK_PARTITIONS * ROWS_PER_PARTITION rows (some 25 MB) the runs are dealt out to
tasks instead that step by themselves, with the same result. Seeds are drawn as in scalable k-means++: a few rounds gather points that are far from
those gathered before, the points are weighted by the rows nearest to them, and the driver picks the seeds of
every run from these few weighted points.

Coordinates are added up in whole multiples of 2^-24, so results do not depend on the order of tasks.

The silhouette needs every row's mean distance to each cluster. Rows go into the cells of a k-d tree that
know, per cluster, number, centre c and variance v of their rows. For a row at distance d from c the mean
distance to these rows lies in

    [d, sqrt(d^2 + v)]

(the distance is convex, its square is d^2 + v on average), so distances are summed over cells instead of
rows, with a proved error. A cell that is near enough to make the error larger than the tolerance is opened;
far cells are taken whole. Rows of a leaf are brought together, so the cells are looked up once per leaf. The tree has at most LEAVES leaves, whatever the number of rows; what is left of
the error is given with the result.
"""
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..staging import new_folder
from .boosting import PRIME, quantile_edges, row_number

UNIT_BITS = 24
BLOCK_ROWS = 1 << 12
#: Rows of a partition, at most and (but for the last) at least; partitions up to which runs are dealt out to tasks.
ROWS_PER_PARTITION, LEAST_ROWS, TASK_PARTITIONS = 250_000, 10_000, 4
#: Looking up the cells of a leaf takes as long as so many of its rows; rows for which distances are held at once.
LEAF_ROWS, DISTANCE_ROWS = 200, 512
#: Rounds in which seeds are gathered, and points gathered in each, as a multiple of the largest k.
SEED_ROUNDS, OVERSAMPLING = 5, 2
#: Leaves of the tree, and bins of a coordinate and occupied cells that it may be built from.
LEAVES, GRID_BINS, GRID_CELLS = 4096, 255, 1 << 17
#: Largest error of a mean distance for which a cell is not opened, in standard deviations of a coordinate.
TOLERANCE = 0.002
_BLOCK = "n int, points binary, draws binary"


def blocks_of(df, columns, id_column="customer_id"):
    """The rows as blocks of points in the shared folder, read back and kept in memory."""
    spark = df.sparkSession
    folder = new_folder(spark, "points")
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
                     row_number(id_column).alias("draw"))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                points = np.column_stack([part.column(f"x{i}").to_numpy() for i in range(len(columns))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(points)], pa.int32()), pa.array([points.astype(float).tobytes()]),
                     pa.array([part.column("draw").to_numpy().astype(np.int64).tobytes()])],
                    ["n", "points", "draws"])

    rows.mapInArrow(run, _BLOCK).write.parquet(folder)
    blocks = spark.read.schema(_BLOCK).parquet(folder)
    count = blocks.agg(F.sum("n")).first()[0] or 0
    cores = min(spark.sparkContext.defaultParallelism, -(-count // LEAST_ROWS))
    return blocks.repartition(max(1, cores, -(-count // ROWS_PER_PARTITION))).persist(), count


def _summed(blocks, work, width):
    """Sums of whole numbers by key over all blocks: {key: array}. work gives (keys, numbers) of a block."""
    names = [f"s{i}" for i in range(width)]

    def run(batches):
        keys, numbers = [], []
        for batch in batches:
            for row in batch.to_pylist():
                points = np.frombuffer(row["points"]).reshape(row["n"], -1)
                k, x = work(points, np.frombuffer(row["draws"], np.int64))
                keys.append(k)
                numbers.append(x)
        if keys:
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros((len(distinct), width), np.int64)
            np.add.at(total, at, np.concatenate(numbers))
            yield pa.RecordBatch.from_arrays([pa.array(distinct), *map(pa.array, total.T.copy())], ["key", *names])

    rows = (blocks.mapInArrow(run, ", ".join(f"{c} long" for c in ["key", *names]))
            .groupBy("key").agg(*[F.sum(c).alias(c) for c in names])).toArrow()
    return dict(zip(rows["key"].to_pylist(), np.column_stack([rows[c].to_numpy() for c in names])))


def _units(x):
    return np.rint(x * (1 << UNIT_BITS)).astype(np.int64)


def squared_distances(points, centres):
    """Rows x centres, without the loss of the expanded square."""
    out = np.zeros((len(points), len(centres)))
    for axis in range(points.shape[1]):
        out += (points[:, axis, None] - centres[:, axis]) ** 2
    return out


def _nearest(points, centres):
    """The nearest centre of every row, the first of equals, and the squared distance."""
    columns, at = np.ascontiguousarray(points.T), np.zeros(len(points), np.int64)
    for number, centre in enumerate(centres):
        distance = (columns[0] - centre[0]) ** 2
        for column, x in zip(columns[1:], centre[1:]):
            distance += (column - x) ** 2
        if number:
            at[distance < best] = number
            np.minimum(best, distance, out=best)
        else:
            best = distance
    return at, best


def step_totals(points, centres):
    """(clusters that have rows, their number of rows, sums of coordinates and of squared distances in units)."""
    at, near = _nearest(points, centres)
    order = np.argsort(at, kind="stable")
    found, starts = np.unique(at[order], return_index=True)
    columns = np.column_stack([np.ones(len(points), np.int64), _units(points), _units(near)])[order]
    return found, np.add.reduceat(columns, starts, axis=0)


def moved(centres, rows):
    """(numbers, new centres, squared distances) from the totals of all clusters."""
    unit, n = float(1 << UNIT_BITS), rows[:, 0]
    # A cluster that lost all rows stays where it was.
    new = np.where(n[:, None] > 0, rows[:, 1:-1] / unit / np.maximum(n, 1)[:, None], centres)
    return n, new, rows[:, -1].sum() / unit


def step(blocks, runs):
    """One pass for all runs (a list of centre arrays): per run (numbers, new centres, squared distances)."""
    firsts = np.cumsum([0, *map(len, runs)])
    width = runs[0].shape[1] if runs else 0

    def work(points, _):
        parts = [step_totals(points, centres) for centres in runs]
        return (np.concatenate([first + found for first, (found, _) in zip(firsts, parts)]),
                np.concatenate([numbers for _, numbers in parts]))

    totals, none = _summed(blocks, work, width + 2), np.zeros(width + 2, np.int64)
    return [moved(centres, np.array([totals.get(first + i, none) for i in range(len(centres))]))
            for first, centres in zip(firsts.tolist(), runs)]


def settled(runs, one_step, max_iter, tolerance):
    """[(centres, cost)] of the runs after their last step; one_step does a step for a list of runs."""
    last, going = {}, dict(enumerate(runs))
    for _ in range(max_iter):
        if not going:
            break
        for i, (_, new, _) in zip(list(going), one_step(list(going.values()))):
            shift = ((new - going[i]) ** 2).sum()
            going[i] = new
            if shift <= tolerance:
                last[i] = going.pop(i)
    last.update(going)
    # Once more, for the cost with the last centres.
    centres = [last[i] for i in range(len(runs))]
    return [(c, cost) for c, (_, _, cost) in zip(centres, one_step(centres))]


def _settled_by_tasks(blocks, runs, max_iter, tolerance):
    """The same with the runs dealt out to tasks that get all blocks."""
    groups = min(len(runs), blocks.sparkSession.sparkContext.defaultParallelism)

    def run(key, table):
        blocks = [np.frombuffer(row["points"]).reshape(row["n"], -1) for row in table.to_pylist()]
        mine = range(key[0].as_py(), len(runs), groups)

        def one_step(own):
            out = []
            for centres in own:
                rows = np.zeros((len(centres), centres.shape[1] + 2), np.int64)
                for points in blocks:
                    found, numbers = step_totals(points, centres)
                    rows[found] += numbers
                out.append(moved(centres, rows))
            return out

        found = settled([runs[i] for i in mine], one_step, max_iter, tolerance)
        return pa.table({"run": pa.array(mine, pa.int32()), "centres": [c.tobytes() for c, _ in found],
                         "cost": pa.array([cost for _, cost in found], pa.float64())})

    copies = blocks.select("n", "points", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    rows = (copies.repartitionByRange(groups, "part").groupBy("part")
            .applyInArrow(run, "run int, centres binary, cost double").collect())
    found = {r.run: (np.frombuffer(r.centres).reshape(runs[r.run].shape), r.cost) for r in rows}
    return [found[i] for i in range(len(runs))]


def gathered(blocks, starts, most, seed, width):
    """For each start some points that lie far apart, and the number of rows nearest to each."""
    random = np.random.RandomState(seed)
    # The first point of a start is the row that draws the smallest number.
    lines = [(int(random.randint(1, PRIME)), int(random.randint(0, PRIME))) for _ in range(starts)]

    def smallest(batches):
        best = [None] * starts
        for batch in batches:
            for row in batch.to_pylist():
                points = np.frombuffer(row["points"]).reshape(row["n"], -1)
                for s, (a, b) in enumerate(lines):
                    drawn = (a * np.frombuffer(row["draws"], np.int64) + b) % PRIME
                    i = drawn.argmin()
                    if best[s] is None or (drawn[i], points[i].tolist()) < best[s]:
                        best[s] = (drawn[i], points[i].tolist())
        found = [(s, int(b[0]), b[1]) for s, b in enumerate(best) if b is not None]
        if found:
            numbers, drawn, firsts = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(drawn), pa.array(firsts)], ["s", "drawn", "point"])

    firsts = (blocks.mapInArrow(smallest, "s int, drawn long, point array<double>").groupBy("s")
              .agg(F.min(F.struct("drawn", "point")).alias("first")).collect())
    pools = [np.array([r.first.point]) for r in sorted(firsts, key=lambda r: r.s)]

    def costs(points, _):
        near = [squared_distances(points, pool).min(1) for pool in pools]
        return np.arange(starts), np.array([[_units(x).sum()] for x in near])

    for _ in range(SEED_ROUNDS):
        total = _summed(blocks, costs, 1)
        lines = [(int(random.randint(1, PRIME)), int(random.randint(0, PRIME))) for _ in range(starts)]
        share = [most / max(total[s][0] / float(1 << UNIT_BITS), 1e-30) for s in range(starts)]

        def chosen(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    points = np.frombuffer(row["points"]).reshape(row["n"], -1)
                    draws = np.frombuffer(row["draws"], np.int64)
                    for s, (a, b) in enumerate(lines):
                        odds = squared_distances(points, pools[s]).min(1) * share[s]
                        mine = points[(a * draws + b) % PRIME < odds * PRIME]
                        if len(mine):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([s] * len(mine), pa.int32()), pa.array(mine.tolist(), pa.list_(pa.float64()))],
                                ["s", "point"])

        # About `most` points of each start.
        new = blocks.mapInArrow(chosen, "s int, point array<double>").distinct().collect()
        for s in range(starts):
            own = sorted(r.point for r in new if r.s == s)
            if own:
                pools[s] = np.concatenate([pools[s], np.array(own)])
    counts = [n for n, _, _ in step(blocks, pools)]
    return list(zip(pools, counts))


def seeds(points, weights, k, random):
    """k of the weighted points, each drawn by its squared distance from those before."""
    cumulated = np.cumsum(weights.astype(float))
    chosen = [int(np.searchsorted(cumulated, random.rand() * cumulated[-1], side="right"))]
    near = squared_distances(points, points[chosen])[:, 0]
    while len(chosen) < k:
        odds = np.cumsum(weights * near)
        at = int(np.searchsorted(odds, random.rand() * odds[-1], side="right")) if odds[-1] > 0 else 0
        chosen.append(min(at, len(points) - 1))
        near = np.minimum(near, squared_distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


class Centres:
    """A settled run."""

    def __init__(self, centres, cost, columns, cluster_column="cluster"):
        self.centres, self.cost, self.columns, self.cluster_column = centres, cost, columns, cluster_column

    def transform(self, df):
        """Add the number of the nearest centre, the first of equals; a plain column expression."""
        terms = [sum(((F.col(c) - float(x)) * (F.col(c) - float(x)) for c, x in zip(self.columns, centre)), F.lit(0.0))
                 for centre in self.centres]
        distances = F.array(*terms)
        return df.withColumn(self.cluster_column,
                             (F.array_position(distances, F.array_min(distances)) - 1).cast("int"))


def fit(df, ks, columns, n_init=10, seed=42, max_iter=300, tolerance=1e-4, id_column="customer_id"):
    """{k: the best of n_init runs by total squared distance}, and the blocks of points."""
    blocks, count = blocks_of(df, columns, id_column)
    if not count:
        raise ValueError("there are no rows to cluster")
    pools = gathered(blocks, n_init, OVERSAMPLING * max(ks), seed, len(columns))
    random = np.random.RandomState(seed)
    runs = {(k, i): seeds(points, weights, k, random) for k in ks for i, (points, weights) in enumerate(pools)}
    if count <= TASK_PARTITIONS * ROWS_PER_PARTITION:
        found = _settled_by_tasks(blocks, list(runs.values()), max_iter, tolerance)
    else:
        found = settled(list(runs.values()), lambda own: step(blocks, own), max_iter, tolerance)
    found = dict(zip(runs, found))
    best = {k: min((i for kk, i in found if kk == k), key=lambda i: (found[k, i][1], i)) for k in ks}
    return {k: Centres(*found[k, i], tuple(columns)) for k, i in best.items()}, blocks


def silhouettes(df, blocks, runs, columns, leaves=LEAVES, tolerance=TOLERANCE):
    """[(mean silhouette, error)] of the rows under each run, a list of arrays of centres.

    The exact mean over all pairs of rows is within the error. A cluster of one row counts 0.
    """
    edges, cells, counts = grid(blocks, quantile_edges(df, columns, GRID_BINS))
    tree = Tree(edges, cells, counts, leaves)
    first = np.cumsum([0, *map(len, runs)])
    width, total = len(columns), int(first[-1])

    def own_moments(points, _):
        leaf = tree.leaves(points)
        away = points - tree.origin[leaf]
        numbers = np.column_stack([np.ones(len(points), np.int64), _units(away), _units((away ** 2).sum(1))])
        keys = np.concatenate([leaf * total + first[r] + _nearest(points, c)[0] for r, c in enumerate(runs)])
        return keys, np.tile(numbers, (len(runs), 1))

    moments = Moments(tree, _summed(blocks, own_moments, width + 2), total, width, len(runs[0]))
    # At most 2 * leaves nodes with the numbers of all clusters, whatever the number of rows.
    known = df.sparkSession.sparkContext.broadcast((tree, moments))

    def own_bounds(leaf, points):
        tree, moments = known.value
        own = np.stack([first[r] + _nearest(points, c)[0] for r, c in enumerate(runs)])
        order = np.argsort(leaf, kind="stable")
        sums = np.zeros((len(runs), 3), np.int64)
        for at in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
            low, high = moments.distances(tree, points[at], tolerance)
            for r in range(len(runs)):
                clusters = slice(int(first[r]), int(first[r + 1]))
                bounds = silhouette_bounds(low[:, clusters], high[:, clusters], own[r, at] - first[r],
                                           moments.n[0, clusters])
                sums[r] += [len(at), *(_units(b).sum() for b in bounds)]
        return sums

    found = _summed_by_leaf(blocks, known, own_bounds, len(runs))
    out = []
    for r in range(len(runs)):
        n, low, high = found[r].tolist()
        low, high = (x / float(1 << UNIT_BITS) / n for x in (low, high))
        out.append(((low + high) / 2, (high - low) / 2 + 2.0 ** -UNIT_BITS))
    return out


def parts_of_leaves(rows, parts):
    """(first part, number of parts) of every node, so that parts take about as long: small leaves that follow
    one another share a part, a leaf of very many rows has several."""
    cost = np.where(rows > 0, rows + LEAF_ROWS, 0)
    target = max(cost.sum() / parts, 1.0)
    pieces = np.maximum(np.ceil(rows / max(target, BLOCK_ROWS)), 1).astype(np.int64)
    return ((np.cumsum(cost) - cost) // target).astype(np.int64), pieces


def _summed_by_leaf(blocks, known, work, runs):
    """Sums of work(leaf, points) by run, with the rows of a leaf brought together."""
    spark = blocks.sparkSession
    tree, moments = known.value
    # Much work for each row: several parts for every core.
    parts = max(blocks.rdd.getNumPartitions(), 4 * spark.sparkContext.defaultParallelism)
    first, pieces = parts_of_leaves(np.where(tree.children[:, 0] < 0, moments.rows, 0), parts)
    axes = [f"x{i}" for i in range(len(tree.edges))]

    def placed(batches):
        tree, _ = known.value
        for batch in batches:
            for row in batch.to_pylist():
                points = np.frombuffer(row["points"]).reshape(row["n"], -1)
                leaf = tree.leaves(points)
                part = first[leaf] + np.frombuffer(row["draws"], np.int64) % pieces[leaf]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(leaf), *map(pa.array, np.ascontiguousarray(points.T))], ["part", "leaf", *axes])

    def run(table):
        sums = work(table["leaf"].to_numpy(), np.column_stack([table[x].to_numpy() for x in axes]))
        return pa.table({"run": np.arange(runs), **{f"s{i}": sums[:, i].copy() for i in range(3)}})

    rows = blocks.mapInArrow(placed, ", ".join(["part long", "leaf long", *(f"{x} double" for x in axes)]))
    sums = (rows.repartition(parts, "part").groupBy("part").applyInArrow(run, "run long, s0 long, s1 long, s2 long")
            .groupBy("run").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(3)]).collect())
    return {r.run: np.array([r.s0, r.s1, r.s2]) for r in sums}


def silhouette_bounds(low, high, own, sizes):
    """(least, largest) silhouette of rows with bounds on their sums of distances to each cluster."""
    rows = np.arange(len(own))
    others = np.maximum(sizes[own] - 1, 1)
    inside = [x[rows, own] / others for x in (low, high)]
    outside = []
    for x in (low, high):
        means = np.where(sizes > 0, x / np.maximum(sizes, 1), np.inf)
        means[rows, own] = np.inf
        outside.append(means.min(1))

    def value(a, b):
        larger = np.maximum(a, b)
        with np.errstate(invalid="ignore"):
            s = np.where(larger > 0, (b - a) / np.where(larger > 0, larger, 1), 0.0)
        return np.where((sizes[own] == 1) | ~np.isfinite(b), 0.0, s)

    return value(inside[1], outside[0]), value(inside[0], outside[1])


class Moments:
    """Number, mean and variance of the rows of every cluster in every node of a tree."""

    def __init__(self, tree, sums, clusters, width, of_one_run):
        nodes, unit = len(tree.children), float(1 << UNIT_BITS)
        self.n, self.mean = np.zeros((nodes, clusters)), np.zeros((nodes, clusters, width))
        spread = np.zeros((nodes, clusters))
        for key, numbers in sums.items():
            node, cluster = divmod(key, clusters)
            n, away = numbers[0], numbers[1:-1] / unit / numbers[0]
            self.n[node, cluster], self.mean[node, cluster] = n, tree.origin[node] + away
            spread[node, cluster] = max(numbers[-1] / unit - n * (away ** 2).sum(), 0.0)
        # Children come after their parents.
        for node in range(nodes - 1, -1, -1):
            a, b = tree.children[node]
            if a >= 0:
                self.n[node], self.mean[node], spread[node] = _together(
                    *((self.n[x], self.mean[x], spread[x]) for x in (a, b)))
        # Sums are rounded to units; a little more variance keeps the upper bound one.
        self.room = 2.0 ** (2 - UNIT_BITS)
        self.variance = spread / np.maximum(self.n, 1) + self.room
        # The clusters of one run have all rows.
        whole = (self.n[:, 0], self.mean[:, 0], spread[:, 0])
        for c in range(1, of_one_run):
            whole = _together(whole, (self.n[:, c], self.mean[:, c], spread[:, c]))
        self.rows, self.centre, self.all_variance = whole[0], whole[1], whole[2] / np.maximum(whole[0], 1)

    def distances(self, tree, points, tolerance):
        """Bounds on the sum of distances of each point to the rows of each cluster."""
        low, high = points.min(0), points.max(0)
        taken, todo = [], np.zeros(1, np.int64)
        while len(todo):
            centre = self.centre[todo]
            near = np.sqrt((np.maximum(np.maximum(low - centre, centre - high), 0) ** 2).sum(1))
            error = (np.sqrt(near ** 2 + self.all_variance[todo]) - near) / 2
            whole = (error <= tolerance) | (tree.children[todo, 0] < 0)
            taken.append(todo[whole])
            todo = tree.children[todo[~whole]].ravel()
        taken = np.concatenate(taken)
        n = self.n[taken]
        # A node whose rows are all in one cluster has that cluster's centre: one distance for all runs.
        whole = n == self.rows[taken][:, None]
        at, cluster = np.nonzero((n > 0) & ~whole)
        centres = np.concatenate([self.centre[taken], self.mean[taken[at], cluster]])
        variance = np.concatenate([self.all_variance[taken] + self.room, self.variance[taken[at], cluster]])
        weights = np.zeros((len(centres), n.shape[1]))
        weights[:len(taken)] = np.where(whole, n, 0)
        weights[np.arange(len(taken), len(centres)), cluster] = n[at, cluster]
        slack, lows, highs = self.room, [], []  # centres are known to a unit
        for start in range(0, len(points), DISTANCE_ROWS):
            squared = squared_distances(points[start:start + DISTANCE_ROWS], centres)
            lows.append(np.maximum(np.sqrt(squared) - slack, 0) @ weights)
            highs.append((np.sqrt(squared + variance) + slack) @ weights)
        return np.concatenate(lows), np.concatenate(highs)


def _together(one, other):
    """Number, mean and sum of squared distances from the mean of two sets of rows taken together."""
    (n, mean, spread), (m, other_mean, other_spread) = one, other
    both = np.maximum(n + m, 1)
    apart = other_mean - mean
    return (n + m, mean + apart * (m / both)[..., None],
            spread + other_spread + (apart ** 2).sum(-1) * n * m / both)


class Tree:
    """A k-d tree over the occupied cells of a grid of quantiles, built on the driver."""

    def __init__(self, edges, cells, counts, leaves):
        """edges: inner bin edges per coordinate; cells: occupied cells (rows of bin numbers)."""
        self.edges = edges
        bounds = [np.concatenate([e[:1], e, e[-1:]]) if len(e) else np.zeros(2) for e in edges]
        self.children, self.leaf_of = [], np.zeros(len(cells), np.int64)
        members, todo = {}, []

        def extent(own):
            low, high = own.min(0), own.max(0) + 1
            return [float(b[h] - b[lo]) if h - lo > 1 else 0.0 for b, lo, h in zip(bounds, low, high)], low, high

        def put(own):
            node = len(self.children)
            self.children.append((-1, -1))
            sides, low, high = extent(cells[own])
            if any(h - lo > 1 for lo, h in zip(low, high)):
                # What a cell adds to the error grows with its rows and the square of its size.
                weight = counts[own].sum() * (sum(s * s for s in sides) + 1e-12)
                heapq.heappush(todo, (-weight, node))
            members[node] = own
            return node

        if len(cells):
            put(np.arange(len(cells)))
        taken = 1
        while todo and taken < leaves:
            _, node = heapq.heappop(todo)
            own = members.pop(node)
            sides, low, high = extent(cells[own])
            axis = max(range(len(edges)), key=lambda a: (high[a] - low[a] > 1, sides[a], high[a] - low[a]))
            order = np.argsort(cells[own, axis], kind="stable")
            line, cumulated = cells[own, axis][order], np.cumsum(counts[own][order])
            places = np.flatnonzero(line[1:] != line[:-1]) + 1
            at = places[np.abs(cumulated[places - 1] * 2 - cumulated[-1]).argmin()]
            self.children[node] = (put(own[order[:at]]), put(own[order[at:]]))
            taken += 1
        self.children = np.array(self.children).reshape(-1, 2)
        for node, own in members.items():
            self.leaf_of[own] = node
        self.codes = np.ravel_multi_index(cells.T, self.shape) if len(cells) else np.zeros(0, np.int64)
        order = np.argsort(self.codes)
        self.codes, self.leaf_of = self.codes[order], self.leaf_of[order]
        # A point within the bounds of each leaf, from which its rows are measured.
        self.origin = np.zeros((len(self.children), len(edges)))
        for node, own in members.items():
            _, low, high = extent(cells[own])
            self.origin[node] = [(b[lo] + b[h]) / 2 for b, lo, h in zip(bounds, low, high)]

    @property
    def shape(self):
        return tuple(len(e) + 1 for e in self.edges)

    def leaves(self, points):
        """The leaf of each point."""
        return self.leaf_of[np.searchsorted(self.codes, grid_codes(points, self.edges))]


def grid_codes(points, edges):
    bins = [np.searchsorted(e, points[:, i], side="left") for i, e in enumerate(edges)]
    return np.ravel_multi_index(bins, tuple(len(e) + 1 for e in edges))


def grid(blocks, edges, most=GRID_CELLS):
    """(edges, occupied cells, rows in each); coarser edges until at most `most` cells are occupied."""
    while True:
        def codes(points, _):
            found, n = np.unique(grid_codes(points, edges), return_counts=True)
            return found, n[:, None]

        names = _counting(blocks, codes)
        if names.count() <= most:
            break
        edges = [e[1::2] for e in edges]
    rows = names.toArrow()
    cells = np.column_stack(np.unravel_index(rows["key"].to_numpy(), tuple(len(e) + 1 for e in edges)))
    return edges, cells, rows["n"].to_numpy()


def _counting(blocks, work):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = work(np.frombuffer(row["points"]).reshape(row["n"], -1), None)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[:, 0])], ["key", "n"])

    return blocks.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
