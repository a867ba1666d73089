"""Boosted trees on histograms, all folds and the full fit grown together.

Feature values become bins once, by quantiles of the training rows. In every round each fit grows a tree
level by level: the tasks add up gradients and hessians per (fit, node, feature, bin), one aggregate brings
the sums together, and the driver, which sees nothing but these sums, picks for every node the split with
the largest regularised second-order gain

    left^2 / (H_left + penalty) + right^2 / (H_right + penalty) - all^2 / (H + penalty).

A fit per fold leaves out that fold; the last fit has all rows. Each tree uses a share of the rows and of
the features, the same for all fits. Gradients are whole multiples of 2^-30, so sums do not depend on the
order of tasks and the same table gives the same trees.

Rows are kept as blocks (bins as bytes, margins of every fit), in at least as many partitions as there are
cores. Every round brings the margins up to date in memory, and every REFRESH rounds they are written to the
shared folder. A row of the histogram is only sent where there is something in it: at most
fits * nodes * features * bins rows leave a task, whatever the number of customers. Up to TASK_PARTITIONS *
ROWS_PER_PARTITION rows (some 25 MB as blocks) no sums need to be brought together: every fit is then a task
that grows its own trees, the same ones, without a job for every level.
"""
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLUMNS
from ..staging import new_folder

#: Rows of a block, and rounds after which margins are written anew.
BLOCK_ROWS, REFRESH = 1 << 16, 25
#: Rows of the training data in one partition, at most and (but for the last) at least; partitions up to which
#: a fit is a task of its own.
ROWS_PER_PARTITION, LEAST_ROWS, TASK_PARTITIONS = 250_000, 10_000, 4
#: Levels in which the nodes of a tree are compared with whole columns of bins.
_BY_NODE = 4
#: Gradients count in units of 2^-UNIT_BITS.
UNIT_BITS = 30
#: Prime above the numbers that rows draw from, see Draws.
PRIME = (1 << 31) - 1
#: A cut that no bin is above: all rows go left.
_NO_CUT = 255
_LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    depth: int = 3
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    bins: int = 64
    penalty: float = 1.0
    least_weight: float = 1.0
    seed: int = 42


class Draws:
    """What is drawn for each round: the features, and numbers a, b; a row takes part if
    (a * number + b) mod PRIME is below row_share * PRIME."""

    def __init__(self, settings, features):
        random = np.random.RandomState(settings.seed)
        taken = max(1, round(settings.column_share * features))
        self.below = round(settings.row_share * PRIME)
        self.rounds = [(sorted(random.choice(features, taken, replace=False).tolist()),
                        int(random.randint(1, PRIME)), int(random.randint(0, PRIME)))
                       for _ in range(settings.rounds)]


def row_number(id_column="customer_id"):
    """A number below PRIME for each row, from md5 of its id."""
    digits = F.substring(F.md5(F.col(id_column).cast("string")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % PRIME


def quantile_edges(train, columns=FEATURE_COLUMNS, bins=64):
    """Distinct upper edges of the bins per column, at most bins - 1 each."""
    steps = ", ".join(f"{i / bins}D" for i in range(1, bins))
    row = train.selectExpr(*[f"percentile_approx(cast({c} as double), array({steps}), {200 * bins}) AS {c}"
                             for c in columns]).first()
    return [np.array(sorted(set(row[c] or ()))) for c in columns]


class Trees:
    """Trees of one fit: per tree and node (children of i are 2i + 1 and 2i + 2) feature, threshold, value,
    cover (the hessian of its rows) and gain; the feature of a leaf is -1."""

    def __init__(self, base, feature, threshold, value, cover, gain, settings, columns=FEATURE_COLUMNS):
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value
        self.cover, self.gain, self.settings, self.columns = cover, gain, settings, tuple(columns)

    def margins(self, values):
        """Log odds of the rows of a matrix of feature values."""
        out = np.full(len(values), self.base)
        rows = np.arange(len(values))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(values), np.int64)
            for _ in range(self.settings.depth):
                f = feature[at]
                right = ~(values[rows, f] <= threshold[at])  # a value that is not a number goes right
                at = np.where(f < 0, at, 2 * at + 1 + right)
            out += value[at]
        return out

    def with_probability(self, features):
        own = features.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def probability(*values: pd.Series) -> pd.Series:
            margins = own.value.margins(np.column_stack([v.to_numpy(float, na_value=np.nan) for v in values]))
            return pd.Series(1 / (1 + np.exp(-margins)))

        return features.withColumn(
            "churn_probability", probability(*[F.col(c).cast("double") for c in self.columns]))

    def leaves(self):
        """(value, {feature: (low, high, share)}) of every leaf, as tree_attribution takes them."""
        out = []

        def walk(tree, node, path):
            f = self.feature[tree][node]
            if f < 0:
                out.append((float(self.value[tree][node]), path))
                return
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            edge, cover = float(self.threshold[tree][node]), self.cover[tree]
            left, right = 2 * node + 1, 2 * node + 2
            walk(tree, left, {**path, f: (low, min(high, edge), share * cover[left] / cover[node])})
            walk(tree, right, {**path, f: (max(low, edge), high, share * cover[right] / cover[node])})

        for tree in range(len(self.feature)):
            walk(tree, 0, {})
        return out

    def parameters(self):
        return {name: str(value) for name, value in asdict(self.settings).items()}

    def table(self, spark):
        """One row per tree and node that a row of the training data reaches."""
        rows = [(t, n, self.columns[f] if f >= 0 else None, float(self.threshold[t][n]) if f >= 0 else None,
                 float(self.value[t][n]), float(self.cover[t][n]), float(self.gain[t][n]))
                for t in range(len(self.feature)) for n in self._reached(t) for f in [self.feature[t][n]]]
        return spark.createDataFrame(
            rows, "tree int, node int, feature string, threshold double, value double, cover double, gain double")

    def _reached(self, tree):
        nodes = [0]
        for n in nodes:
            if self.feature[tree][n] >= 0:
                nodes += [2 * n + 1, 2 * n + 2]
        return nodes

    def save(self, spark, path):
        self.table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        settings = {**asdict(self.settings), "base": self.base, "columns": list(self.columns)}
        spark.createDataFrame([settings], ", ".join([
            "base double", "columns array<string>",
            *(f"{n} {'long' if isinstance(v, int) else 'double'}" for n, v in asdict(self.settings).items())])
        ).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark, path):
        row = spark.read.parquet(f"{path}/settings").first().asDict()
        base, columns = row.pop("base"), row.pop("columns")
        settings = Settings(**row)
        size = (2 << settings.depth) - 1
        feature = np.full((settings.rounds, size), -1)
        threshold, value, cover, gain = (np.zeros((settings.rounds, size)) for _ in range(4))
        for r in spark.read.parquet(f"{path}/nodes").collect():  # at most rounds * 2^(depth + 1) rows
            at = (r.tree, r.node)
            value[at], cover[at], gain[at] = r.value, r.cover, r.gain
            if r.feature is not None:
                feature[at], threshold[at] = columns.index(r.feature), r.threshold
        return cls(base, feature, threshold, value, cover, gain, settings, columns)


_ARRAYS = {"ids": np.int64, "labels": np.uint8, "folds": np.int32, "draws": np.int64, "bins": np.uint8,
           "margins": np.float64}
_BLOCK = "n int, " + ", ".join(f"{name} binary" for name in _ARRAYS)


def _read(row, fits):
    block = {name: np.frombuffer(row[name], kind) for name, kind in _ARRAYS.items()}
    block["bins"] = block["bins"].reshape(-1, row["n"])
    block["margins"] = block["margins"].reshape(fits, row["n"])
    return block


def _batch(block):
    return pa.RecordBatch.from_arrays(
        [pa.array([len(block["labels"])], pa.int32()),
         *(pa.array([np.ascontiguousarray(block[name], kind).tobytes()]) for name, kind in _ARRAYS.items())],
        ["n", *_ARRAYS])


def blocks_of(train, edges, bases, label, id_column, fold_column, columns):
    """The training rows as blocks, with the starting margin of every fit."""
    fold = F.lit(-1) if fold_column is None else F.col(fold_column)
    rows = train.select(
        F.col(id_column).cast("long").alias("ids"), F.col(label).cast("int").alias("labels"),
        fold.cast("int").alias("folds"), row_number(id_column).alias("draws"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                block = {name: part.column(name).to_numpy() for name in ("ids", "labels", "folds", "draws")}
                # The bin is the number of edges below the value.
                block["bins"] = np.stack([
                    np.searchsorted(e, part.column(f"x{i}").fill_null(float("nan")).to_numpy(), side="left")
                    for i, e in enumerate(edges)]).astype(np.uint8)
                block["margins"] = np.repeat(np.array(bases)[:, None], part.num_rows, axis=1)
                yield _batch(block)

    return rows.mapInArrow(run, _BLOCK)


def _reach(bins, feature, cut, levels):
    """The node of every row after so many levels of a tree."""
    at, rows = np.zeros(bins.shape[1], np.uint8 if levels <= _BY_NODE else np.int64), None
    for level in range(levels):
        first = (1 << level) - 1
        if levels <= _BY_NODE:
            right = bins[feature[first]] > int(cut[first])
            for node in range(first + 1, 2 * first + 1):
                right = np.where(at == node, bins[feature[node]] > int(cut[node]), right)
        else:
            rows = np.arange(bins.shape[1]) if rows is None else rows
            right = bins[feature[at], rows] > cut[at]
        at = 2 * at + 1 + right
    return at


def _margins(block, trees, depth):
    """Margins per fit with the trees (feature, cut, value: each by fit) added."""
    margins = block["margins"]
    if trees:
        margins = margins.copy()
        for feature, cut, value in trees:
            for fit in range(len(margins)):
                margins[fit] += value[fit][_reach(block["bins"], feature[fit], cut[fit], depth)]
    return margins


def drawn_rows(block, margins, draw, below, first_fit=0):
    """Per fit the bins of the rows that take part in a round, and their gradients and hessians in units."""
    a, b = draw
    drawn, out = (a * block["draws"] + b) % PRIME < below, []
    for fit, margin in enumerate(margins):
        chosen = np.flatnonzero(drawn & (block["folds"] != first_fit + fit))
        p = 1 / (1 + np.exp(-margin[chosen]))
        parts = [np.rint(x * (1 << UNIT_BITS)) for x in (p - block["labels"][chosen], p * (1 - p))]
        out.append((block["bins"].take(chosen, axis=1), parts))
    return out


def level_sums(rows, tree, level, columns, bins):
    """Sums of gradients and hessians by (fit, node of the level, place of the feature, bin), in units."""
    nodes = 1 << level
    out = np.zeros((2, len(rows), nodes, len(columns), bins), np.int64)
    for fit, (own, parts) in enumerate(rows):
        node = (_reach(own, tree[0][fit], tree[1][fit], level).astype(np.int64) - (nodes - 1)) * bins
        for place, f in enumerate(columns):
            key = node + own[f]
            for sums, part in zip(out, parts):
                # Whole numbers below 2^53: exact as doubles.
                sums[fit, :, place] += np.bincount(key, part, nodes * bins).astype(np.int64).reshape(nodes, bins)
    return out


class SumsByJob:
    """Sums over blocks of any number: a job for each level."""

    def __init__(self, blocks, folder, partitions, settings, below, fits):
        self.blocks, self.folder, self.partitions = blocks, folder, partitions
        self.settings, self.below, self.fits = settings, below, fits
        self.older, self.rounds = [], 0

    def level(self, tree, level, columns, draw):
        fits, settings, below = self.fits, self.settings, self.below

        def run(batches):
            total = 0
            for batch in batches:
                for row in batch.to_pylist():
                    block = _read(row, fits)
                    drawn = drawn_rows(block, block["margins"], draw, below)
                    total = total + level_sums(drawn, tree, level, columns, settings.bins)
            if not isinstance(total, int):
                g, h = total.reshape(2, -1)
                some = np.flatnonzero(h)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, g[some], h[some])], ["cell", "g", "h"])

        rows = (self.blocks.mapInArrow(run, "cell long, g long, h long")
                .groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))).toArrow()
        shape = (2, fits, 1 << level, len(columns), settings.bins)
        out = np.zeros((2, int(np.prod(shape[1:]))), np.int64)
        cells = rows["cell"].to_numpy()
        out[0, cells], out[1, cells] = rows["g"].to_numpy(), rows["h"].to_numpy()
        return out.reshape(shape)

    def add(self, tree):
        self.rounds += 1
        newer = with_margins(self.blocks, [tree], self.settings.depth, self.fits)
        if self.rounds % REFRESH == 0:
            newer = kept(newer, f"{self.folder}/{self.rounds}", self.partitions)
            self.release()
            self.blocks.unpersist()
        else:
            # The jobs of this round have brought the blocks into memory: those before them can go.
            newer = newer.persist()
            self.release()
            self.older.append(self.blocks)
        self.blocks = newer

    def release(self):
        for blocks in self.older:
            blocks.unpersist()
        self.older = []


class SumsInTask:
    """Sums over the blocks of one task, for one fit."""

    def __init__(self, blocks, fit, base, settings, below):
        self.blocks, self.fit, self.settings, self.below = blocks, fit, settings, below
        self.margins = [np.full((1, len(block["labels"])), base) for block in blocks]
        self.drawn = None

    def level(self, tree, level, columns, draw):
        if level == 0:
            self.drawn = [drawn_rows(block, margins, draw, self.below, self.fit)
                          for block, margins in zip(self.blocks, self.margins)]
        return sum(level_sums(rows, tree, level, columns, self.settings.bins) for rows in self.drawn)

    def add(self, tree):
        feature, cut, value = (x[0] for x in tree)
        for block, margins in zip(self.blocks, self.margins):
            margins += value[_reach(block["bins"], feature, cut, self.settings.depth)]


def kept(blocks, path, partitions):
    spark = blocks.sparkSession
    blocks.write.parquet(path)
    return spark.read.schema(_BLOCK).parquet(path).coalesce(partitions).persist()


def with_margins(blocks, trees, depth, fits):
    """The blocks with the trees added to their margins."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _read(row, fits)
                yield _batch({**block, "margins": _margins(block, trees, depth)})

    return blocks.mapInArrow(run, _BLOCK)


def best_splits(sums, columns, edges, settings):
    """Per fit and node: (feature, cut, gain) of the best split, and the sums left and right of it.

    Without a split that gains, all rows go left and the feature is -1. Of equals the first feature and the
    lowest cut is taken.
    """
    unit = float(1 << UNIT_BITS)
    left = np.cumsum(sums, axis=-1)
    whole = left[:, :, :, :1, -1:]
    right = whole - left
    g_left, h_left, g_right, h_right = (x / unit for x in (*left, *right))
    g, h = whole / unit
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (g_left ** 2 / (h_left + settings.penalty) + g_right ** 2 / (h_right + settings.penalty)
                - g ** 2 / (h + settings.penalty))
    known = np.array([len(edges[f]) for f in columns])[:, None] > np.arange(sums.shape[-1])
    allowed = known & (h_left >= settings.least_weight) & (h_right >= settings.least_weight)
    gain = np.where(allowed, gain, -np.inf).reshape(*gain.shape[:2], -1)
    best = gain.argmax(-1)
    value = np.take_along_axis(gain, best[..., None], -1)[..., 0]
    split = value > _LEAST_GAIN
    place, cut = np.divmod(best, sums.shape[-1])
    fits, nodes = np.indices(best.shape)
    lefts, rights = (x[:, fits, nodes, place, cut] for x in (left, right))
    total = whole[:, :, :, 0, 0]
    return (np.where(split, np.array(columns)[place], -1), np.where(split, cut, _NO_CUT),
            np.where(split, value, 0.0), np.where(split, lefts, total), np.where(split, rights, 0))


class Forest:
    """What is known of the trees of all fits: arrays by (round, fit, node)."""

    def __init__(self, rounds, fits, depth):
        shape = (rounds, fits, (2 << depth) - 1)
        self.feature, self.cut = np.full(shape, -1), np.full(shape, _NO_CUT)
        self.value, self.cover, self.gain = (np.zeros(shape) for _ in range(3))

    def tree(self, number):
        """(feature, cut, value) by fit; where there is no split all rows go left."""
        return np.maximum(self.feature[number], 0), self.cut[number], self.value[number]


def grown(draws, edges, fits, settings, sums):
    """The trees of all fits; `sums` gives the sums of a level and is told every finished tree."""
    forest, unit = Forest(settings.rounds, fits, settings.depth), float(1 << UNIT_BITS)

    def put(number, nodes, g, h):
        forest.value[number, :, nodes] = -g / (h + settings.penalty) * settings.rate
        forest.cover[number, :, nodes] = h

    for number, (columns, a, b) in enumerate(draws.rounds):
        for level in range(settings.depth):
            found = sums.level(forest.tree(number)[:2], level, columns, (a, b))
            first = (1 << level) - 1
            here = slice(first, 2 * first + 1)
            if level == 0:
                put(number, here, *(found[:, :, :, 0].sum(-1) / unit))
            (forest.feature[number, :, here], forest.cut[number, :, here], forest.gain[number, :, here],
             left, right) = best_splits(found, columns, edges, settings)
            put(number, slice(2 * first + 1, 4 * first + 3, 2), *(left / unit))
            put(number, slice(2 * first + 2, 4 * first + 3, 2), *(right / unit))
        sums.add(forest.tree(number))
    return forest


def _grown_by_tasks(blocks, draws, edges, bases, settings):
    """A task for every fit, which gets the bins, labels, folds and draws of all blocks."""
    names, needed, fits = ("feature", "cut", "value", "cover", "gain"), ("labels", "folds", "draws", "bins"), len(bases)

    def run(key, table):
        own, fit = [], key[0].as_py()
        for row in table.select(["n", *needed]).to_pylist():
            block = {name: np.frombuffer(row[name], _ARRAYS[name]) for name in needed}
            own.append({**block, "bins": block["bins"].reshape(-1, row["n"])})
        forest = grown(draws, edges, 1, settings, SumsInTask(own, fit, bases[fit], settings, draws.below))
        return pa.table({"fit": pa.array([fit], pa.int32()), **{n: [getattr(forest, n).tobytes()] for n in names}})

    # By range, so that no two fits come to the same task.
    copies = blocks.select("n", *needed, F.explode(F.sequence(F.lit(0), F.lit(fits - 1))).alias("fit"))
    rows = (copies.repartitionByRange(fits, "fit").groupBy("fit")
            .applyInArrow(run, "fit int, " + ", ".join(f"{n} binary" for n in names)).collect())
    forest = Forest(settings.rounds, fits, settings.depth)
    for row in rows:
        for n in names:
            whole = getattr(forest, n)
            whole[:, row.fit] = np.frombuffer(row[n], whole.dtype).reshape(whole[:, 0].shape)
    return forest


def fit(train, settings=Settings(), label="churned", id_column="customer_id", fold_column=None, folds=0,
        columns=FEATURE_COLUMNS):
    """(trees of each fold's fit and of the full fit last, blocks with the final margins).

    The fit of fold i does not see the rows with fold_column = i.
    """
    if not 2 <= settings.bins <= _NO_CUT:
        raise ValueError(f"bins must be between 2 and {_NO_CUT}")
    spark, fits = train.sparkSession, folds + 1
    edges = quantile_edges(train, columns, settings.bins)
    fold = F.lit(-1) if fold_column is None else F.col(fold_column)
    counts = {r["fold"]: (r["rows"], r["ones"]) for r in train.groupBy(fold.cast("int").alias("fold")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("ones")).collect()}
    bases = []
    for out in range(fits):
        rows, ones = (sum(c[i] for f, c in counts.items() if f != out) for i in (0, 1))
        if not 0 < ones < rows:
            raise ValueError("both labels are needed to fit trees")
        bases.append(float(np.log(ones / (rows - ones))))
    rows = sum(c[0] for c in counts.values())
    # A task for every core at least: margins are worked out in them, and sums where there are many rows.
    partitions = max(-(-rows // ROWS_PER_PARTITION), min(spark.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS)))
    folder = new_folder(spark, "boosting")
    blocks = kept(blocks_of(train.repartition(partitions), edges, bases, label, id_column, fold_column, columns),
                  f"{folder}/0", partitions)
    draws = Draws(settings, len(columns))
    sums = None
    if rows <= TASK_PARTITIONS * ROWS_PER_PARTITION:
        forest = _grown_by_tasks(blocks, draws, edges, bases, settings)
        pending = [forest.tree(number) for number in range(settings.rounds)]
    else:
        sums = SumsByJob(blocks, folder, partitions, settings, draws.below, fits)
        forest = grown(draws, edges, fits, settings, sums)
        blocks, pending = sums.blocks, []
    with_margins(blocks, pending, settings.depth, fits).write.parquet(f"{folder}/final")
    if sums:
        sums.release()
    blocks.unpersist()
    threshold = np.zeros(forest.feature.shape)
    for at in zip(*np.nonzero(forest.feature >= 0)):
        threshold[at] = edges[forest.feature[at]][forest.cut[at]]
    models = [Trees(bases[i], forest.feature[:, i], threshold[:, i], forest.value[:, i], forest.cover[:, i],
                    forest.gain[:, i], settings, columns) for i in range(fits)]
    return models, spark.read.schema(_BLOCK).parquet(f"{folder}/final")


def out_of_fold(blocks, fits, label="churned", id_column="customer_id"):
    """(id, label, fold, churn_probability): every row by the fit that did not see its fold."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _read(row, fits)
                margins = block["margins"][block["folds"], np.arange(row["n"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["ids"]), pa.array(block["labels"].astype(np.int32)), pa.array(block["folds"]),
                     pa.array(1 / (1 + np.exp(-margins)))], [id_column, label, "fold", "churn_probability"])

    return blocks.mapInArrow(run, f"{id_column} long, {label} int, fold int, churn_probability double")
