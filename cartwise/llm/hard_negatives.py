"""Hard negatives by rotated one-bit codes with exact rescoring.

An anchor's positives are the `positives` best rows of its own label by inner product; the hard negatives
of an anchor and a positive are the best rows of other labels whose score is between `share` and all of the
positive's score.

Every vector is rotated by two rounds of sign flips and a Walsh-Hadamard transform and stored as one bit
per dimension, with the alignment a of the rotated vector with its code c (a unit vector of equal parts)
and its length. What the code does not explain is a residual of known length, at a right angle to the code:

    <q, v> = a <q, c> + <q, r>,   |<q, r>| <= |r| sqrt(|q|^2 - <q, c>^2)      (Cauchy-Schwarz)

The rotated anchor is rounded to PLANES bits per dimension, so <q, c> is a sum of popcounts of bit planes
and codes, with a known bound of the rounding. This gives an interval that holds the score for certain.
A row is left out only if its interval shows that it cannot be among the best: the k-th best lower bound,
or k scores that are known, lie above it, or it misses the range of scores. Known are the scores found in
earlier blocks; before there are k of them, the rows with the best estimates are scored. What survives is
scored in integers, so the result is exact.

The index (blocks of vectors, codes, alignments and lengths) is written once to the shared folder. Anchors
are sent to slices of it; slices are kept once for every PART blocks of anchors, and a cell of slice
and part is a task that returns the best of its slice only.

Components are floor(scale * x). Rows with a null id, label or vector, or a null or non-finite component,
take no part; shorter vectors count as filled up with zeros. Rows that share an id count as one, the one
with the smallest label and, of these, the smallest vector. Ties go to the smaller id. A score beyond 64
bits is an error. An empty table gives an empty result; an anchor without positives, or a positive without
negatives, has no row. Other columns are not looked at.
"""
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..staging import checkpointed, new_folder

SCALE = 256
EVERY = 100
POSITIVES, NEGATIVES = 5, 5
#: Least score of a negative, in percent of the positive's score.
LEAST_PERCENT = 80
#: Vectors in a block of the index and in a block of anchors.
BLOCK, ANCHOR_BLOCK = 2048, 1024
#: Blocks of the index in a slice at most on average, and blocks of anchors that meet it together.
SLICE, PART = 16, 64
PLANES = 6
#: Anchors whose intervals with a block are held at once.
_TOGETHER = 64
#: Rows with the best estimates that are scored for each score wanted, as long as too few are known.
_PROBES = 3
_SEED = 11
#: The columns of a block.
_ARRAYS = ("ids", "labels", "data", "code", "aligned", "length", "partner_ids", "partner_scores", "partners")


def quantised(vectors, id_col="vec_id", label_col="label", vector_col="embedding", scale=SCALE):
    """(vec_id, label, v): the rows that take part, one for each id."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))

    def whole(c):
        scaled = c.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0 ** 62, F.floor(scaled)).otherwise(
            F.raise_error(F.lit("a component is too large for 64 bits")).cast("long"))

    rows = vectors.where(x.isNotNull() & finite & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.struct(
        F.col(label_col).cast("long").alias("label"), F.transform(x, whole).alias("v")).alias("row"))
        .groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*"))


def matrix(column):
    """An Arrow column of lists as rows of one width, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), max(lengths.max(initial=0), 1)), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def rotated(rows):
    """The rows in a rotated space of a power of two, 64 at least, dimensions; lengths stay."""
    n, width = rows.shape
    size = max(64, 1 << (width - 1).bit_length())
    x = np.zeros((n, size))
    x[:, :width] = rows
    random = np.random.RandomState(_SEED)
    for _ in range(2):
        x *= random.randint(0, 2, size) * 2.0 - 1
        reach = 1
        while reach < size:
            pairs = x.reshape(n, -1, 2, reach)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, size)
            reach *= 2
    return x / size


def bits(flags):
    """Rows of flags as rows of 64-bit words."""
    return np.packbits(flags, axis=1).view(np.uint64)


def codes(rows):
    """(code, alignment, length) of every row."""
    turned = rotated(rows)
    return bits(turned > 0), np.abs(turned).sum(1) / np.sqrt(turned.shape[1]), np.sqrt((turned ** 2).sum(1))


def packed(rows, size, with_codes):
    """Blocks of up to `size` rows as bytes, packed within a task.

    Rows are (vec_id, label, v) and, for anchors with their positives, (ids, scores). Components are 16-bit
    numbers where all of a block fit.
    """
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                data = matrix(part.column("v"))
                small = bool(np.abs(data).max() < 1 << 15)
                out = {"ids": part.column("vec_id").to_numpy(), "labels": part.column("label").to_numpy(),
                       "data": data.astype(np.int16) if small else data}
                if with_codes:
                    out["code"], out["aligned"], out["length"] = codes(data)
                if "partner_ids" in part.schema.names:
                    lists = part.column("partner_ids")
                    out["partner_ids"], out["partner_scores"] = matrix(lists), matrix(part.column("partner_scores"))
                    out["partners"] = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([len(data)]), pa.array([small]),
                     *(pa.array([np.ascontiguousarray(out[c]).tobytes() if c in out else None], pa.binary())
                       for c in _ARRAYS)], ["block", "n", "small", *_ARRAYS])
                number += 1

    return rows.mapInArrow(run, "block long, n long, small boolean, " + ", ".join(f"{c} binary" for c in _ARRAYS))


def unpacked(row):
    """The arrays of a block."""
    kinds = {"code": np.uint64, "aligned": float, "length": float, "data": np.int16 if row["small"] else np.int64}
    out = {c: np.frombuffer(row[c], kinds.get(c, np.int64)) for c in _ARRAYS if row[c] is not None}
    for c in out.keys() & {"code", "data", "partner_ids", "partner_scores"}:
        out[c] = out[c].reshape(row["n"], -1)
    out["data"] = out["data"].astype(np.int64)
    return out


class Planes:
    """A block of anchors, rotated and rounded, for codes of one width."""

    def __init__(self, data, words):
        dimensions = words * 64
        rows = np.zeros((len(data), dimensions), np.int64)
        shared = min(dimensions, data.shape[1])  # dimensions that the other side does not have count nothing
        rows[:, :shared] = data[:, :shared]
        turned = rotated(rows)
        self.low = turned.min(1)
        self.step = (turned.max(1) - self.low) / ((1 << PLANES) - 1)
        parts = np.rint((turned - self.low[:, None]) / np.where(self.step > 0, self.step, 1)[:, None]).astype(np.int64)
        self.planes = [bits((parts >> j) & 1 > 0) for j in range(PLANES)]
        self.total = parts.sum(1)
        rounding = np.abs(turned - self.low[:, None] - self.step[:, None] * parts).sum(1)
        self.rounding = rounding / np.sqrt(dimensions)
        self.length = np.sqrt((turned ** 2).sum(1))

    def intervals(self, at, code, aligned, length):
        """(low, high) of the scores of the anchors `at` with the rows of the index."""
        dimensions = code.shape[1] * 64
        held = np.bitwise_count(code).sum(1, dtype=np.int64)
        seen = np.zeros((len(at), len(code)))
        for j, plane in enumerate(self.planes):
            for w in range(code.shape[1]):
                seen += np.bitwise_count(plane[at, w][:, None] & code[:, w]) * float(1 << j)
        low, step, total, rounding, own = (x[at][:, None] for x in (
            self.low, self.step, self.total, self.rounding, self.length))
        along = (low * (2 * held - dimensions) + step * (2 * seen - total)) / np.sqrt(dimensions)
        least = np.maximum(np.abs(along) - rounding, 0)
        rest = np.sqrt(np.maximum(length ** 2 - aligned ** 2, 0))
        # Scores are whole numbers: half a unit, and a part of the lengths for rounding, lose no proof.
        room = (aligned * rounding + rest * np.sqrt(np.maximum(own ** 2 - least ** 2, 0))
                + 1e-9 * own * length + 0.5)
        return aligned * along - room, aligned * along + room


class Anchors:
    """A block of anchors and the best that a task has found for each of `wanted` lists."""

    def __init__(self, arrays, k, wanted):
        self.__dict__.update(arrays)
        self.k, self.planes = k, {}
        # Places not taken have no score: the least number that there is.
        self.best_ids = np.zeros((len(self.ids), wanted, k), np.int64)
        self.best = np.full((len(self.ids), wanted, k), np.iinfo(np.int64).min)

    def of_width(self, words):
        if words not in self.planes:
            self.planes[words] = Planes(self.data, words)
        return self.planes[words]

    def floor(self, at, which):
        """Scores that k rows reach, per anchor."""
        return self.best[at, which, -1].astype(float)

    def full(self, at, which):
        """Whether k rows are known, per anchor."""
        return self.best[at, which, -1] > np.iinfo(np.int64).min

    def put(self, anchor, which, ids, scores):
        ids = np.concatenate([self.best_ids[anchor, which], ids])
        scores = np.concatenate([self.best[anchor, which], scores])
        order = np.lexsort((ids, -np.maximum(scores, -np.iinfo(np.int64).max)))[:self.k]
        self.best_ids[anchor, which], self.best[anchor, which] = ids[order], scores[order]

    def score(self, anchor, block, members):
        """Integer scores with the members of a block."""
        width = min(self.data.shape[1], block["data"].shape[1])
        own, rows = self.data[anchor, :width], block["data"][members, :width]
        if np.sqrt((own.astype(float) ** 2).sum()) * block["length"][members].max(initial=0) < 2.0 ** 62:
            return rows @ own
        exact = [sum(a * b for a, b in zip(own.tolist(), row)) for row in rows.tolist()]
        for other, s in zip(block["ids"][members].tolist(), exact):
            if not -(1 << 63) < s < 1 << 63:
                raise ValueError(f"the score of vec_id {self.ids[anchor]} and {other} does not fit into 64 bits")
        return np.array(exact, np.int64)


def _kth(values, k):
    """The k-th largest of each row, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


def probed(anchors, anchor, block, rows, estimates, least=-np.inf, top=np.inf):
    """The k-th largest score of the rows with the best estimates that lies in the range."""
    wanted = _PROBES * anchors.k
    if len(rows) > wanted:
        rows = rows[np.argpartition(estimates, -wanted)[-wanted:]]
    scores = anchors.score(anchor, block, rows).astype(float) if len(rows) else np.zeros(0)
    return _kth(scores[(scores >= least) & (scores <= top)][None, :], anchors.k)[0]


def meet_own_label(anchors, block):
    """Bring the best rows of the anchors' own labels up to date with a block."""
    planes = anchors.of_width(block["code"].shape[1])
    for label in np.intersect1d(anchors.labels, block["labels"]):
        rows = np.flatnonzero(block["labels"] == label)
        own = np.flatnonzero(anchors.labels == label)
        for at in np.split(own, range(_TOGETHER, len(own), _TOGETHER)):
            low, high = planes.intervals(at, *(block[c][rows] for c in ("code", "aligned", "length")))
            other = anchors.ids[at][:, None] != block["ids"][rows]
            proved = np.maximum(_kth(np.where(other, low, -np.inf), anchors.k), anchors.floor(at, 0))
            for i in np.flatnonzero(~anchors.full(at, 0)):
                here = np.flatnonzero(other[i])
                proved[i] = max(proved[i], probed(anchors, at[i], block, rows[here], low[i, here] + high[i, here]))
            possible = other & (high >= proved[:, None])
            for a, mine in zip(at, possible):
                members = rows[mine]
                if len(members):
                    anchors.put(a, 0, block["ids"][members], anchors.score(a, block, members))


def meet_other_labels(anchors, block, percent=LEAST_PERCENT):
    """Bring the hard negatives of the anchors' positives up to date with a block."""
    planes = anchors.of_width(block["code"].shape[1])
    wanted = anchors.partner_scores.shape[1]
    top = anchors.partner_scores
    least = -(-percent * top // 100)  # rounded up
    for start in range(0, len(anchors.ids), _TOGETHER):
        at = np.arange(start, min(start + _TOGETHER, len(anchors.ids)))
        low, high = planes.intervals(at, block["code"], block["aligned"], block["length"])
        other = (anchors.labels[at][:, None] != block["labels"]) & (anchors.ids[at][:, None] != block["ids"])
        survives = np.zeros(other.shape, bool)
        for j in range(wanted):
            here = (j < anchors.partners[at])[:, None] & other
            least_j, top_j = least[at, j][:, None], top[at, j][:, None]
            certain = here & (low >= least_j) & (high <= top_j)
            proved = np.maximum(_kth(np.where(certain, low, -np.inf), anchors.k), anchors.floor(at, j))
            # The best of the estimates that are not above the range.
            for i in np.flatnonzero(~anchors.full(at, j) & here.any(1)):
                near = np.flatnonzero(here[i] & (low[i] + high[i] <= 2 * top_j[i]))
                proved[i] = max(proved[i], probed(anchors, at[i], block, near, low[i, near] + high[i, near],
                                                  least_j[i], top_j[i]))
            survives |= here & (high >= np.maximum(least_j, proved[:, None])) & (low <= top_j)
        for a, mine in zip(at, survives):
            members = np.flatnonzero(mine)
            if not len(members):
                continue
            scores = anchors.score(a, block, members)
            for j in range(anchors.partners[a]):
                fits = (scores >= least[a, j]) & (scores <= top[a, j])
                if fits.any():
                    anchors.put(a, j, block["ids"][members[fits]], scores[fits])


def build_index(rows):
    """Write the blocks of the index once and return them, with how many there are."""
    folder = new_folder(rows.sparkSession, "one-bit-index")
    packed(rows, BLOCK, True).write.parquet(folder)
    index = rows.sparkSession.read.parquet(folder)
    return index, index.count()


def searched(index, n_blocks, anchors, meet, k, lists):
    """(anchor_id, which, partner_id, score): the best k of every slice for each of the anchors' lists.

    meet: brings a block of anchors up to date with a block of the index.
    """
    spark = index.sparkSession
    blocks = checkpointed(packed(anchors, ANCHOR_BLOCK, False))
    parts = max(1, -(-blocks.count() // PART))
    slices = max(1, -(-n_blocks // SLICE), min(n_blocks, 2 * spark.sparkContext.defaultParallelism))

    def dealt(table, own, of, other, n):
        return table.select(
            "*", F.pmod(F.xxhash64("block"), F.lit(of)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(other))

    left = dealt(index, "slice", slices, "part", parts)
    right = dealt(blocks, "part", parts, "slice", slices)

    def run(of_index, of_anchors):
        held = [Anchors(unpacked(row), k, lists) for row in of_anchors.to_pylist()]
        for batch in of_index.to_batches(1):
            block = unpacked(batch.to_pylist()[0])
            for one in held:
                meet(one, block)
        out = []
        for one in held:
            a, which, place = np.nonzero(one.best > np.iinfo(np.int64).min)
            out.append((one.ids[a], which.astype(np.int32), one.best_ids[a, which, place], one.best[a, which, place]))
        columns = map(np.concatenate, zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int32),
                                                              *(np.zeros(0, np.int64),) * 2)
        return pa.Table.from_arrays([pa.array(c) for c in columns], ["anchor_id", "which", "partner_id", "score"])

    return (left.groupBy("slice", "part").cogroup(right.groupBy("slice", "part"))
            .applyInArrow(run, "anchor_id long, which int, partner_id long, score long"))


def ranked(found, keys, k):
    """The k best of the keys with `rank`, ties to the smaller id."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "partner_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows, anchor_condition, positives=POSITIVES, negatives=NEGATIVES):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over (vec_id, label, v).

    anchor_condition: condition on vec_id and label.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, "whole-vectors")
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)
    index, n_blocks = build_index(rows)
    anchors = rows.where(anchor_condition)
    own = ranked(searched(index, n_blocks, anchors, meet_own_label, positives, 1), ["anchor_id"], positives)
    # At most `positives` for each anchor.
    partners = (own.groupBy(F.col("anchor_id").alias("vec_id"))
                .agg(F.sort_array(F.collect_list(F.struct("rank", "partner_id", "score"))).alias("p"))
                .select("vec_id", F.col("p.partner_id").alias("partner_ids"), F.col("p.score").alias("partner_scores")))
    partners = checkpointed(partners)
    asked = anchors.join(partners, "vec_id")
    found = ranked(searched(index, n_blocks, asked, meet_other_labels, negatives, positives),
                   ["anchor_id", "which"], negatives)
    named = partners.withColumnRenamed("vec_id", "anchor_id")
    return found.join(named, "anchor_id").select(
        "anchor_id", F.get("partner_ids", "which").alias("positive_id"), "rank",
        F.col("partner_id").alias("negative_id"), F.get("partner_scores", "which").alias("positive_score"),
        F.col("score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every vector whose id is divisible by 100, with some labels moved on by one."""
    rows = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
    return mine(rows, F.col("vec_id") % EVERY == 0)


OP11_SQL = f"""
WITH moved AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT * FROM moved QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, q) = 1
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {EVERY} = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LEAST_PERCENT} * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
