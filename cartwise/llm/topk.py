"""Exact top-k inner products with an impact-ordered index, score at a time.

Vectors are indexed in blocks. The index of a block is its postings: for every dimension and every value that
occurs in it the rows that have it, the lists in order of falling impact (the value's magnitude); zeros have
none. All queries of a block of queries go through the lists together and add value times query component to
the accumulators of the rows. The lists fall into segments by powers of two, and after a segment what is left
of a vector is bounded by Cauchy-Schwarz: the norm of the query times the norm of the vector's postings in
later segments. A query is settled when its k-th best lower bound - of this block, or k scores that earlier
blocks have - leaves few possible members; those are scored again exactly from the whole vectors. Vectors that
share the k-th score are possible members, so ties are broken by the smaller id. Nothing is dropped without
that proof.

The index is written once to the shared folder. Queries are sent to slices of it; a slice is kept once
for every PART blocks of queries, and a cell of slice and part is a task that returns the best of its
slice only.

Components are floor(scale * x). Vectors that are null or hold a null or non-finite component take no
part; shorter vectors count as filled up with zeros, empty ones score zero. Rows repeated with id and
vector are one. A vector is no candidate for a query with its own id; null ids take no part. A score beyond
64 bits is an error.
"""
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..staging import checkpointed, new_folder

SCALE = 64
K = 20
#: Vectors in a block of candidates, and in a block of queries.
BLOCK, QUERY_BLOCK = 4096, 512
#: Blocks of the index in a slice at most on average, and blocks of queries that meet it together.
SLICE, PART = 16, 64
#: Lower ends of the ranges of magnitudes, as powers of two: 16 and more, 8 to 15, 4 to 7, below.
SEGMENTS = (16, 8, 4, 0)
#: A query with at most this share of a block as possible members is settled.
_FEW = 1 / 16
#: Lengths whose product is below this have all products of components and their sums exact as doubles.
_EXACT = 2.0 ** 52


def quantised(vectors, id_col="vec_id", vector_col="embedding", scale=SCALE):
    """(vec_id, v): the vectors that take part, with components floor(scale * x)."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))

    def component(c):
        scaled = c.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0 ** 62, F.floor(scaled)).otherwise(
            F.raise_error(F.lit("a component is too large for 64 bits")).cast("long"))

    whole = F.transform(x, component)
    return (vectors.where(x.isNotNull() & F.col(id_col).isNotNull() & finite)
            .select(F.col(id_col).alias("vec_id"), whole.alias("v")).dropDuplicates())


#: What a block of the index has, and a block of queries (the first two).
_ARRAYS = {"ids": np.int64, "data": np.int64, "rows": np.int32, "starts": np.int64, "values": np.int64,
           "dims": np.int64, "left": np.float64}


def postings(data):
    """The lists of a block by falling impact: rows of all lists, starts of the lists, their value and dimension."""
    row, dim = np.nonzero(data)
    value = data[row, dim]
    order = np.lexsort((row, dim, value, -np.abs(value)))
    row, dim, value = row[order], dim[order], value[order]
    new = np.append(True, (value[1:] != value[:-1]) | (dim[1:] != dim[:-1]))[:len(row)]
    starts = np.flatnonzero(new)
    return {"rows": row, "starts": starts, "values": value[starts], "dims": dim[starts]}


def indexed(ids, data):
    """The arrays of a block, in order of the ids: of equal scores the smaller id comes first."""
    order = np.argsort(ids, kind="stable")
    ids, data = ids[order], data[order]
    size = np.abs(data)
    # The length of what later segments hold of each vector.
    left = [np.sqrt((np.where(size < least, data, 0).astype(float) ** 2).sum(1)) for least in SEGMENTS]
    return {"ids": ids, "data": data, "left": np.array(left), **postings(data)}


def packed_blocks(rows, size, with_index):
    """Blocks of up to `size` vectors as bytes, packed within a task, with or without their index."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                lists = part.column("v")
                lengths = np.diff(lists.offsets.to_numpy())
                data = np.zeros((len(lengths), max(lengths.max(), 1)), np.int64)
                data[np.arange(data.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
                ids = part.column("vec_id").cast(pa.int64()).to_numpy()
                arrays = indexed(ids, data) if with_index else {"ids": ids, "data": data}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([len(ids)]), *(
                        pa.array([np.ascontiguousarray(arrays[c], kind).tobytes() if c in arrays else None],
                                 pa.binary()) for c, kind in _ARRAYS.items())], ["block", "n", *_ARRAYS])
                number += 1

    return rows.mapInArrow(run, "block long, n long, " + ", ".join(f"{c} binary" for c in _ARRAYS))


def unpacked(row):
    out = {c: np.frombuffer(row[c], kind) for c, kind in _ARRAYS.items() if row[c] is not None}
    out["data"] = out["data"].reshape(row["n"], -1)
    if "left" in out:
        out["left"] = out["left"].reshape(len(SEGMENTS), -1)
    return out


def exact_scores(query_id, query, ids, data):
    """Inner products in whole numbers; one that 64 bits cannot hold is an error."""
    scores = [sum(a * b for a, b in zip(query.tolist(), row)) for row in data.tolist()]
    for other, s in zip(ids.tolist(), scores):
        if not -(1 << 63) < s < 1 << 63:
            raise ValueError(f"the score of vec_id {query_id} and {other} does not fit into 64 bits")
    return np.array(scores, np.int64)


def top(block, query_ids, queries, k, floor):
    """(query row, vector ids, scores) for each query: its k best of a block that can reach its floor.

    floor: scores that k vectors of other blocks are known to reach, per query.
    """
    ids, data = block["ids"], block["data"]
    width = max(data.shape[1], queries.shape[1])
    if data.shape[1] < width or queries.shape[1] < width:
        data, queries = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (data, queries))
    n, norms = len(ids), np.sqrt((queries.astype(float) ** 2).sum(1))
    longest = norms.max(initial=0) * np.sqrt((data.astype(float) ** 2).sum(1)).max(initial=0)
    # The query's own vector is never a member.
    place = np.searchsorted(ids, query_ids, side="left")
    until = np.searchsorted(ids, query_ids, side="right")
    if longest >= _EXACT:
        for r, (a, b) in enumerate(zip(place, until)):
            others = np.append(np.arange(a), np.arange(b, n))
            exact = exact_scores(query_ids[r], queries[r], ids[others], data[others])
            chosen = np.argsort(-exact, kind="stable")[:k]
            yield r, ids[others[chosen]], exact[chosen]
        return
    # Single precision holds these integers exactly as long as no sum can pass 2**24.
    largest = np.abs(queries).max(initial=0) * float(np.abs(data).max(initial=0)) * width
    kind = np.float32 if largest < 1 << 24 else np.float64
    rows = np.arange(len(queries))
    scores = np.zeros((n, len(queries)), kind)
    for r in np.flatnonzero(until > place):
        scores[place[r]:until[r], r] = -np.inf
    by_dim = np.ascontiguousarray(queries.T, kind)
    ends = np.append(block["starts"][1:], len(block["rows"]))
    impact, at = np.abs(block["values"]), 0
    for number, least in enumerate(SEGMENTS):
        if not len(rows):
            return
        while at < len(impact) and impact[at] >= least:
            members = block["rows"][block["starts"][at]:ends[at]]
            scores[members] += by_dim[block["dims"][at]] * kind(block["values"][at])
            at += 1
        last = number + 1 == len(SEGMENTS)
        slack = (block["left"][number][:, None] * (norms[rows] * 1.00001)).astype(kind)
        lower = scores - slack
        best = (np.partition(np.ascontiguousarray(lower.T), n - k, axis=1)[:, n - k] if n > k
                else np.full(len(rows), -np.inf))
        proved = np.maximum(best, floor[rows])
        # Scores are whole: half a unit is room for rounding and loses no proof.
        possible = (scores + slack >= proved - 0.5) & (scores > -np.inf)
        settled = possible.sum(0) <= (n if last else max(k, n * _FEW))
        for i in np.flatnonzero(settled):
            members = np.flatnonzero(possible[:, i])
            exact = data[members] @ queries[rows[i]]
            chosen = np.argsort(-exact, kind="stable")[:k]
            yield rows[i], ids[members[chosen]], exact[chosen]
        if settled.any():
            # Rows stay next to each other in memory: the lists add to whole rows.
            rows, by_dim = rows[~settled], np.compress(~settled, by_dim, axis=1)
            scores = np.ascontiguousarray(np.compress(~settled, scores, axis=1))


def together(blocks, size):
    """(ids, data) of small blocks put together to blocks of about `size` vectors."""
    ids, parts = [], []
    for block in blocks:
        ids.append(block["ids"])
        parts.append(block["data"])
        if sum(map(len, ids)) >= size:
            yield _joined(ids, parts)
            ids, parts = [], []
    if ids:
        yield _joined(ids, parts)


def _joined(ids, parts):
    width = max(p.shape[1] for p in parts)
    return np.concatenate(ids), np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


class Best:
    """A block of queries and the k best that a task has found for each."""

    def __init__(self, ids, data, k):
        self.query_ids, self.queries, self.k = ids, data, k
        self.ids = [np.zeros(0, np.int64)] * len(self.query_ids)
        self.scores = list(self.ids)

    def meet(self, block):
        floor = np.array([s[-1] if len(s) == self.k else -np.inf for s in self.scores], float)
        for r, ids, scores in top(block, self.query_ids, self.queries, self.k, floor):
            ids, scores = np.concatenate([self.ids[r], ids]), np.concatenate([self.scores[r], scores])
            order = np.lexsort((ids, -scores))[:self.k]
            self.ids[r], self.scores[r] = ids[order], scores[order]


def search(queries, candidates, k=K):
    """(query_id, rank, vec_id, score): the k best of the candidates (vec_id, v) for each query."""
    spark = queries.sparkSession
    folder = new_folder(spark, "impact-index")
    packed_blocks(candidates, BLOCK, True).write.parquet(folder)
    index, asked = spark.read.parquet(folder), checkpointed(packed_blocks(queries, QUERY_BLOCK, False))
    n_blocks, parts = index.count(), max(1, -(-asked.count() // PART))
    slices = max(1, -(-n_blocks // SLICE), min(n_blocks, 2 * spark.sparkContext.defaultParallelism))

    def dealt(table, own, of, other, n):
        return table.select("*", F.pmod(F.xxhash64("block"), F.lit(of)).alias(own), F.explode(
            F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(other))

    def run(of_index, of_queries):
        held = [Best(ids, data, k) for ids, data in together(map(unpacked, of_queries.to_pylist()), QUERY_BLOCK)]
        for batch in of_index.to_batches(1):
            block = unpacked(batch.to_pylist()[0])
            for one in held:
                one.meet(block)
        counts = [len(s) for one in held for s in one.scores]
        query_ids = np.concatenate([one.query_ids for one in held] or [np.zeros(0, np.int64)])
        found = [np.concatenate([x for one in held for x in getattr(one, name)] or [np.zeros(0, np.int64)])
                 for name in ("ids", "scores")]
        return pa.Table.from_arrays(
            [pa.array(np.repeat(query_ids, counts)), *map(pa.array, found)], ["query_id", "vec_id", "score"])

    found = (dealt(index, "slice", slices, "part", parts).groupBy("slice", "part")
             .cogroup(dealt(asked, "part", parts, "slice", slices).groupBy("slice", "part"))
             .applyInArrow(run, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_topk(spark, sf_dir):
    """The 20 nearest of all vectors for every vector whose id is divisible by 20."""
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(vectors.where("vec_id % 20 = 0"), vectors)


OP9_SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
         AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
