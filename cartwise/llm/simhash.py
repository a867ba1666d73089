"""SimHash fingerprints and their near-duplicate groups by bit-sliced comparison.

Two fingerprints within the radius agree on at least two of `radius + 2` blocks of bits, so every
distinct fingerprint goes to one bucket for each pair of blocks and only buckets are compared. A
bucket larger than TILE is divided into parts and every pair of parts is compared in a task of its
own, so a bucket of any size is spread and none is cut short.

Within a task the fingerprints lie in blocks of 64 with their bits stored vertically: one word per
bit plane holds that bit of 64 fingerprints. Planes are XORed with the bit of a query and counted by
carry-save counters (ones, twos, more), which updates 64 distances at once; a block is abandoned as
soon as all of its counters exceed the radius. Of the pairs found only a spanning forest of the
bucket leaves the task. Equal fingerprints are one node from the start.

Null and empty texts have no words and the fingerprint zero, linked like any other. Null ids count
for no component (one of null ids alone is null). An empty table gives an empty result.
"""
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ..staging import checkpointed
from .common import ASCII_SPACE, apart, blocks, id_and_text
from .components import components

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints of a bucket that are compared within one task.
TILE = 2048
#: Planes counted between two checks for blocks that can be abandoned.
_PLANES = 8
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_ONE = np.uint64(1)


def fingerprint(text, shingle=SHINGLE):
    """Fingerprint of a text as 8 bytes, highest bit first.

    Words are runs of non-space bytes in ASCII lower case; a bit is 1 if it is set in over half of
    the hashes of the word shingles, repeats included.
    """
    counts, total, carried = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_digest
    for block in blocks(text, space=ASCII_SPACE):
        words = carried + block.encode().lower().split()
        if len(words) >= shingle:
            runs = zip(*(words[i:] for i in range(shingle)))
            hashes = b"".join([digest(b" ".join(r), SEED) for r in runs])
            bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
            counts += bits.sum(0, dtype=np.int64)
            total += len(bits)
            carried = words[len(words) - shingle + 1:]
        else:
            carried = words
    if not total:
        return digest(b" ".join(carried), SEED) if carried else bytes(8)
    return np.packbits(counts * 2 > total).tobytes()


def fingerprints(docs, shingle=SHINGLE, id_col="doc_id", text_col="text"):
    """doc_id and fingerprint (bigint with the 64 bits) of every row."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        packed = b"".join(fingerprint(t, shingle) for t in texts)
        return pd.Series(np.frombuffer(packed, ">i8").astype(np.int64))

    return id_and_text(docs, id_col, text_col).select("doc_id", hashed("text").alias("fp"))


def buckets(distinct, radius=RADIUS):
    """(which, key, fp): a row for each pair of blocks of a fingerprint."""
    edges = np.linspace(0, BITS, radius + 3).round().astype(int).tolist()
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    pairs = [x | y for x, y in combinations(masks, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in pairs]
    keys = F.array(*[F.struct(F.lit(i).alias("which"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(signed)])
    return distinct.select("fp", F.explode(keys).alias("b")).select("b.which", "b.key", "fp")


def tiles(bucketed, tile=TILE):
    """Rows (which, key, i, j, fp) of the buckets with two fingerprints or more."""
    sizes = (bucketed.groupBy("which", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    parts = F.ceil(F.col("n") / tile).cast("int")
    part = F.pmod(F.xxhash64("fp"), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return (bucketed.join(apart(sizes), ["which", "key"])
            .select("which", "key", "fp", parts.alias("parts"), part.alias("part"))
            .select("which", "key", "fp", "part", other.alias("other"))
            .select("which", "key", F.least("part", "other").alias("i"),
                    F.greatest("part", "other").alias("j"), "fp"))


def near_pairs(fps, group, radius=RADIUS):
    """Yield index arrays (a, b) of the pairs a < b within the radius and in the same group.

    fps: uint64 fingerprints ordered by group; group: number of the group of each.
    """
    if radius != 3:
        raise ValueError("the counters are made for a radius of 3")
    n = len(fps)
    size = -(-n // 64)
    padded = np.zeros(size * 64, np.uint64)
    padded[:n] = fps
    planes = [np.packbits(((padded >> np.uint64(b)) & _ONE).astype(np.uint8), bitorder="little")
              .view("<u8") for b in range(BITS)]
    end = np.searchsorted(group, group, side="right")
    rows = np.arange(n)
    last = (end - 1) // 64
    for step in range(int((last - rows // 64).max(initial=-1)) + 1):
        query = rows[last >= rows // 64 + step]
        block = query // 64 + step
        # Members of the block that come after the query and belong to its group.
        low = np.maximum(query + 1 - block * 64, 0).astype(np.uint64)
        high = np.minimum(end[query] - block * 64, 64)
        some = high > low.astype(np.int64)
        query, block, low, high = query[some], block[some], low[some], high[some].astype(np.uint64)
        wanted = (_ALL << low) & (_ALL >> (np.uint64(64) - high))
        bits = fps[query]
        ones, twos, more = (np.zeros(len(query), np.uint64) for _ in range(3))
        for start in range(0, BITS, _PLANES):
            for b in range(start, start + _PLANES):
                different = planes[b][block] ^ (np.uint64(0) - ((bits >> np.uint64(b)) & _ONE))
                carry = ones & different
                ones ^= different
                more |= twos & carry
                twos ^= carry
            alive = (wanted & ~more) != 0
            if not alive.all():
                query, block, wanted, bits, ones, twos, more = (
                    x[alive] for x in (query, block, wanted, bits, ones, twos, more))
        near = wanted & ~more
        for bit in range(64):
            hit = (near >> np.uint64(bit)) & _ONE > 0
            if hit.any():
                yield query[hit], block[hit] * 64 + bit


def joined(label, a, b):
    """Merge the sets of a and b in `label`, where label[i] is the smallest member known."""
    while True:
        x, y = label[a], label[b]
        different = x != y
        if not different.any():
            return
        a, b, x, y = a[different], b[different], x[different], y[different]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label[:] = shorter


def links(tiled, radius=RADIUS):
    """Links (a, b) that connect what is within the radius, a spanning forest for each tile."""
    dealt = tiled.repartition("which", "key", "i", "j").sortWithinPartitions("which", "key", "i", "j")

    def compared(columns, fps):
        new = np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0))
        fps, label = fps.view(np.uint64), np.arange(len(fps))
        for a, b in near_pairs(fps, np.cumsum(new), radius):
            joined(label, a, b)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[linked].view(np.int64)), pa.array(fps[label[linked]].view(np.int64))],
            ["a", "b"])

    def run(batches):
        held = None  # rows of a tile that goes on in the next batch
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("which", "key", "i", "j", "fp")]
            if held is not None:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
            if not len(columns[0]):
                continue
            tail = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:4]], axis=0))
            cut = tail[-1] + 1 if len(tail) else 0
            held = [c[cut:] for c in columns]
            if cut:
                yield compared([c[:cut] for c in columns[:4]], columns[4][:cut].copy())
        if held is not None and len(held[0]):
            yield compared(held[:4], held[4].copy())

    return dealt.mapInArrow(run, "a long, b long")


def groups(docs, shingle=SHINGLE, radius=RADIUS, tile=TILE, id_col="doc_id", text_col="text"):
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    hashed = checkpointed(fingerprints(docs, shingle, id_col, text_col))
    distinct = hashed.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = links(tiles(buckets(distinct.select("fp"), radius), tile), radius)
    stars = components(found).withColumnRenamed("node", "fp")
    of_fp = distinct.join(stars, "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root"))
    smallest = of_fp.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = of_fp.join(apart(smallest), "root").select("fp", "component_id")
    return hashed.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs, id_col="doc_id", text_col="text"):
    """The document of each group with the smallest id, with all its columns.

    Rows that share an id stay or go together; a group of null ids alone stays whole.
    """
    kept = (groups(docs, id_col=id_col, text_col=text_col)
            .where("doc_id <=> component_id").select(F.col("doc_id").alias("kept_id")))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"))
    return rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")


def op6_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
