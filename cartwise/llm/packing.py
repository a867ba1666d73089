"""Packing tokenised documents into sequences by harmonic classes.

Class k holds pieces of a k-th of the capacity (rounded down), and a sequence of class k takes exactly k of
them, so no piece is compared with any other. Documents may be cut: a document gives whole sequences, then
pieces of the largest classes that leave no crumb behind, and a tail of LEAST tokens or more (unless it is
shorter itself) that fits no class. Tails follow one another in sequences of their own, where the last one
of a sequence goes on in the next. Each task fills the classes of its own documents without a shuffle; what is
open at its end, less than a sequence for each class, is laid out like the tails, and its last rest becomes
sequences whose lengths are powers of two. Padding is what rounding a k-th down leaves, less than k
tokens in a sequence of class k.

Null text counts as empty: such a document is the end mark alone. Repeated rows are packed each. A
null id is kept. sequence_id is unique over tasks (task number in the upper bits) and not gapless.
"""
from itertools import count

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from . import bpe
from .common import id_and_text

CAPACITY = 4096
END_ID = 2
#: Tokens of a piece at least, with a capacity of 512 or more, unless a document or a boundary makes it shorter.
LEAST = 64
_ROWS = 4096
#: Bytes of ids in one Arrow batch of results.
_BYTES = 1 << 23


def least_piece(capacity):
    return max(1, min(LEAST, capacity // 8))


def cuts(length, capacity):
    """(start, length, class) of the pieces of a document; the class of a tail is 0."""
    least, start = least_piece(capacity), 0
    while start < length:
        left = length - start
        for k in range(-(-capacity // left), capacity // least + 1):
            size = capacity // k
            if left == size or left - size >= least:
                yield start, size, k
                start += size
                break
        else:
            yield start, left, 0
            start = length


def split(piece, tokens):
    """A piece (doc_id, start, ids, tokens of the document) in two, the first of so many tokens."""
    doc_id, start, ids, whole = piece
    return (doc_id, start, ids[:4 * tokens], whole), (doc_id, start + tokens, ids[4 * tokens:], whole)


class HarmonicBins:
    """Sequences being filled by one task; `add` and `close` give the finished ones, lists of pieces."""

    def __init__(self, capacity):
        self.capacity = capacity
        self.open = {}
        self.tails, self.held = [], 0

    def add(self, piece, k):
        if not k:
            yield from self.stream([piece])
            return
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            yield self.open.pop(k)

    def stream(self, pieces):
        """One after another into whole sequences; a piece that does not fit goes on in the next one."""
        for piece in pieces:
            while self.held + len(piece[2]) // 4 >= self.capacity:
                first, piece = split(piece, self.capacity - self.held)
                yield [*self.tails, first]
                self.tails, self.held = [], 0
            if piece[2]:
                self.tails.append(piece)
                self.held += len(piece[2]) // 4

    def close(self):
        """All that is open, as whole sequences and then such that are powers of two."""
        rest, self.open = [p for k in sorted(self.open) for p in self.open[k]], {}
        yield from self.stream(rest)
        while self.tails:
            room, taken = 1 << self.held.bit_length() - 1, []
            self.held -= room
            while room:
                piece = self.tails.pop(0)
                first, after = split(piece, min(room, len(piece[2]) // 4))
                taken.append(first)
                room -= len(first[2]) // 4
                if after[2]:
                    self.tails.insert(0, after)
            yield taken


def pack(docs, path=bpe.WORD_BPE, capacity=CAPACITY, end_id=END_ID, id_col="doc_id",
         text_col="text"):
    """Rows (doc_id, start, length, ids, doc_tokens, sequence_id, offset), one per piece.

    ids are packed little-endian unsigned 32-bit; the pieces of a sequence follow one another.
    """
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def run(batches):
        numbers = count(TaskContext.get().partitionId() << 32)
        bins, out, size = HarmonicBins(capacity), [], 0

        def put(sequence):
            number, offset = next(numbers), 0
            for doc_id, start, ids, tokens in sequence:
                out.append((doc_id, start, len(ids) // 4, ids, tokens, number, offset))
                offset += len(ids) // 4

        for batch in batches:
            encoded = bpe.encoder(path).encode(t.as_py() for t in batch.column("text"))
            kind = batch.schema.field("doc_id").type
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                ids += end
                size += len(ids)
                for start, length, k in cuts(len(ids) // 4, capacity):
                    part = ids[4 * start:4 * (start + length)]
                    for full in bins.add((doc_id, start, part, len(ids) // 4), k):
                        put(full)
                if len(out) >= _ROWS or size > _BYTES:
                    yield _batch(out, kind)
                    out, size = [], 0
        for sequence in bins.close():
            put(sequence)
        if out:
            yield _batch(out, kind)

    def _batch(out, kind):
        kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(zip(*out), kinds)],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return rows.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids binary, "
                                "doc_tokens long, sequence_id long, offset long")


def op4_packing(spark, sf_dir):
    """Pieces of every document with their checksums."""
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
