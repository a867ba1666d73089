import zlib
from collections import defaultdict

import numpy as np
from helpers import documents, empty, words
from tokenizers import Tokenizer

from cartwise.llm import bpe, packing


def check_sequences(pieces, capacity):
    """Offsets without gaps, hardly any padding but at powers of two; the share of padding."""
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    padding = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
        total = sum(n for _, n in parts)
        assert total <= capacity and all(n > 0 for _, n in parts)
        if total & (total - 1):
            assert capacity - total < len(parts)
            padding += capacity - total
    return padding / max(sum(p.length for p in pieces), 1)


def test_cuts_cover_every_length():
    for capacity, least in ((64, 8), (4096, 64), (1000, 64), (1, 1)):
        for length in (1, 2, 63, 64, 65, 127, 128, 700, 1000, 2049, 4095, 4096, 4097, 64 * 7 + 5, 30_000):
            cut = list(packing.cuts(length, capacity))
            assert [s for s, _, _ in cut] == np.cumsum([0, *[n for _, n, _ in cut]])[:-1].tolist()
            assert sum(n for _, n, _ in cut) == length
            assert all(n == capacity // k for _, n, k in cut if k) and sum(k == 0 for *_, k in cut) <= 1
            assert all(n >= min(least, length) for _, n, _ in cut)


def piece(tokens, name="a"):
    return name, 0, bytes(4 * tokens), tokens


def test_classes_take_a_fixed_number():
    bins = packing.HarmonicBins(16)
    assert list(bins.add(piece(16), 1)) == [[piece(16)]]
    got = [len(full) for i in range(11) for full in bins.add(piece(5, i), 3)]
    assert got == [3, 3, 3]
    assert list(bins.add(piece(7), 0)) == []
    (whole,) = bins.add(piece(10), 0)
    assert [len(ids) // 4 for _, _, ids, _ in whole] == [7, 9]
    rest = [[(start, len(ids) // 4) for _, start, ids, _ in s] for s in bins.close()]
    assert [sum(n for _, n in s) for s in rest] == [8, 2, 1] and rest[0][0] == (9, 1)


def test_every_id_once(spark):
    rows = [(1, words(500)), (2, None), (3, ""), (4, words(9000, 2)), (4, words(9000, 2)), (None, "x y")]
    pieces = packing.pack(documents(spark, rows).repartition(2), capacity=256).collect()
    check_sequences(pieces, 256)
    library = Tokenizer.from_file(bpe.WORD_BPE)
    for doc_id, text in ((1, rows[0][1]), (2, ""), (3, ""), (None, "x y")):
        own = sorted((p.start, bytes(p.ids)) for p in pieces if p.doc_id == doc_id)
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert b"".join(b for _, b in own) == np.array(ids, "<u4").tobytes()
        assert all(p.doc_tokens == len(ids) for p in pieces if p.doc_id == doc_id)
    assert packing.pack(empty(spark)).collect() == []


def test_whole_table(spark, sf_dir):
    pieces = packing.op4_packing(spark, sf_dir).collect()
    assert check_sequences(pieces, packing.CAPACITY) < 0.01
    short = [p for p in pieces if p.length < packing.LEAST and p.length < p.doc_tokens]
    assert len(short) < len(pieces) * 0.1
    library = Tokenizer.from_file(bpe.WORD_BPE)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = np.array([*library.encode(d.text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(by_doc[d.doc_id], key=lambda p: p.start)
        assert sum(p.length for p in own) == len(ids)
        for p in own:
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
