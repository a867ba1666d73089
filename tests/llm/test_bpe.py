import random

import numpy as np
import pytest
from helpers import documents, empty
from tokenizers import Tokenizer

from cartwise.llm import bpe

LETTERS = ["a", "b", "'s", " ", "th", "e", "é", "́", "1", "!", "Σ", "<|endoftext|>", "\n", "ing",
           "İ", "ß", "\x1f", " ", "\U0001f600", "don't"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.WORD_BPE)


def same(library, texts, own):
    for text, packed in zip(texts, own.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(text[:80])
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_same_as_library_on_odd_texts(library):
    random.seed(3)
    texts = ["".join(random.choices([*LETTERS, chr(random.randrange(32, 0x3000))], k=random.randrange(40)))
             for _ in range(1500)]
    texts += ["", "  ", "aaaaaaa aaaa", "x" * 3000, "!?" * 900, "ΑΣ ΑΣ.", "日本語 漢字", "½²Ⅷ １２３"]
    same(library, texts, bpe.Encoder(bpe.WORD_BPE))


def test_small_memory_and_long_texts(library):
    long = " ".join(f"word{i % 977} naïve{i % 31}." for i in range(60_000))
    assert len(long) > bpe.GROUP_CHARS
    same(library, [long, "short", long[:1000]], bpe.Encoder(bpe.WORD_BPE, memory_words=50))


@pytest.mark.parametrize("piece", ["!\x1c!", "!\x1f?", "aB\u00a0c!", "x\u0085y ", "a\u3000'b", "e\u2028\u0301", "日本\x1dé "])
def test_long_texts_are_cut_only_where_the_tokenizer_cuts(library, piece):
    text = piece * (bpe.GROUP_CHARS * 5 // 4 // len(piece))
    assert len(text) > bpe.GROUP_CHARS
    same(library, [text], bpe.Encoder(bpe.WORD_BPE))


def test_rows(spark, library):
    rows = [(1, "Hello World"), (1, "Hello World"), (None, "x"), (3, None), (4, "")]
    got = bpe.encode(documents(spark, rows)).collect()
    assert len(got) == 5
    by_id = {r.doc_id: r for r in got}
    assert np.frombuffer(by_id[1].ids, "<u4").tolist() == library.encode("Hello World").ids
    assert bytes(by_id[3].ids) == b"" and by_id[4].decoded == "" and by_id[None].decoded == "x</w>"
    assert bpe.encode(empty(spark)).collect() == []


def test_whole_table(spark, sf_dir, library):
    import hashlib
    got = {r.doc_id: r for r in bpe.op8_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
