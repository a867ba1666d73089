import hashlib
import re

from helpers import documents, empty, words
from pyspark.sql import functions as F

from cartwise.llm import exact_dedup


def brute_force(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    return groups


def test_decisions(spark):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (1, "a b "), (2, None), (7, ""), (8, "A b"),
            (None, "a b"), (4, " "), (6, words(4000))] + [(100 + i, "copy \n of") for i in range(40)]
    got = exact_dedup.decide(documents(spark, rows), capacity=3).collect()
    assert len(got) == len(rows)
    groups = brute_force(rows)
    for r in got:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", dict(rows)[r.doc_id] or "")
        ids = groups[text]
        assert r.keep_id == min(i for i in ids if i is not None)
        assert r.group_size == len(ids) and r.kept == (r.doc_id == r.keep_id)
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert exact_dedup.decide(empty(spark)).collect() == []


def test_repeated_rows_and_null_ids_leave_one(spark):
    rows = [(1, "x")] * 3 + [(None, "y")] * 2 + [(2, "x")]
    got = exact_dedup.decide(documents(spark, rows)).collect()
    assert sorted((r.keep_id or 0, r.kept) for r in got) == [
        (0, False), (0, True), (1, False), (1, False), (1, False), (1, True)]
    kept = exact_dedup.keep_first(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "y"), (1, "x")]


def test_directory_splits_only_overfull_buckets(spark):
    top = [0] * 10 + [1 << 61] * 2 + [-(1 << 62)]
    hashes = spark.createDataFrame([(h + i,) for i, h in enumerate(top)], "h long")
    table = {r.prefix: r.bucket for r in exact_dedup.directory(hashes, 4, 3).collect()}
    # The ten hashes with the bits 000 stay together at the full depth; 001 has depth 3 as their
    # sibling, and 110 is the only entry of the half that begins with 1.
    assert table == {0: 8, 1: 9, 6: 3}
    one = exact_dedup.directory(hashes.limit(3), 4, 3).collect()
    assert {r.bucket for r in one} == {1}


def test_texts_of_one_hash_are_compared(spark, monkeypatch):
    """With a hash that always collides only the bytes tell texts apart."""
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: real(*c) % 2)
    rows = [(i, f"text {i % 7}") for i in range(50)]
    got = exact_dedup.decide(documents(spark, rows)).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(i, i % 7) for i in range(50)}
