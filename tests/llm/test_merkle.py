import hashlib
import zlib

import pytest
from helpers import documents, empty
from pyspark.sql import functions as F

from cartwise.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """(root, sibling pairs of every leaf)."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, place in enumerate(at):
            first = place - place % 3
            paths[i].append(("".join(nodes[first:place]), "".join(nodes[place + 1:first + 3])))
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at = [a // 3 for a in at]
    return nodes[0], paths


def brute_force(rows):
    """rows (doc_id, source, digest) -> sorted (doc_id, digest, subroot, root, path)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
          for s in sources}
    sub = {s: tree([r[2] for r in of[s]]) for s in sources}
    root, above = tree([sub[s][0] for s in sources])
    return sorted(((-1 if r[0] is None else r[0], r[2], sub[s][0], root, tuple(p + up))
                   for s, up in zip(sources, above) for r, p in zip(of[s], sub[s][1])))


@pytest.mark.parametrize("height", [0, 1, 2, 6])
def test_brute_force(spark, height):
    sizes = {"a": 1, "b": 28, "c": 3, None: 10, "": 9, "é": 2, "=": 30, "B": 82}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7919 % 1009, source, h(str(n))))
            n += 1
    rows += [(None, "a", h("x")), (5, "b", h("y")), (5, "b", h("z")), *[(6, "b", h("copy"))] * 40]
    table = spark.createDataFrame(rows, "doc_id long, source string, leaf string").select(
        "*", F.lit(1).alias("grp"), F.lit(2).alias("place"), F.lit(3).alias("path2")).repartition(7)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.leaf, r.subroot, r.root,
                  tuple((s.left, s.right) for s in r.path))
                 for r in merkle.manifest(table, height=height).collect())
    assert got == brute_force(rows)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 55, 82])
def test_butterfly_of_any_number_of_partitions(spark, count):
    """Every partition ends with the same root and its own way to it."""
    roots = [h(str(i)) for i in range(count)]
    parts = spark.createDataFrame(
        [("g", i, count, [[r]], []) for i, r in enumerate(roots)],
        "grp string, block long, total long, levels array<array<string>>, entries array<string>")
    got = {r.block: (r.root, [(s.left, s.right) for s in r.path])
           for r in merkle.paths(parts, height=0).collect()}
    root, above = tree(roots)
    assert got == {i: (root, p) for i, p in enumerate(above)}


def test_documents(spark, tmp_path):
    rows = [(i, None if i % 9 == 0 else f"text {i}\nline é" * (i % 4)) for i in range(40)] + [(None, "x\n"), (3, "x")]
    docs = documents(spark, rows).withColumn(
        "source", F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string"))))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plain = [(r.doc_id, r.source, leaf(r.doc_id, r.source, r.lang, r.n_chars, r.text), r.lang, r.n_chars, r.text)
             for r in docs.collect()]
    want = {(r[0], r[1]): r for r in brute_force([p[:3] for p in plain])}
    got = merkle.op13_merkle(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for p in plain:
        doc_id, _, digest, *_ = p
        r = next(r for r in got if r.doc_id == doc_id and r.leaf == digest)
        _, _, subroot, root, path = want[-1 if doc_id is None else doc_id, digest]
        assert (r.subroot, r.root) == (subroot, root)
        assert r.proof_sha256 == h(*(left + right for left, right in path))
        even = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 2 == 0
        text = p[5].replace("\n", "") if even and p[5] is not None else p[5]
        node = leaf(p[0], p[1], p[3], p[4], text)
        for left, right in path:
            node = h(left, node, right)
        assert r.folded_root == node and r.verified == (node == root)
    assert {r.verified for r in got} == {True, False}


def test_empty_and_single(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert merkle.op13_merkle(spark, f"{tmp_path}/a").collect() == []
    documents(spark, [(1, "only " * 200_000)]).write.parquet(f"{tmp_path}/b/documents.parquet")
    (r,) = merkle.op13_merkle(spark, f"{tmp_path}/b").collect()
    assert r.leaf == r.subroot == r.root == leaf(1, "src0", "en", 1_000_000, "only " * 200_000)
    assert r.proof_sha256 == h() and r.verified
