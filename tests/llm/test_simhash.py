import numpy as np
import xxhash
from helpers import documents, empty, words

from cartwise.llm import components, simhash


def plain_fingerprint(text):
    w = [x for x in (text or "").encode().lower().split()]
    runs = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(fps):
    """fps: id -> fingerprint; smallest id reachable over distances of at most 3."""
    left, out = set(fps), {}
    while left:
        group, todo = set(), [min(left)]
        while todo:
            a = todo.pop()
            if a not in group:
                group.add(a)
                todo += [b for b in left if (fps[a] ^ fps[b]).bit_count() <= 3 and b not in group]
        out.update(dict.fromkeys(group, min(group)))
        left -= group
    return out


def test_fingerprints():
    for text in ("", " \t", "One", "one  TWO", "a b c", "É é", words(400), "a b " * 50):
        assert int.from_bytes(simhash.fingerprint(text), "big") == plain_fingerprint(text)


def test_blocks_of_a_long_text():
    text = words(150_000)
    assert len(text) > 1 << 19
    assert int.from_bytes(simhash.fingerprint(text), "big") == plain_fingerprint(text)


def near(seed=1, groups=40, size=30):
    own = np.random.RandomState(seed)
    base = own.randint(0, 1 << 62, groups)
    fps = [int(b) ^ sum(1 << int(x) for x in own.choice(64, own.randint(0, 4), replace=False))
           for b in base for _ in range(size)]
    return fps + [0, (1 << 64) - 1, 7]


def test_near_pairs_are_those_of_brute_force():
    fps = near(groups=9)
    group = np.sort(np.random.RandomState(2).randint(0, 3, len(fps)))
    got = {(int(a), int(b)) for x, y in simhash.near_pairs(np.array(fps, np.uint64), group)
           for a, b in zip(x, y)}
    want = {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps))
            if group[a] == group[b] and (fps[a] ^ fps[b]).bit_count() <= 3}
    assert got == want


def test_linked_as_by_brute_force_with_split_buckets(spark):
    fps = list(dict.fromkeys(near()))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.links(simhash.tiles(simhash.buckets(rows), tile=16))
    roots = {r.node: r.component for r in components.components(found).collect()}
    want = plain_components(dict(enumerate(fps)))
    sets = {}
    for i, f in enumerate(signed):
        sets.setdefault(roots.get(f, f), set()).add(i)
    truth = {}
    for i, root in want.items():
        truth.setdefault(root, set()).add(i)
    assert sorted(map(sorted, sets.values())) == sorted(map(sorted, truth.values()))


def test_components_of_a_chain_and_a_hub(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 60)] + [(5, 5), (100, 101)]
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(60)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_documents(spark):
    base = words(300)
    texts = [base, base.upper(), base + " end", None, "", "  ", "one", words(200, 9)]
    rows = [*enumerate(texts, 10), (10, base), (None, "one")]
    got = simhash.groups(documents(spark, rows)).collect()
    fps = {i: plain_fingerprint(t) for i, t in rows if i is not None}
    want = plain_components(fps)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert int(r.fingerprint, 16) == fps[r.doc_id] and len(r.fingerprint) == 16
            assert r.component_id == want[r.doc_id]
    assert simhash.groups(empty(spark)).collect() == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fps = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id)
           for r in simhash.op6_simhash(spark, sf_dir).collect()}
    want = plain_components(fps)
    assert got == {i: (f, want[i]) for i, f in fps.items()}


def test_long_texts_with_spaces_that_separate_no_words():
    """Only ASCII white space separates words, also where a long text is cut."""
    for piece in ("aB c!", "x\u0085　y ", "!\x1c!", "q  \x1f\n"):
        text = " ".join([piece * (200_000 // len(piece))] * 4)
        assert len(text) > 1 << 19
        assert int.from_bytes(simhash.fingerprint(text), "big") == plain_fingerprint(text)
