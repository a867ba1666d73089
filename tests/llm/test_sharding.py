import hashlib
from collections import Counter

import pytest
from helpers import documents, empty

from cartwise.llm import sharding


def digits(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain_table(names, size):
    wanted = [[(digits(f"offset:{n}") + j * (digits(f"skip:{n}") % (size - 1) + 1)) % size
               for j in range(size)] for n in names]
    owners, at = [None] * size, [0] * len(names)
    for turn in range(size):
        shard = turn % len(names)
        while owners[wanted[shard][at[shard]]] is not None:
            at[shard] += 1
        owners[wanted[shard][at[shard]]] = shard
    return owners


@pytest.mark.parametrize("count,size", [(1, 2), (3, 7), (5, 101), (7, 503)])
def test_table(spark, count, size):
    names = [f"node {i}" for i in range(count)]
    table = {r.slot: r.shard for r in sharding.lookup_table(spark, names, size).collect()}
    assert [table[i] for i in range(size)] == plain_table(names, size)


def test_placement(spark):
    names = ["a", "b", "c"]
    rows = [(1, "x"), (1, "y"), (None, None), (2, "")]
    got = sharding.assign(documents(spark, rows), names, size=101).collect()
    owners = plain_table(names, 101)
    assert len(got) == 4
    for r in got:
        slot = digits("key:" + ("" if r.doc_id is None else str(r.doc_id))) % 101
        assert (r.slot, r.shard, r.shard_name) == (slot, owners[slot], names[owners[slot]])
    assert sharding.assign(empty(spark), names, size=101).collect() == []


def test_a_shard_that_leaves_moves_little():
    names = [f"s{i}" for i in range(8)]
    before, after = plain_table(names, 809), plain_table(names[:-1], 809)
    moved = sum(b != a for b, a in zip(before, after))
    assert moved < 809 / 8 * 2
    assert max(Counter(before).values()) - min(Counter(before).values()) <= 1


def test_wrong_parameters(spark):
    for names, size in (([], 7), (["a", "a"], 7), (["a"], 8), (list("abc"), 2), (["a"], 40009)):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, names, size)
