import numpy as np
import pytest
from helpers import documents, empty, words

from cartwise.llm import substring_dedup as sd


def chunk_texts(text):
    raw = text.encode()
    ends = sd.chunk_ends(np.frombuffer(raw, np.uint8))
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def test_gear_hash_is_that_of_a_loop():
    data = np.frombuffer(words(60).encode(), np.uint8)
    h, want = 0, []
    for b in data:
        h = ((h << 1) + int(sd._GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert sd.gear(data).tolist() == want


@pytest.mark.parametrize("text", ["", "a", "é" * 2000, words(3000), "x" * 5000, "日本語" * 400])
def test_chunks_cover_the_text(text):
    parts = chunk_texts(text)
    assert b"".join(parts) == text.encode()
    assert all(len(p) <= sd.MOST for p in parts) and "".join(p.decode() for p in parts) == text
    assert all(len(p) >= sd.LEAST for p in parts[:-1])


def test_insertion_shifts_few_chunks():
    text = words(3000)
    own, changed = chunk_texts(text), chunk_texts(text[:5000] + "inserted words " + text[5000:])
    assert len(set(changed) - set(own)) <= 8


def test_passages_are_found_and_lines_left(spark):
    passage, line = words(60, 1), "All rights reserved by nobody at all."
    rows = [(1, f"{line}\n{words(200, 2)} {passage} {words(200, 3)}"),
            (2, f"{line}\n{words(150, 4)} {passage}"),
            (3, f"{line}\n{words(300, 5)}"), (4, None), (5, ""), (6, f"{passage} {words(10, 6)}"),
            (None, f"x {passage}")]
    docs = documents(spark, rows)
    spans = sd.repeated_spans(docs).collect()
    assert {r.doc_id for r in spans} == {2, 6, None} and {r.first_id for r in spans} == {1}
    for r in spans:
        found = dict(rows)[r.doc_id][r.start:r.end]
        assert found in rows[0][1] and len(found) > len(passage) / 2
    cleaned = sd.remove_repeats(docs)
    assert cleaned.columns == docs.columns
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert all(texts[i] == dict(rows)[i] for i in (1, 3, 4, 5))
    for i in (2, 6, None):
        kept = texts[i].split()
        assert set(kept) <= set(dict(rows)[i].split()) and len(kept) < len(dict(rows)[i].split()) - 20
    assert sd.repeated_spans(empty(spark)).collect() == []


def test_repeated_ids_and_repetitions_within_a_document(spark):
    a, b = words(400, 1), words(300, 8)
    rows = [(1, a), (1, a), (2, a), (2, words(300, 7)), (3, a[100:] + a), (4, b + " " + b), (4, b)]
    spans = sd.repeated_spans(documents(spark, rows)).collect()
    assert {2, 3} == {r.doc_id for r in spans}
    texts = [r.text for r in sd.remove_repeats(documents(spark, rows)).collect()]
    assert texts.count(a) == 2 and rows[3][1] in texts and {b, b + " " + b} <= set(texts)


def plain_windows(text):
    """(start, end) in bytes of each window: chunk after chunk until there are enough whole words or bytes."""
    raw = text.encode()
    ends = sd.chunk_ends(np.frombuffer(raw, np.uint8))
    starts = [0, *ends]
    spaces = b" \t\n\x0b\x0c\r"
    for i, a in enumerate(starts[:-1]):
        for b in ends[i:]:
            piece = raw[a:b]
            inner = piece.split()
            cut_left = a > 0 and raw[a - 1] not in spaces and piece[0] not in spaces
            cut_right = b < len(raw) and raw[b] not in spaces and piece[-1] not in spaces
            if len(inner) == 1 and cut_left and cut_right:
                count = 0
            else:
                count = max(len(inner) - cut_left - cut_right, 0)
            if count >= sd.MIN_WORDS or b - a >= sd.MIN_WORDS * sd.WORD_BYTES:
                yield a, b
                break


def plain_spans(docs):
    """{(doc_id, start, length, inside)} of docs (doc_id, text) with distinct ids, by the rule of the docstring."""
    first, found = {}, set()
    docs = sorted(docs)
    for i, t in docs:
        for a, b in plain_windows(t):
            first.setdefault(t.encode()[a:b], i)
    for i, t in docs:
        raw, seen = t.encode(), set()
        groups = {False: [], True: []}
        for a, b in plain_windows(t):
            w = raw[a:b]
            if first[w] != i:
                groups[False].append((a, b))
            elif w in seen:
                groups[True].append((a, b))
            seen.add(w)
        for inside, places in groups.items():
            runs = []
            for a, b in places:
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(b, runs[-1][1])
                else:
                    runs.append([a, b])
            found |= {(i, len(raw[:a].decode()), len(raw[a:b].decode()), inside) for a, b in runs}
    return found


def test_spans_by_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sd.op2_substring_dedup(spark, sf_dir).collect()
    assert {(r.doc_id, r.start, r.length, r.inside) for r in got} == plain_spans(docs)
    texts = dict(docs)
    for r in got:
        whole = texts[r.doc_id]
        inner = len(whole[r.start:r.start + r.length].split())
        assert inner - 2 <= r.words <= inner or r.words == 0


def test_every_span_stands_in_another_document(spark):
    """Documents of shuffled sentences of one pattern: what is taken has 16 words that another has in this order."""
    import random
    own = random.Random(4)
    sentences = [f"The {own.choice('abcdef')}{i} report says that item {own.randrange(99)} is fine." for i in range(300)]
    docs = [(i, " ".join(own.sample(sentences, 6))) for i in range(400)]
    spans = sd.repeated_spans(documents(spark, docs)).collect()
    texts = dict(docs)
    runs = {}
    for i, t in docs:
        w = t.split()
        for n in range(len(w) - 15):
            runs.setdefault(tuple(w[n:n + 16]), set()).add(i)
    for r in spans:
        w = texts[r.doc_id][r.start:r.end].split()
        assert any(len(runs.get(tuple(w[n:n + 16]), set()) - {r.doc_id}) for n in range(len(w) - 15))
    # Two sentences in this order are 18 words: those that are found are nearly all there are.
    shared = {(i, n) for i, t in docs for n in range(len(t.split()) - 15)
              if min(runs[tuple(t.split()[n:n + 16])]) < i}
    assert {i for i, _ in shared} >= {r.doc_id for r in spans}


def test_text_without_white_space(spark):
    chinese = "".join(chr(0x4e00 + (i * i * 7919 + i) % 20000) for i in range(3000))
    plain = "".join(chr(97 + (i * i * 31 + i // 7) % 26) for i in range(5000))
    rows = [(1, chinese), (2, "前" * 9 + chinese), (3, plain), (4, words(5) + plain)]
    spans = {r.doc_id: r for r in sd.repeated_spans(documents(spark, rows)).collect()}
    assert set(spans) == {2, 4}
    assert spans[2].end - spans[2].start > 2800 and spans[4].end - spans[4].start > 4700


def test_repetitions_inside_a_document(spark):
    passage = words(60, 1)
    rows = [(1, f"{passage} {words(30, 2)} {passage} {words(30, 3)} {passage}"), (2, words(50, 4))]
    docs = documents(spark, rows)
    assert sd.repeated_spans(docs).collect() == []
    spans = sorted(sd.repeated_spans(docs, inside=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in spans] == [1, 1] and all(r.inside and r.first_id == 1 for r in spans)
    kept = {r.doc_id: r.text for r in sd.remove_repeats(docs, inside=True).collect()}
    assert kept[2] == rows[1][1] and 120 <= len(kept[1].split()) < 180
    assert sd.remove_repeats(docs).exceptAll(docs).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a", words(300), "x" * 900, "日本語 " * 200, "to " * 300, "é" * 700])
def test_windows_by_brute_force(text):
    start, length, words_in, inside, before, digests = sd.windows_of(text)
    raw = text.encode()
    got = [(len(text[:a].encode()), len(text[:a + n].encode())) for a, n in zip(start.tolist(), length.tolist())]
    want = list(plain_windows(text))
    assert got == want and len(digests) == len(want)
    seen = set()
    for (a, b), again in zip(want, inside):
        assert again == (raw[a:b] in seen)
        seen.add(raw[a:b])


def test_texts_of_one_id_are_told_apart(spark):
    """Of 700 texts of an id some have equal 16-bit hashes; each has a passage of document 1 elsewhere."""
    passage = words(60, 1)
    texts = [f"{words(20 + i % 90, 1000 + i)} {passage} {words(12, 5000 + i)}" for i in range(700)]
    docs = documents(spark, [(1, passage), *((2, t) for t in texts)])
    spans = sd.repeated_spans(docs).collect()
    assert len({r.text_number for r in spans}) == len(texts) == len(spans)
    kept = [r.text.split() for r in sd.remove_repeats(docs).where("doc_id = 2").collect()]
    own = [{*t.split()} - {*passage.split()} for t in texts]
    assert sorted(map(sorted, ({*k} - {*passage.split()} for k in kept))) == sorted(map(sorted, own))
    assert sum(map(len, kept)) < sum(len(t.split()) for t in texts) - sd.MIN_WORDS * len(texts)


def test_rows_without_id_are_documents(spark):
    passage, whole = words(60, 1), words(80, 2)
    rows = [(None, f"{words(30, 3)} {passage}"), (None, f"{passage} {words(30, 4)}"), (None, whole), (None, whole)]
    docs = documents(spark, rows)
    assert sum(r.first_id is None for r in sd.repeated_spans(docs).collect()) == 2
    texts = [r.text for r in sd.remove_repeats(docs).collect()]
    assert len(texts) == 4 and texts.count(whole) == 1 and "" in texts
    assert sorted(len(t.split()) > 80 for t in texts if t not in ("", whole)) == [False, True]
