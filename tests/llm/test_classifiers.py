import zlib

import numpy as np
import pytest
from helpers import documents, empty, words
from pyspark.sql import functions as F

from cartwise.llm import quality, toxicity

SMALL = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def no_score(frame):
    return [r for r in frame.collect() if not 0 <= r.score <= 1]


def test_gradient_is_that_of_differences():
    own = np.random.RandomState(1)
    bags = [own.rand(n, quality.FEATURES).astype(np.float32) for n in (1, 4, 2, 7)]
    y = np.array([0, 1, 1, 0], float)
    model = quality.AttentionModel().fit(bags, y, steps=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x = (np.concatenate(bags).astype(float) - model.mean) / model.scale
    starts, weight = np.array([0, 1, 5, 7]), np.full(4, 0.25)

    def loss():
        logit = model._forward(x, starts)[-1]
        return (weight * (np.log1p(np.exp(logit)) - y * logit)).sum()

    gradient = model._gradient(x, starts, y, weight)
    for name in ("W", "V", "U", "w", "c", "d"):
        flat = np.atleast_1d(model.weights[name]).copy()
        shape, i = np.shape(model.weights[name]), flat.size // 3
        values = []
        for step in (1e-5, -1e-5):
            moved = flat.copy().ravel()
            moved[i] += step
            model.weights[name] = moved.reshape(shape)
            values.append(loss())
        model.weights[name] = flat.reshape(shape)
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(np.ravel(gradient[name])[i], abs=1e-6)


def test_scores_by_the_formula_document_by_document():
    """h = tanh(Wx + b), gated attention, weighted mean, score: one passage after another."""
    own = np.random.RandomState(5)
    bags = [own.rand(n, quality.FEATURES).astype(np.float32) for n in (1, 9, 2, 30, 5)]
    model = quality.AttentionModel().fit(bags, [0, 1, 1, 0, 1], steps=20)
    p = {k: np.asarray(v, float) for k, v in model.weights.items()}
    for bag, got in zip(bags, model.scores(bags)):
        hidden, strength = [], []
        for passage in bag:
            x = (passage - model.mean) / model.scale
            h = np.tanh(p["W"].T @ x + p["b"])
            hidden.append(h)
            strength.append(p["w"] @ (np.tanh(p["V"].T @ h) / (1 + np.exp(-(p["U"].T @ h)))))
        attention = np.exp(strength) / np.exp(strength).sum()
        logit = p["c"] @ sum(a * h for a, h in zip(attention, hidden)) + p["d"] + model.offset
        assert got == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4)


def test_a_repeated_id_is_learned_from_once(spark, monkeypatch):
    rows = [(1, words(40, i)) for i in range(300)] + [(2, words(60_000)), (3, words(20))]
    seen = []
    plain = quality.AttentionModel.fit
    monkeypatch.setattr(quality.AttentionModel, "fit",
                        lambda self, bags, marks, **k: seen.append((bags, marks)) or plain(self, bags, marks, **k))
    quality.fit(documents(spark, rows), labels(spark, [(1, 1, 0), (2, 0, 0), (3, 1, 0)]))
    (bags, marks), = seen
    assert len(bags) == 3 and sorted(marks) == [0, 1, 1]
    assert max(map(len, bags)) == quality.FIT_PASSAGES
    one = min((r.h, r.text) for r in documents(spark, rows).where("doc_id = 1")
              .select(F.xxhash64("text").alias("h"), "text").collect())[1]
    assert np.array_equal(bags[0], quality.passages(one))


def test_passages_cover_the_whole_text():
    assert quality.passages("").shape == (1, quality.FEATURES) == quality.passages(" \n").shape
    assert len(quality.passages(words(1000))) == 16
    long = words(200_000)
    assert len(quality.passages(long)) >= 200_000 // quality.PASSAGE_WORDS
    late = quality.passages(words(400) + " !!! ###" * 64)
    assert late[-1, 4] > 0.5 > late[0, 4]


@pytest.mark.parametrize("module,column", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, module, column):
    rows = [(i, words(30, i) + (" bad ###" * 30 if i % 2 else "")) for i in range(40)]
    rows += [(50, None), (51, ""), (None, "x"), (1, rows[1][1]), (52, words(20_000))]
    docs = documents(spark, rows)
    marks = labels(spark, [(i, 1 - i % 2, i % 2) for i in range(40)] + [(1, None, None), (99, 1, 1), (None, 0, 1)])
    scored = ((lambda m: quality.score(m, F.col("text"))) if module is quality else
              (lambda m: toxicity.score(spark, m, F.col("text"))))
    full = docs.select("doc_id", scored(module.fit(docs, marks)).alias("score"))
    assert full.count() == len(rows) and no_score(full) == []
    one_kind = marks.where(f"{column} = 1")
    assert {r.score for r in docs.select(scored(module.fit(docs, one_kind)).alias("score")).collect()} == {1.0}
    none = {r.score for r in docs.select(scored(module.fit(docs, marks.limit(0))).alias("score")).collect()}
    assert none == {0.5 if module is quality else 0.0}
    assert empty(spark).select(scored(module.fit(empty(spark), marks)).alias("score")).collect() == []


def accuracy(spark, query, column):
    rows = query(spark, SMALL)
    marks = spark.read.parquet(f"{SMALL}/labels.parquet")
    both = rows.join(marks, "doc_id").where("held_out").collect()
    return np.mean([r.predicted == r[column] for r in both]), rows.collect()


def test_quality_on_held_out_documents(spark):
    right, rows = accuracy(spark, quality.op5_quality, "quality")
    assert right > 0.95
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1


def test_toxicity_on_held_out_documents(spark):
    right, rows = accuracy(spark, toxicity.op10_toxicity, "toxic")
    assert right >= 0.8
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    marks = spark.read.parquet(f"{SMALL}/labels.parquet")
    for module, column, score in (
            (quality, "quality", lambda m: quality.score(m, F.col("text"))),
            (toxicity, "toxic", lambda m: toxicity.score(spark, m, F.col("text")))):
        changed = marks.withColumn(column, F.when(module.held_out(), 1 - F.col(column)).otherwise(F.col(column)))
        a, b = (sorted(docs.select("doc_id", score(module.fit(docs, x, ~module.held_out()))).collect())
                for x in (marks, changed))
        assert a == b


def test_rare_expressions_have_one_probability(spark):
    often, rare = "often often often often often often often", "rare"
    docs = documents(spark, [(0, f"{often} {rare}"), (1, "other words " * 9), (2, "more")])
    models = toxicity.fit(docs, labels(spark, [(0, 1, 1), (1, 1, 0), (2, 1, 0)]), max_words=4, max_pairs=2)
    assert len(models.vocabulary) <= 4 and len(models.keys) <= 2
    index = toxicity.word_index(models.vocabulary, toxicity.word_hashes(f"{rare} unseen"))
    assert np.allclose(models.own_ratio[index], models.own_ratio[index][0])


def test_cutoff_keeps_at_most_so_many(spark):
    counts = [1] * 50 + [3] * 7 + [900] * 2 + [5000, 6000, 100_000]
    totals = spark.createDataFrame([(i, c, 0) for i, c in enumerate(counts)], "key long, toxic long, ordinary long")
    for most in (0, 1, 2, 3, 5, 11, 12, 61, 62, 100):
        for least in (1, 4):
            at = toxicity.cutoff(totals, most, least)
            assert at >= least and sum(c >= at for c in counts) <= most
    assert toxicity.cutoff(totals, 12) == 2 and toxicity.cutoff(totals, 62) == 1


def test_kneser_ney_probabilities_add_up(spark, monkeypatch):
    """Rebuild both models from their definition on a small corpus and compare the ratios."""
    monkeypatch.setattr(toxicity, "RARE", 1)
    monkeypatch.setattr(toxicity, "CURVE_SHARE", 1 << 40)
    texts = ["a b a c", "b a b b", "c c a d a", "d a b"]
    docs = documents(spark, list(enumerate(texts)))
    marks = labels(spark, [(0, 1, 1), (1, 1, 0), (2, 1, 1), (3, 1, 0)])
    models = toxicity.fit(docs, marks)
    index = {w: int(toxicity.word_index(models.vocabulary, toxicity.word_hashes(w))[0]) for w in "abcd"}
    assert sorted(index.values()) == [1, 2, 3, 4]
    pairs = {1: {}, 0: {}}
    for i, t in enumerate(texts):
        w = [index[x] for x in t.split()]
        for u, v in zip([0, *w], w):
            c = pairs[int(i % 2 == 0)]
            c[u, v] = c.get((u, v), 0) + 1
    size, any_ = 5, set(pairs[0]) | set(pairs[1])
    kinds = [sum(v == w for _, v in any_) for w in range(size)]
    shared = [(max(k - 0.75, 0) + 0.75 * sum(x > 0 for x in kinds) / size) / sum(kinds) for k in kinds]
    assert sum(shared) == pytest.approx(1)
    p = {}
    for label, seen in pairs.items():
        ones, twos = (sum(c == n for c in seen.values()) for n in (1, 2))
        d = (ones or 1) / ((ones or 1) + 2 * (twos or 0.25))
        k = [sum(v == w for _, v in seen) for w in range(size)]
        own = [(max(x - d, 0) + d * sum(y > 0 for y in k) * s) / sum(k) for x, s in zip(k, shared)]
        assert sum(own) == pytest.approx(1)
        for u in range(size):
            total = sum(c for (a, _), c in seen.items() if a == u)
            kinds_after = sum(a == u for a, _ in seen)
            for v in range(size):
                p[label, u, v] = (max(seen.get((u, v), 0) - d, 0) + d * kinds_after * own[v]) / total \
                    if total else own[v]
            assert sum(p[label, u, v] for v in range(size)) == pytest.approx(1)
    for text in ("a b c", "d d", "b a"):
        w = [index[x] for x in text.split()]
        want = np.mean([np.log(p[1, u, v] / p[0, u, v]) for u, v in zip([0, *w], w)])
        assert models.features(toxicity.word_hashes(text))[0] == pytest.approx(want, abs=1e-5)


def test_words_and_pairs_have_no_cap(spark):
    rows = [(n, " ".join(f"w{n // 3 * 1000 + i}" for i in range(1000)) + " ") for n in range(3 * 170)]
    docs = documents(spark, [(n, t * 4) for n, t in rows])
    marks = labels(spark, [(n, 1, n // 3 % 2) for n, _ in rows])
    models = toxicity.fit(docs, marks)
    assert len(models.vocabulary) > 1 << 17 and len(models.keys) > 1 << 17


def test_counts_cover_every_label(spark):
    rows = [(n, f"{'own' + str(n)} " * 12 + words(20, n)) for n in range(60)]
    models = toxicity.fit(documents(spark, rows), labels(spark, [(n, 1, n % 2) for n, _ in rows]))
    index = toxicity.word_index(models.vocabulary, toxicity.word_hashes(" ".join(f"own{n}" for n in range(60))))
    assert (index > 0).all() and models.curve is not None


def test_words_are_rare_by_occurrences_and_pairs_count_in_windows(spark):
    rows = [(n, f"{words(6, n)} {'sour' if n % 2 else 'ripe'} {'apple' if n % 4 < 2 else 'melon'} "
                f"{'kiwi' if n % 4 in (0, 3) else 'plum'} ") for n in range(80)]
    models = toxicity.fit(documents(spark, [(n, t * 3) for n, t in rows]),
                          labels(spark, [(n, 1, n % 2) for n, _ in rows]))
    at = {w: int(toxicity.word_index(models.vocabulary, toxicity.word_hashes(w))[0]) for w in ("melon", "sour")}
    assert min(at.values()) > 0
    other = models.features(toxicity.word_hashes("melon sour"))
    pair = models.features(toxicity.word_hashes("sour melon"))
    singles = len(toxicity.WINDOWS)
    assert np.allclose(other[2:2 + singles], pair[2:2 + singles])
    assert not np.allclose(other[2 + singles:-2], pair[2 + singles:-2])
