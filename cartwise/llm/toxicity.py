"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, one of toxic and one of ordinary documents, are counted over every labelled
document that may be learned from. Both are smoothed the Kneser-Ney way: a seen pair is discounted,
what is freed goes to the class's continuation counts (in how many contexts a word was seen), and
those are discounted again in favour of continuation counts shared by both classes. An expression
seen fewer than RARE times is discounted wholly, so rare words and pairs have the shared probability
in both classes. A document is compared by its length-normalised log-likelihoods, as a whole and by
its most toxic windows; a logistic curve makes a probability of that. It is fitted on a bounded sample
of labelled documents, compared by models of their own that do not count them.

Counting is distributed and covers everything: all words and pairs, however many, are counted in Spark
tables. Labels are broadcast up to a checked number, which spares the shuffle of the texts; beyond it
texts and labels are joined by a shuffle. The driver and the tasks get the words and pairs that are not
rare. That loses nothing: a rare expression has the shared probability, for which only the numbers of
distinct words and pairs matter, and those are whole. What is sent grows with the input, without a cap;
`max_words` and `max_pairs` set one where memory is short (others share a probability or back off; the
least count is found from a histogram, so that ties stay or go together).

Null and empty texts have no words and get the score of a ratio of zero. Repeated documents count and
are scored each; of repeated labels of a document the highest counts, null labels are not used.
Without both kinds of labels every score is the share of toxic labels (0 if there are none).
"""
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ..staging import checkpointed, new_folder
from .common import blocks, id_and_text

THRESHOLD = 0.7
#: Labels up to this number are broadcast (some 64 MB); with more the texts are shuffled to them.
BROADCAST_LABELS = 2_000_000
#: Expressions seen less often than this, over both classes, share one probability.
RARE = 6
#: Words in the windows that are compared by themselves.
WINDOWS = (8, 32, 128)
#: Log-likelihood ratio from which a word is salient: twenty times as likely in toxic documents.
SALIENT = 3.0
#: Labelled documents for the curve, of one in CURVE_SHARE; the models it is fitted on do not count them.
CURVE_SAMPLE, CURVE_SHARE = 6000, 5
MEMORY_WORDS = 400_000
_ROWS = 1 << 20
_WORD = re.compile(r"[^\W_]+")
_memory = {}


def word_hashes(text):
    """32-bit hash of every word in lower case, as uint32."""
    out = []
    for block in blocks(text):
        words = _WORD.findall(block.lower())
        if len(_memory) > MEMORY_WORDS:
            _memory.clear()
        try:
            hashes = [_memory[w] for w in words]
        except KeyError:
            new = [w for w in set(words) if w not in _memory]
            _memory.update((w, xxhash.xxh32_intdigest(w) or 1) for w in new)
            hashes = [_memory[w] for w in words]
        out.append(np.array(hashes, np.uint32))
    return np.concatenate(out)


COUNTS = ("toxic", "ordinary", "toxic_out", "ordinary_out")


def counted(keys, toxic, left_out):
    """(key, toxic, ordinary, toxic_out, ordinary_out) totals of integer keys; the last two are the parts
    of the first two that are left out for the curve."""
    distinct, at = np.unique(keys, return_inverse=True)
    masks = (toxic, ~toxic, toxic & left_out, ~toxic & left_out)
    return pa.RecordBatch.from_arrays(
        [pa.array(distinct), *(pa.array(np.bincount(at[m], minlength=len(distinct)).astype(np.int64))
                               for m in masks)], ["key", *COUNTS])


def _totals(tokens):
    """Totals of all pairs over all rows (toxic, words, left_out): partial in the tasks, then summed."""
    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for label, out, words in zip(*(batch.column(c) for c in ("toxic", "left_out", "words"))):
                keys = hash_pairs(np.frombuffer(words.as_py(), np.uint32))
                parts.append((keys, np.full(len(keys), bool(label.as_py())),
                              np.full(len(keys), bool(out.as_py()))))
                held += len(keys)
                if held > 1 << 21:
                    yield counted(*map(np.concatenate, zip(*parts)))
                    parts, held = [], 0
        if parts:
            yield counted(*map(np.concatenate, zip(*parts)))

    return (tokens.mapInArrow(run, ", ".join(f"{c} long" for c in ("key", *COUNTS)))
            .groupBy("key").agg(*(F.sum(c).alias(c) for c in COUNTS)))


def cutoff(totals, most, least=1):
    """The smallest count, from `least` up, that at most `most` of the totals reach.

    Totals of one count stay or go together.
    """
    count = F.col("toxic") + F.col("ordinary")
    # Counts up to 1,000 one by one, larger ones by powers of two: a short histogram.
    level = F.when(count <= 1000, count).otherwise(
        F.pow(F.lit(2.0), F.ceil(F.log2(count))).cast("long"))
    found = (totals.where(count >= least).groupBy(level.alias("level")).count()
             .orderBy(F.desc("level")).collect())
    held = 0
    for row, below in zip(found, [*(r["level"] for r in found[1:]), least - 1]):
        held += row["count"]
        if held > most:
            return row["level"] + 1
    return least


def word_index(vocabulary, words):
    """1 + place of each word among the sorted words known, 0 for the others."""
    if not len(vocabulary):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words, at + 1, 0).astype(np.int64)


def hash_pairs(words):
    """Each word with the one before, as 64 bits; the first word follows 0, which is no word."""
    before = np.append(np.uint32(0), words[:-1])[:len(words)]
    return (before.astype(np.uint64) << np.uint64(32) | words).view(np.int64)


class ClassModels:
    """The two smoothed models as arrays, and the curve.

    Arrays by word have the words that are not rare in the order of `vocabulary`, from place 1. Place 0
    stands for every other word: they have one probability in common, whether seen or not.
    """

    def __init__(self, words, pairs, kinds, discounts, share):
        """words and pairs: what is not rare, see fit(). kinds: numbers of distinct pairs and words."""
        words = words.sort_by("word")
        self.vocabulary = words["word"].to_numpy().astype(np.uint32)
        self.share, self.curve = share, None
        size = len(self.vocabulary) + 1

        def by_word(column):
            return np.append(0.0, words[column].to_numpy())

        total = max(kinds["any"], 1)
        free = 0.75 * kinds["words"]
        shared = (np.maximum(by_word("any") - 0.75, 0) + (free or total) / (kinds["words"] + 1)) / total
        own, freed, tokens, both = [], [], [], ("toxic", "ordinary")
        for c in both:
            kept = np.maximum(by_word(f"{c}_kinds") - discounts[c], 0)
            total = max(kinds[c], 1)
            own.append((kept + (total - kept.sum()) * shared) / total)
            tokens.append(by_word(f"{c}_tokens"))
            tokens[-1][0] = kinds[f"{c}_starts"]
            spare = by_word(f"{c}_freed")
            spare[0] = kinds[f"{c}_starts_freed"]
            freed.append(np.where(tokens[-1] > 0, spare / np.maximum(tokens[-1], 1), 1.0))
        self.own_ratio = np.log(own[0] / own[1]).astype(np.float32)
        # The last place is the context of a rare word: all of its pairs are rare and free.
        self.freed_ratio = np.append(np.log(freed[0] / freed[1]), 0).astype(np.float32)
        # A pair that is not rare has words that are not rare, or begins a text: place 0 as context.
        keys, ratio = np.empty(len(pairs), np.int64), np.empty(len(pairs), np.float32)
        for at in range(0, len(pairs), _ROWS):
            part = pairs.slice(at, _ROWS)
            key = part["key"].to_numpy().view(np.uint64)
            word = word_index(self.vocabulary, (key & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            before = word_index(self.vocabulary, (key >> np.uint64(32)).astype(np.uint32))
            seen = [np.maximum(part[c].to_numpy() - discounts[c], 0) / np.maximum(tokens[i][before], 1)
                    + freed[i][before] * own[i][word] for i, c in enumerate(both)]
            keys[at:at + _ROWS] = before * size + word
            ratio[at:at + _ROWS] = np.log(seen[0] / seen[1])
        order = np.argsort(keys)
        self.keys, self.seen_ratio = keys[order], ratio[order]

    def features(self, words):
        """Log-likelihood ratios per word: of the pairs, of the words alone, of the best windows of both.

        In windows a word or pair counts where it comes first in the text, so that repeating it is no
        evidence; the last two features are the salient words, their number and their share.
        """
        n = len(words)
        if not n:
            return np.zeros(4 + 2 * len(WINDOWS))
        index = word_index(self.vocabulary, words)
        before = np.append(0, np.where(index[:-1] == 0, -1, index[:-1]))
        single = self.own_ratio[index].astype(np.float64)
        ratio = self.freed_ratio[before] + single
        if len(self.keys):
            key = before * (len(self.vocabulary) + 1) + index
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ratio = np.where(self.keys[at] == key, self.seen_ratio[at], ratio)
        first = np.zeros((2, n))
        at = np.unique(index, return_index=True)[1]
        first[0, at] = single[at]
        at = np.unique(before * (len(self.vocabulary) + 1) + index, return_index=True)[1]
        first[1, at] = ratio[at]
        salient = (first[0] > SALIENT).sum()
        best = []
        for values in first:
            sums = np.append(0.0, np.cumsum(values))
            for window in WINDOWS:
                # Windows overlap by half; a shorter text is one window that counts in proportion.
                starts = np.arange(0, max(n - window // 2, 1), max(window // 2, 1))
                ends = np.minimum(starts + window, n)
                best.append(((sums[ends] - sums[starts]) / window).max())
        return np.array([ratio.mean(), single.mean(), *best, np.log1p(salient), salient / n])

    def fit_curve(self, rows, labels):
        """Logistic regression of the labels on the features, by Newton's method."""
        labels = np.asarray(labels, float)
        if not len(labels) or labels.min() == labels.max():
            return self
        x = np.array(rows)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        x = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)),
                                   x.T @ (p - labels) + 0.1 * w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.curve = w
        return self

    def score(self, words):
        if self.curve is None:
            return self.share
        x = np.append((self.features(words) - self.mean) / self.scale, 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.curve, -500, 500))))


def labelled_words(docs, labels, learnable=None, id_col="doc_id", text_col="text"):
    """(doc_id, toxic, words) of the labelled documents, words packed as uint32 hashes."""
    condition = F.lit(True) if learnable is None else learnable
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col("toxic").alias("label"))
             .where(condition).where("doc_id is not null and label is not null")
             .groupBy("doc_id").agg(F.max(F.col("label").cast("int") > 0).alias("toxic")))
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: word_hashes(t).tobytes())

    return (id_and_text(docs, id_col, text_col).where(condition).join(known, "doc_id")
            .select("doc_id", "toxic", packed("text").alias("words")))


def _models(pairs, share, max_words=None, max_pairs=None):
    """Both models from the totals of all pairs, without a curve."""
    both = ("toxic", "ordinary")
    count = F.col("toxic") + F.col("ordinary")
    once = pairs.agg(
        F.count(F.lit(1)).alias("any"), *(F.sum((F.col(c) > 0).cast("long")).alias(c) for c in both),
        *(F.sum((F.col(c) == n).cast("long")).alias(f"{c}{n}") for c in both for n in (1, 2))).first()
    discounts = {c: (once[f"{c}1"] or 1) / ((once[f"{c}1"] or 1) + 2 * (once[f"{c}2"] or 0.25))
                 for c in both}
    # Every occurrence of a word is the second of one pair, so these are the totals of words.
    words = checkpointed(pairs.groupBy(F.expr("key & 4294967295").alias("word")).agg(
        *(F.sum(c).alias(c) for c in both), F.count(F.lit(1)).alias("any"),
        *(F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds") for c in both)))
    least_word = cutoff(words, max_words, RARE) if max_words else RARE
    # A pair is at most as frequent as its words: none is kept without both words.
    least = max(cutoff(pairs, max_pairs, RARE) if max_pairs else RARE, least_word)
    freed = [F.sum(F.when(count >= least, F.least(F.col(c).cast("double"), F.lit(discounts[c])))
                   .otherwise(F.col(c))).alias(f"{c}_freed") for c in both]
    contexts = checkpointed(pairs.groupBy(F.expr("shiftrightunsigned(key, 32)").alias("word")).agg(
        *(F.sum(c).alias(f"{c}_tokens") for c in both), *freed))
    start = contexts.where("word = 0").first()
    kinds = {"any": once["any"], "words": words.count(), **{c: once[c] or 0 for c in both},
             **{f"{c}_starts": start[f"{c}_tokens"] if start else 0 for c in both},
             **{f"{c}_starts_freed": start[f"{c}_freed"] if start else 0 for c in both}}
    known = words.where(count >= least_word).drop(*both).join(contexts, "word", "left").na.fill(0)
    return ClassModels(known.toArrow(), pairs.where(count >= least).toArrow(), kinds, discounts, share)


def fit(docs, labels, learnable=None, max_words=None, max_pairs=None, id_col="doc_id",
        text_col="text"):
    """Both models counted over all labelled documents that may be learned from, with the curve.

    The curve is fitted on models that leave out the documents it is fitted on; those that are kept
    count them as well.
    """
    tokens = checkpointed(labelled_words(docs, labels, learnable, id_col, text_col))
    share = tokens.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    order = F.xxhash64(F.lit(13), "doc_id")
    for_curve = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(CURVE_SHARE)) == 0
    sample = tokens.where(for_curve).orderBy(order, "doc_id", "words").limit(CURVE_SAMPLE)
    # Rows of one id are left out together, whether or not all of them are in the sample.
    last = sample.agg(F.max(order)).first()[0]
    left_out = F.lit(False) if last is None else for_curve & (order <= last)
    folder = new_folder(docs.sparkSession, "pairs")
    _totals(tokens.withColumn("left_out", left_out)).write.parquet(folder)
    totals = docs.sparkSession.read.parquet(folder)
    models = _models(totals, share, max_words, max_pairs)
    if last is None:
        return models
    rest = totals.select("key", *((F.col(c) - F.col(f"{c}_out")).alias(c) for c in ("toxic", "ordinary")))
    without = _models(rest.where("toxic + ordinary > 0"), share, max_words, max_pairs)
    # The features are made in the tasks; at most CURVE_SAMPLE short rows come back.
    held = docs.sparkSession.sparkContext.broadcast(without)

    @F.pandas_udf("array<double>")
    def features(words: pd.Series) -> pd.Series:
        return words.map(lambda w: held.value.features(np.frombuffer(w, np.uint32)))

    rows = sample.select("doc_id", "toxic", features("words").alias("x")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))
    held.destroy()
    return models.fit_curve([r.x for r in rows], [r.toxic for r in rows])


def score(spark, models, text):
    """Column with the probability that the whole text is toxic."""
    held = spark.sparkContext.broadcast(models)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: held.value.score(word_hashes(t))).astype("float64")

    return scored(F.coalesce(text, F.lit("")))


def held_out():
    """The contract's split: labels of these ids are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op10_toxicity(spark, sf_dir):
    """Score of every document; labels of the held-out third are not looked at."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    models = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    return (docs.select("doc_id", held_out().alias("held_out"),
                        score(spark, models, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
