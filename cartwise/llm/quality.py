"""Quality classifier by attention over the passages of a document.

A document is a bag of passages. Every passage of the whole text is encoded (what kinds of
characters it holds, how its words repeat, hashed pairs of bytes), a gated attention layer learns
from document labels alone which passages matter, and the weighted mean of the passages is scored:

    h = tanh(W x + b),  a = softmax over passages of w . (tanh(V h) * sigmoid(U h)),
    score = sigmoid(c . sum(a h) + d)

The model is fitted on the driver from the passages of a bounded sample of labelled documents
(`sample`, by default 4,000, those with the lowest hash of their id; of texts that share an id one, and
of a text at most FIT_PASSAGES passages, spread evenly over it); scoring runs in the tasks, document by
document and over all passages, long texts block by block.

Null and empty texts are one passage of zeros and get its score. Labels that are null or belong to
no document are not used; of repeated labels of a document the highest counts; repeated documents
are scored each and learned from once. Without any label every score is 0.5, with labels of one kind it is that label.
"""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .common import blocks, id_and_text

SAMPLE = 4000
THRESHOLD = 0.3
PASSAGE_WORDS = 64
#: Passages of a document that the fit looks at; with SAMPLE it bounds what the driver gets (some 150 MB).
FIT_PASSAGES = 128
HASHED = 64
_KINDS = 8
FEATURES = _KINDS + 5 + HASHED


def _byte_kinds():
    """Letter, capital, digit, full stop or comma, other ASCII sign, line end, space, non-ASCII."""
    kinds = np.full(256, 7, np.int64)
    for b in range(128):
        c = chr(b)
        kinds[b] = (6 if c in " \t" else 5 if c.isspace() else 1 if c.isupper() else
                    0 if c.isalpha() else 2 if c.isdigit() else 3 if c in ".,;:'-" else 4)
    return kinds


_BYTE_KINDS = _byte_kinds()


def passages(text):
    """One row of features per passage of PASSAGE_WORDS words; a text without words has one."""
    found = [_block(b) for b in blocks(text)]
    found = [f for f in found if len(f)]
    return np.concatenate(found) if found else np.zeros((1, FEATURES), np.float32)


def _block(text):
    words = text.split()
    n = -(-len(words) // PASSAGE_WORDS)
    if not n:
        return np.zeros((0, FEATURES), np.float32)
    parts = [words[i:i + PASSAGE_WORDS] for i in range(0, len(words), PASSAGE_WORDS)]
    sizes = np.array([len(p) for p in parts], np.float64)
    data = np.frombuffer(" ".join(words).encode(), np.uint8).astype(np.int64)
    kind = _BYTE_KINDS[data]
    passage = (np.cumsum(kind == 6) // PASSAGE_WORDS)
    length = np.bincount(passage, minlength=n).astype(np.float64)
    kinds = np.bincount(passage * _KINDS + kind, minlength=n * _KINDS).reshape(n, _KINDS)
    pair = (data[:-1] * 31 + data[1:] * 17) % HASHED
    pairs = np.bincount(passage[:-1] * HASHED + pair, minlength=n * HASHED).reshape(n, HASHED)
    out = np.empty((n, FEATURES))
    out[:, :_KINDS] = kinds / length[:, None]
    out[:, _KINDS] = [len(set(p)) for p in parts] / sizes
    out[:, _KINDS + 1] = [sum(a == b for a, b in zip(p, p[1:])) for p in parts] / sizes
    out[:, _KINDS + 2] = [sum(map(str.isalnum, p)) for p in parts] / sizes
    out[:, _KINDS + 3] = [sum(map(str.isupper, p)) for p in parts] / sizes
    out[:, _KINDS + 4] = np.log1p(length / sizes) / 4
    out[:, _KINDS + 5:] = np.sqrt(pairs / length[:, None])
    return out.astype(np.float32)


def spread(bag, most):
    """At most `most` rows of the bag, at even distances."""
    return bag if len(bag) <= most else bag[np.linspace(0, len(bag) - 1, most).round().astype(int)]


class AttentionModel:
    """Gated attention over bags of passages, fitted with Adam on the whole sample."""

    def __init__(self, prior=0.5, hidden=16, gate=8):
        self.prior, self.hidden, self.gate = prior, hidden, gate
        self.weights = None

    def fit(self, bags, labels, steps=200, rate=0.03, decay=1e-4, seed=7):
        """bags: features per document. Labels of one kind only leave the prior as score."""
        labels = np.asarray(labels, np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if len(labels) == 0 or self.prior in (0.0, 1.0):
            return self
        x = np.concatenate(bags)
        starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = ((x - self.mean) / self.scale).astype(np.float32)
        random = np.random.RandomState(seed)
        shapes = {"W": (FEATURES, self.hidden), "b": (self.hidden,),
                  "V": (self.hidden, self.gate), "U": (self.hidden, self.gate),
                  "w": (self.gate,), "c": (self.hidden,), "d": ()}
        self.weights = {k: random.normal(0, 0.3 / np.sqrt(max(s[:1] or (1,))), s) if s and k != "b"
                        else np.zeros(s) for k, s in shapes.items()}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        # Both labels weigh the same, so that the rarer one is learned too.
        weight = np.where(labels > 0, 0.5 / self.prior, 0.5 / (1 - self.prior)) / len(labels)
        weight = weight.astype(np.float32)
        for step in range(1, steps + 1):
            for k, g in self._gradient(x, starts, labels, weight).items():
                g = g + decay * self.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.weights[k] = self.weights[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        # Undo the equal weights: scores are probabilities at the rate of the labels.
        self.offset = float(np.log(self.prior / (1 - self.prior)))
        return self

    def _forward(self, x, starts):
        p = self.weights
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        sizes = np.diff(np.append(starts, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, s, a, z, sizes, z @ p["c"] + p["d"]

    def _gradient(self, x, starts, labels, weight):
        p = self.weights
        h, t, s, a, z, sizes, logit = self._forward(x, starts)
        up = (1 / (1 + np.exp(-logit)) - labels) * weight
        dz = np.repeat(up, sizes)[:, None] * p["c"]
        da = (dz * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds,
                "w": (t * s).T @ de, "c": z.T @ up, "d": up.sum()}

    def scores(self, bags):
        """Probability of label 1 for each bag."""
        if self.weights is None:
            return np.full(len(bags), self.prior)
        x = ((np.concatenate(bags) - self.mean) / self.scale).astype(np.float32)
        starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
        logit = self._forward(x, starts)[-1] + self.offset
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def sampled_labels(labels, label_col, learnable, sample, id_col="doc_id"):
    """At most `sample` rows (doc_id, label): those with the lowest hash of their id."""
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
            .where(F.lit(True) if learnable is None else learnable)
            .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64(F.lit(5), F.col("doc_id")), "doc_id").limit(sample))


def fit(docs, labels, learnable=None, sample=SAMPLE, id_col="doc_id", text_col="text"):
    """Model fitted on the passages of a bounded sample of labelled documents.

    learnable: condition on doc_id for the labels that may be seen.
    """
    # Bounded by `sample`, so it may be broadcast; only its documents' features reach the driver.
    chosen = F.broadcast(sampled_labels(labels, "quality", learnable, sample, id_col))

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: spread(passages(t), FIT_PASSAGES).tobytes())

    # However often an id occurs, one of its texts is learned from: the one with the smallest hash.
    one = (id_and_text(docs, id_col, text_col).join(chosen, "doc_id").groupBy("doc_id", "label")
           .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")))
    rows = one.select("doc_id", "label", encoded("first.text").alias("bag")).collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.bag)))
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES) for r in rows]
    return AttentionModel().fit(bags, [r.label for r in rows])


def score(model, text):
    """Column with the score of the whole text."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out, bags, size = [], [], 0
        for text_ in texts:
            bags.append(passages(text_))
            size += len(bags[-1])
            if size > 4096:
                out.append(model.scores(bags))
                bags, size = [], 0
        if bags:
            out.append(model.scores(bags))
        return pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return scored(F.coalesce(text, F.lit("")))


def held_out():
    """The contract's split: labels of these ids are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op5_quality(spark, sf_dir):
    """Score of every document; labels of the held-out fifth are not looked at."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    return (docs.select("doc_id", held_out().alias("held_out"),
                        score(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_good(spark, docs, sf_dir):
    """Documents that are not rejected, with their columns as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, ~held_out())
    return docs.where(score(model, F.col("text")) >= THRESHOLD)
