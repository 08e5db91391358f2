"""Quality classifier: gated-attention multiple-instance learning over passages.

A text is a bag of passages (``passage_words`` words each); only texts have labels.
Each passage is encoded from language-independent figures (case, digits, kinds of
punctuation, word lengths, repeated words) by a small tanh layer, h.  Attention
learnt from the text labels, a = softmax(w . (tanh(V h) * sigmoid(U h))), weighs
the passages; the weighted representation gives the score by logistic regression.

The network has a few thousand numbers and is fitted with Adam on at most
``per_class`` labelled texts of each class, picked by the hash of their id.
Every text is scored whole, all of its passages.

Defined cases: a null or empty text is one passage of zeros and gets a score like any
other; a null label is no training row; with no training rows every score is 0.5;
repeated rows get the same result each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C

# Classes of bytes counted in a passage.
BYTES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "stop": b".", "comma": b",",
         "mark": b"!?", "bar": b"|", "symbol": b"*#$%&@^~+=<>", "bracket": b"()[]{}", "quote": b"\"'`", "slash": b"/\\_:;-", "line": b"\n\r"}
_CLASS = np.zeros(256, np.int64)
for _k, _v in enumerate(BYTES.values(), 1):
    _CLASS[np.frombuffer(_v, np.uint8)] = _k
_CLASS[128:] = len(BYTES) + 1
_KINDS = len(BYTES) + 2
N_FEATURES = _KINDS + 8


def passage_features(raw: np.ndarray, offsets: np.ndarray, passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, row) of the passages of texts laid end to end; a text without words has one of zeros."""
    n = len(offsets) - 1
    start, end, row = C.word_spans(raw, offsets)
    count = np.bincount(row, minlength=n)
    first_word = np.cumsum(count) - count
    passages = np.maximum(-(-count // passage_words), 1)
    first_passage = np.cumsum(passages) - passages
    owner = np.repeat(np.arange(n), passages)
    out = np.zeros((len(owner), N_FEATURES))
    if not len(start):
        return out, owner
    of = first_passage[row] + (np.arange(len(row)) - first_word[row]) // passage_words
    total = len(owner)
    words = np.bincount(of, minlength=total)
    # bytes from a passage's first word to the next passage's; a text's first passage begins with the text
    begin = np.zeros(total, np.int64)
    new = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    begin[of[new]] = start[new]
    begin[first_passage] = offsets[:-1]
    of_byte = np.cumsum(np.bincount(begin, minlength=len(raw) + 1)[:len(raw)]) - 1
    kinds = np.bincount(of_byte * _KINDS + _CLASS[raw], minlength=total * _KINDS).reshape(-1, _KINDS)[:total]
    size = np.maximum(kinds.sum(1), 1)
    out[:, :_KINDS] = kinds / size[:, None]
    length = (end - start).astype(float)
    w = np.maximum(words, 1)
    mean = np.bincount(of, weights=length, minlength=total) / w
    spread = np.sqrt(np.maximum(np.bincount(of, weights=length ** 2, minlength=total) / w - mean ** 2, 0))
    word = C.span_hash(C.prefix_hash(raw), start, end)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((word, of))
    w_sorted, of_sorted = word[order], of[order]
    fresh = np.ones(len(word), bool)
    fresh[1:] = (w_sorted[1:] != w_sorted[:-1]) | (of_sorted[1:] != of_sorted[:-1])
    distinct = np.bincount(of_sorted[fresh], minlength=total)
    capital = np.bincount(of, weights=(raw[start] >= 65) & (raw[start] <= 90), minlength=total)
    ends = raw[end - 1]
    odd_end = np.bincount(of, weights=(_CLASS[ends] > 0) & ~((ends >= 48) & (ends <= 57)) & ~((ends >= 65) & (ends <= 90))
                          & ~((ends >= 97) & (ends <= 122)) & (ends < 128), minlength=total)
    out[:, _KINDS:] = np.stack([mean / 10, spread / 10, distinct / w, np.bincount(of, weights=same, minlength=total) / w, capital / w, odd_end / w,
                                np.log1p(words) / 5, (words > 0).astype(float)], axis=1)
    out[words == 0] = 0
    return out, owner


def _softmax(x, first, owner):
    top = np.maximum.reduceat(x, first)
    e = np.exp(x - top[owner])
    return e / np.add.reduceat(e, first)[owner]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Passage encoder, gated attention, and the classifier of the weighted representation."""

    def __init__(self, mean, scale, weights):
        self.mean, self.scale, self.p = mean, scale, weights

    @staticmethod
    def start(n_features: int, hidden: int, attention: int, seed: int) -> dict[str, np.ndarray]:
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        return {"W": draw(n_features, hidden), "b": np.zeros(hidden), "V": draw(hidden, attention), "U": draw(hidden, attention),
                "w": draw(attention, 1)[:, 0], "c": draw(hidden, 1)[:, 0], "d": np.zeros(1)}

    def forward(self, features, owner):
        p = self.p
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        x = np.clip((features - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        a = _softmax((t * s) @ p["w"], first, owner)
        z = np.add.reduceat(a[:, None] * h, first)
        return x, h, t, s, a, z, _sigmoid(z @ p["c"] + p["d"])

    def scores(self, features, owner):
        return self.forward(features, owner)[-1]

    def gradients(self, features, owner, label, weight):
        p = self.p
        x, h, t, s, a, z, y = self.forward(features, owner)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out = (y - label) * weight / len(label)
        dz = out[:, None] * p["c"][None, :]
        dh = a[:, None] * dz[owner]
        da = (dz[owner] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, first)[owner])
        dt, ds = de[:, None] * p["w"] * s * (1 - t ** 2), de[:, None] * p["w"] * t * s * (1 - s)
        dh += dt @ p["V"].T + ds @ p["U"].T
        du = dh * (1 - h ** 2)
        return {"W": x.T @ du, "b": du.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ out, "d": out.sum(keepdims=True)}


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int, attention: int, epochs: int, rate: float, decay: float, seed: int) -> Network:
    features = np.concatenate(bags)
    mean, scale = features.mean(0), features.std(0) + 1e-3
    net = Network(mean, scale, Network.start(features.shape[1], hidden, attention, seed))
    # classes weigh alike up to a factor of four
    share = np.bincount(labels, minlength=2) / len(labels)
    weight = 1 / np.maximum(share, share.max() / 4)[labels]
    weight /= weight.mean()
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), 64):
            pick = order[lo:lo + 64]
            owner = np.repeat(np.arange(len(pick)), [len(bags[i]) for i in pick])
            grads = net.gradients(np.concatenate([bags[i] for i in pick]), owner, labels[pick], weight[pick])
            step += 1
            speed = rate * (1 - epoch / epochs)
            for k, g in grads.items():
                g = g + decay * net.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.p[k] = net.p[k] - speed * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


def _bag_rows(batches, passage_words):
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        blobs = []
        for i, j in C.blocks(offsets):
            found, owner = passage_features(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], passage_words)
            edge = np.searchsorted(owner, np.arange(j - i + 1))
            blobs += [found[a:b].astype(np.float32).tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(blobs, pa.binary())], names=["label", "bag"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          passage_words: int = 64, per_class: int = 2500, hidden: int = 24, attention: int = 12, epochs: int = 40,
          rate: float = 0.01, decay: float = 1e-4, seed: int = 3) -> Network | None:
    """Fit on at most ``per_class`` labelled texts of each class (rows of ``labels`` with label 0 or 1)."""
    marked = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("label"), F.xxhash64(id_col).alias("order"))
    sizes = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    if not sizes:
        return None
    share = F.lit(0.0)
    for label, size in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, 3 * per_class / size)).otherwise(share)
    some = marked.filter(F.pmod("order", F.lit(1 << 20)) < share * (1 << 20))
    place = F.row_number().over(Window.partitionBy("label").orderBy("order", "doc"))
    picked = some.withColumn("n", place).filter(F.col("n") <= per_class).select("doc", "label")
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(picked), "doc").select("label", "text")       # 2 * per_class ids at most
    got = joined.mapInArrow(lambda it: _bag_rows(it, passage_words), "label int, bag binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r.label, bytes(r.bag)))       # the order of tasks must not matter
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, N_FEATURES).astype(np.float64) for r in got]
    return fit(bags, np.array([r.label for r in got]), hidden, attention, epochs, rate, decay, seed)


def _scored(batches, net, passage_words):
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        scores = []
        for i, j in C.blocks(offsets):
            found, owner = passage_features(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], passage_words)
            scores.append(np.full(j - i, 0.5) if net is None else net.scores(found, owner))
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in range(batch.num_columns - 1)] + [pa.array(np.concatenate(scores or [np.zeros(0)]), pa.float64())],
            names=batch.schema.names[:-1] + ["score"])


def score(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text", passage_words: int = 64) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: C.trimmed(_scored(it, shared.value, passage_words)), "doc_id long, score double")


def keep_good(docs: DataFrame, net: Network | None, text_col: str = "text", threshold: float = 0.5, passage_words: int = 64) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    columns = docs.columns
    whole = F.struct(*[F.col(c) for c in columns]).alias("row")
    scored = docs.select(whole, F.col(text_col).alias("text")).mapInArrow(
        lambda it: C.trimmed(_scored(it, shared.value, passage_words)), f"row {docs.schema.simpleString()}, score double")
    return scored.filter(F.col("score") >= threshold).select("row.*")
