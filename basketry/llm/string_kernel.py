"""Language identification with a blended-spectrum string kernel.

k(x, y) = |x & y| / sqrt(|x| |y|), where a text stands for the set of its byte
n-grams, n = 1 to 4 (A-Z lower-cased), each hashed to one of 2**15 places: presence, not counts.
``landmarks`` training texts give the Nystroem feature map k(x, L) K(L, L)**-1/2,
and one ridge regression per language is fitted on it (one against the rest).

As the kernel is a product of presence vectors, map and regressions fold into
one matrix (places x languages): a batch of texts is scored by one product of
its presence matrix with it, whatever the number of landmarks.

Fitting uses at most ``per_language`` labelled texts of each language, picked by
the hash of their id; their presence vectors (4 KB each) are made on the
executors.  Every text is scored whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a
null label is no training row; without any training row all texts are ``und``;
repeated rows get the same result each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C

PLACES = 1 << 15
LONGEST = 4
#: Texts whose presence vectors are held at once.
TOGETHER = 64


def presence(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Presence of each place in each of the texts laid end to end (rows x PLACES, bool)."""
    raw = C.lower_bytes(raw).astype(np.uint32)
    n = len(offsets) - 1
    out = np.zeros(n * PLACES, bool)
    row = np.repeat(np.arange(n), np.diff(offsets)) * PLACES
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(raw))     # bytes to the text's end
    gram = np.zeros(len(raw), np.uint32)
    for size in range(1, LONGEST + 1):
        rest = len(raw) - size + 1
        if rest <= 0:
            break
        gram = gram[:rest] | raw[size - 1:] << np.uint32(8 * (size - 1))
        mixed = (gram ^ gram >> np.uint32(15)) * np.uint32(0x2C1B3C6D) + np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)
        place = ((mixed ^ mixed >> np.uint32(12)) * np.uint32(0x297A2D39)) >> np.uint32(17)
        inside = left[:rest] >= size
        out[(row[:rest] + place)[inside]] = True
    return out.reshape(n, PLACES)


def _batches(raw, offsets):
    """Runs of few texts, few bytes."""
    for i, j in C.blocks(offsets):
        for a in range(i, j, TOGETHER):
            b = min(a + TOGETHER, j)
            yield a, b, presence(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def _presence_rows(batches):
    for batch in batches:
        raw, offsets = C.texts_of(batch.column("text"))
        packed = [np.packbits(row).tobytes() for _, _, found in _batches(raw, offsets) for row in found]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(packed, pa.binary())], names=["lang", "bits"])


class Model:
    """weights (PLACES x languages), bias, languages."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, languages: list[str]):
        self.weights, self.bias, self.languages = weights.astype(np.float32), bias, languages

    def scores(self, found: np.ndarray) -> np.ndarray:
        size = np.maximum(found.sum(1), 1)
        return found.astype(np.float32) @ self.weights / np.sqrt(size)[:, None] + self.bias


def fit(sets: np.ndarray, labels: list[str], landmarks: int, ridge: float) -> Model:
    languages = sorted(set(labels))
    own = np.array([languages.index(x) for x in labels])
    x = sets.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    # landmarks from each language in turn
    turn = np.zeros(len(own), np.int64)
    for c in range(len(languages)):
        turn[own == c] = np.arange((own == c).sum())
    marks = x[np.lexsort((own, turn))[:landmarks]]
    values, vectors = np.linalg.eigh(marks.astype(np.float64) @ marks.T)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    mapped = (x @ marks.T) @ root
    # each language weighs the same, however many texts it has
    weight = 1 / np.bincount(own)[own]
    weight *= len(own) / weight.sum()
    target = np.where(own[:, None] == np.arange(len(languages))[None, :], 1.0, -1.0)
    centre = (weight[:, None] * mapped).sum(0) / weight.sum()
    middle = (weight[:, None] * target).sum(0) / weight.sum()
    a = mapped - centre
    beta = np.linalg.solve((a * weight[:, None]).T @ a + ridge * np.eye(a.shape[1]), (a * weight[:, None]).T @ (target - middle))
    return Model(marks.T @ (root @ beta), middle - centre @ beta, languages)


def learn(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 300, landmarks: int = 400, ridge: float = 0.1) -> Model | None:
    """Fit on at most ``per_language`` texts of each language; None without training rows."""
    spark = train.sparkSession
    rows = train.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("order"))
    sizes = rows.groupBy("lang").count().collect()          # a row per language
    if not sizes:
        return None
    # keep a share of the rows by hash first, so no language's rows meet in one task
    share = spark.createDataFrame([(r.lang, min(1.0, 3 * per_language / r["count"])) for r in sizes], "lang string, share double")
    some = rows.join(F.broadcast(share), "lang").filter(F.pmod("order", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("order", F.xxhash64("text")))
    picked = some.withColumn("n", first).filter(F.col("n") <= per_language).select("lang", "text")
    got = picked.mapInArrow(_presence_rows, "lang string, bits binary").collect()
    sets = np.unpackbits(np.frombuffer(b"".join(bytes(r.bits) for r in got), np.uint8)).reshape(len(got), PLACES)
    return fit(sets, [r.lang for r in got], landmarks, ridge)


def _predicted(batches, model):
    for batch in batches:
        column = batch.column("text")
        raw, offsets = C.texts_of(column)
        langs, scores = [], []
        for i, j in C.blocks(offsets):
            lettered = [any(map(str.isalpha, t or "")) for t in column.slice(i, j - i).to_pylist()]
            for a in range(i, j, TOGETHER):
                b = min(a + TOGETHER, j)
                if model is None:
                    langs += ["und"] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                got = model.scores(presence(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
                best = got.argmax(1)
                value = np.clip((got.max(1) + 1) / 2, 0, 1)
                for k in range(b - a):
                    known = lettered[a - i + k]
                    langs.append(model.languages[best[k]] if known else "und")
                    scores.append(float(value[k]) if known else 0.0)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                         names=["doc_id", "lang_pred", "score"])


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # PLACES x languages numbers
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: _predicted(it, shared.value), "doc_id long, lang_pred string, score double")
