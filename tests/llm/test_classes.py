"""Word classes against a plain exchange, class pairs against a plain count."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import brown_lm
from tests.llm import cases


def hashed(words):
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    word, ending, _ = brown_lm._tokens(raw, np.array([0, len(raw)]))
    return word, ending


def likelihood(pairs):
    left, right = Counter(), Counter()
    for (a, b), n in pairs.items():
        left[a] += n
        right[b] += n
    log = lambda c: sum(n * math.log(n) for n in c.values() if n)
    return log(pairs) - log(left) - log(right)


def class_pairs(texts, of):
    out = Counter()
    for t in texts:
        chain = [0, *(of[w] for w in t), 0]
        out.update(zip(chain[:-1], chain[1:], strict=True))
    return out


def test_words_go_where_a_plain_exchange_sends_them(spark):
    rng = random.Random(8)
    groups = [[f"{p}{k:02d}" for k in range(14)] for p in ("al", "be", "ce")]
    texts = [[rng.choice(groups[(i + s) % 3]) for i in range(rng.randint(1, 30))] for s in range(3) for _ in range(60)]
    vocabulary = sorted({w for t in texts for w in t})
    n_classes = 6
    word, ending = hashed(vocabulary)
    start = {w: rng.randint(1, n_classes - 1) for w in vocabulary}
    units = brown_lm.Units(word, ending[:0])
    classes = np.zeros(units.size + n_classes, np.int64)
    classes[units.of(word, ending)] = [start[w] for w in vocabulary]
    classes[units.size:] = np.arange(n_classes)
    units.own = brown_lm._by_word(word, [start[w] for w in vocabulary])
    before = class_pairs(texts, start)
    grid = np.zeros((n_classes, n_classes))
    for (a, b), n in before.items():
        grid[a, b] = n
    frame = spark.createDataFrame([(" ".join(t),) for t in texts], "text string").repartition(5)
    got = {r.word: r.cls for r in brown_lm.learn_words(frame, units, classes, grid.copy(), sum(map(len, texts)), 0, 1).collect()}
    assert len(got) == len(vocabulary)
    lost, best_total = 0.0, 0.0
    for w, key in zip(vocabulary, word.view(np.int64).tolist(), strict=True):
        value = [likelihood(class_pairs(texts, start | {w: c})) for c in range(1, n_classes)]
        lost += max(value) - value[got[key] - 1]
        best_total += max(value) - value[start[w] - 1]
    # cells that a word meets from both sides are taken one by one, so a choice may miss by a little
    assert lost < 0.02 * best_total


def test_grid_counts_the_class_pairs_of_the_training_texts(spark):
    docs = cases.frame(spark)
    train = "coalesce(doc_id, 0) % 3 <> 1"
    model, scores = brown_lm.learn_and_score(docs, F.expr(train), n_classes=7, cluster_words=20, suffixes=10, table_words=30, rounds=3)
    rows = [(i, t) for i, t, _ in cases.texts()]
    texts = [(t or "").lower().split() if (t or "").isascii() else None for i, t in rows if (i or 0) % 3 != 1]
    words = sorted({w for t in texts if t for w in t})
    word, ending = hashed(words)
    of = dict(zip(words, model.classes[model.units.of(word, ending)].tolist(), strict=True))
    pairs = class_pairs([t for t in texts if t is not None], of)
    odd = [t for i, t in rows if (i or 0) % 3 != 1 and not (t or "").isascii()]
    total = sum(pairs.values()) + sum(len(t.split()) + 1 for t in odd)
    assert model.grid.sum() == total == model.n
    if not odd:
        assert all(model.grid[a, b] == n for (a, b), n in pairs.items())
    assert all(model.grid[a, b] >= n for (a, b), n in pairs.items())
    assert scores.count() == len(rows)


def test_more_words_than_the_table_move(spark):
    """A table of a few words only: all others move in the last round, by their own neighbours."""
    docs = cases.frame(spark)
    model, counts = brown_lm.learn(docs, n_classes=8, cluster_words=5, suffixes=2, table_words=8, rounds=3)
    start = {r.word for r in counts.collect()}
    assert len(start) == model.v and len(model.words) <= 8
    assert counts.filter("cls between 1 and 7").count() == model.v - 1           # all but the end


def test_empty_tables(spark):
    model, counts = brown_lm.learn(cases.empty(spark), n_classes=5)
    assert counts.count() == 0 and model.n == 0
    got = brown_lm.score(cases.frame(spark), model, counts).collect()
    assert len(got) == len(cases.texts()) and all(r.n_known == 0 and np.isfinite(r.score) for r in got)
    model, counts = brown_lm.learn(cases.frame(spark), n_classes=5)
    assert brown_lm.score(cases.empty(spark), model, counts).count() == 0


def test_rare_words_settle_the_grid_all_together(spark):
    """The group sums hold every count of every word outside the table, none weighed up."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n_classes, n = 6, 500
    word = np.sort(rng.integers(1, 2**62, n).astype(np.uint64))
    cls = rng.integers(1, n_classes, n)
    units = brown_lm.Units(word[:3], word[:0])
    units.own = brown_lm._by_word(word[:50], cls[:50])
    table = rng.poisson(0.4, (n, 2 * n_classes))
    which, cell = np.nonzero(table)
    blob = brown_lm._pack(word, cls, which, cell, table[which, cell])
    batch = pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["data"])
    got, = brown_lm._group_rows([batch], units, n_classes)
    total = np.zeros(n_classes ** 2 * 3 * n_classes + 2 * n_classes ** 2, np.int64)
    total[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    groups = total[:n_classes ** 2 * 2 * n_classes].reshape(-1, 2 * n_classes)
    assert (groups.sum(0) == table[50:].sum(0)).all()
    own = total[n_classes ** 2 * 2 * n_classes:][:2 * n_classes ** 2].reshape(n_classes, -1)
    assert all((own[c] == table[50:][cls[50:] == c].sum(0)).all() for c in range(n_classes))
    right, left = table[:, n_classes:].astype(float), table[:, :n_classes].astype(float)
    grid = rng.integers(50, 400, (n_classes, n_classes)).astype(float)
    assert (brown_lm._best_apart(cls, right, left, grid) == brown_lm.best_classes(cls, right, left, grid, held=False)).all()
    settled = brown_lm._settled(got.to_pandas(), grid + 1000)
    assert settled.sum() == (grid + 1000).sum()


def test_unit_pairs_are_kept_in_a_row_a_bucket(spark, monkeypatch):
    """Pairs of units, summed in bounded runs, against a plain count; so are the neighbours' classes."""
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("ing", "ed", "s", "")]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 40))] for _ in range(90)]
    word, ending = hashed(vocabulary)
    units = brown_lm.Units(word[:9], np.unique(ending)[:5])
    of = dict(zip(vocabulary, units.of(word, ending).tolist(), strict=True))
    want = class_pairs(texts, of)
    frame = spark.createDataFrame([(" ".join(t),) for t in texts] + [(None,)], "text string").repartition(7)
    want[(0, 0)] += 1
    for flush in (brown_lm.FLUSH, 20):
        monkeypatch.setattr(brown_lm, "FLUSH", flush)
        rows = brown_lm._unit_pairs(frame, units).collect()
        assert len(rows) == len({r.bucket for r in rows}) <= brown_lm.PAIR_BUCKETS
        got = Counter()
        for r in rows:
            pair, n = brown_lm._unpack_pairs(r.data)
            assert (np.diff(pair) > 0).all() and (pair % brown_lm.PAIR_BUCKETS == r.bucket).all()
            got.update({divmod(p, units.size): k for p, k in zip(pair.tolist(), n.tolist(), strict=True)})
        assert got == want
    # runs of a task that overlap are summed as well
    parts = [brown_lm._packed_rows([3, 3, 5], [brown_lm._pack_pairs(np.arange(k, k + 30), np.full(30, k + 1)) for k in (0, 10, 2)])]
    got = {b: brown_lm._unpack_pairs(d) for batch in brown_lm._pair_rows(parts) for b, d in zip(batch["bucket"].to_pylist(), batch["data"].to_pylist(), strict=True)}
    assert got[3][1].tolist() == [1] * 10 + [12] * 20 + [11] * 10 and got[5][1].tolist() == [3] * 30
    classes = np.array([rng.randint(1, 3) for _ in range(units.size)])
    classes[0] = 0
    right, left = brown_lm._neighbours(brown_lm._unit_pairs(frame, units), classes, 4)
    plain = np.zeros((2, units.size, 4))
    for (a, b), n in want.items():
        plain[0, a, classes[b]] += n
        plain[1, b, classes[a]] += n
    assert (right == plain[0]).all() and (left == plain[1]).all()


def test_words_come_with_their_counts_and_sums(spark):
    """The classes' sums that smoothing needs and the words' counts come with the moves, as a plain count gives them."""
    texts = [t or "" for _, t, _ in cases.texts()]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    model, counts, rare = brown_lm._learn(frame, "text", 6, 5, 4, 20, 3, 2)
    table = {r.word: (r.n, r.cls) for r in counts.collect()}
    assert {r.word: (r.n, r.cls) for r in rare.collect()} == {w: x for w, x in table.items() if np.uint64(w % 2**64) not in set(model.words.tolist())}
    totals = np.zeros((6, 3))
    for n, c in table.values():
        totals[c] += n, n == 1, n == 2
    once, twice = totals[1:, 1], totals[1:, 2]
    assert (model.total == totals[:, 0]).all() and table[int(brown_lm.END)] == (len(texts), 0)
    assert np.allclose(model.discount[1:], np.clip(np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5), 0.05, 0.95))


def test_row_sums_are_those_of_reduceat():
    rng = np.random.default_rng(5)
    for size, share in ((1, 1), (400, 0.02), (2000, 0.3), (50, 1)):
        term = rng.random((size, 7)) * 10.0 ** rng.integers(-9, 9, (size, 7))
        starts = np.unique(np.append(0, np.flatnonzero(rng.random(size) < share)))
        assert (brown_lm._row_sums(term, starts) == np.add.reduceat(term, starts)).all()
