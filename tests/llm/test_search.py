"""Ranked search against a plain scoring of all documents."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from basketry.llm import ranked_search
from tests.llm import cases


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k):
    """(item row, rank, id, score) by scoring every document."""
    found = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in found)
    total = sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for row, (item, text) in enumerate(items):
        scored = []
        for i, c in found:
            if c:
                m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                            for t in terms(text) if c[t])
                if score > 0:
                    scored.append((-score, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scored[:k])]
    return Counter(out)


def items_of(rows):
    texts = [t for _, t, _ in rows if t]
    return [(1, texts[0]), (2, texts[3][:60] + " " + texts[3][:60]), (3, "ba ba co dibafu"), (4, ""), (5, None), (6, "nowhere to be"), (7, "AA aa é"),
            (1, texts[0]), (8, texts[9] + " x"), (None, texts[12]), (9, " ".join(texts[:12]))]


def search(spark, rows, items, k=10):
    frame = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in items], "item_id long, text string, query string, doc string, rank string")
    return Counter((r["item"], r["rank"], r.doc, r.score) for r in ranked_search.search(cases.frame(spark, rows), frame, k).collect())


@pytest.mark.parametrize("postings,k,opened", [(500_000, 10, 64), (300, 3, 4), (40, 1, 1), (1000, 100, 64)])
def test_search_equals_plain_scoring(spark, monkeypatch, postings, k, opened):
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "OPENED", opened)
    rows = cases.texts()
    assert search(spark, rows, items_of(rows), k) == plain([(i, t) for i, t, _ in rows], items_of(rows), k)


def test_blocks_of_queries_give_the_same(spark, monkeypatch):
    rows = cases.texts()
    items = [x for x in items_of(rows) if x[0] != 1] + [(1, rows[0][1])]
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 2000)
    assert search(spark, rows, items) == plain([(i, t) for i, t, _ in rows], items, 10)


def test_one_text_in_a_third_of_the_rows(spark):
    rows = cases.texts()
    rows += [(1000 + k, rows[0][1], "hot") for k in range(len(rows) // 2)]
    assert search(spark, rows, items_of(rows)) == plain([(i, t) for i, t, _ in rows], items_of(rows), 10)


def test_empty_tables(spark):
    rows = cases.texts()
    assert not search(spark, [], items_of(rows))
    assert not search(spark, rows, [])
    assert not search(spark, [(1, None, "s"), (2, " .,", "s")], items_of(rows))


def test_range_maxima_and_the_documents_opened():
    """Bounds are exact range maxima, and the search leaves most documents unopened."""
    rng = np.random.default_rng(3)
    held = []
    for _ in range(4):
        doc = rng.permutation(3000)[:1500]
        owner = np.repeat(np.arange(1500), 6)
        held.append((doc, rng.integers(5, 400, 1500), owner + 1500 * len(held), rng.integers(0, 40, 9000), rng.integers(1, 9, 9000)))
    doc, n, owner, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
    pair, first = np.unique(owner * 40 + term, return_index=True)
    kept, found, data, size, some, df = ranked_search._shard([(doc, n, pair // 40, pair % 40, tf[first])], 40)
    weight = ranked_search.weights(6000, np.bincount(pair % 40, minlength=40) * 7)
    shard = ranked_search.Shard(data, size, kept, found, weight, 6000, int(n.sum()))
    by_doc = defaultdict(dict)
    for key, impact in zip(shard.key.tolist(), shard.impact.tolist(), strict=True):
        by_doc[key % shard.held][key // shard.held] = impact
    asked, times = np.array([1, 7, 30]), np.array([1, 2, 1])
    lo, hi = np.array([0, 10, 5000, 77]), np.array([6000, 11, 5900, 78])
    bound, _ = shard.bounds(asked, times, lo, hi)
    for k in range(4):
        assert bound[k] == sum(x * max([by_doc[d].get(int(t), 0) for d in range(lo[k], hi[k])]) for t, x in zip(asked, times, strict=True))
    opened = []
    score = shard.scores
    shard.scores = lambda term, times, places: (opened.extend(places), score(term, times, places))[1]
    got = sorted((-s, shard.doc[p]) for s, p in shard.search(asked, times, 10))
    want = sorted((-sum(x * by_doc[d].get(int(t), 0) for t, x in zip(asked, times, strict=True)), shard.doc[d]) for d in range(6000))[:10]
    assert got == want
    assert len(opened) == len(set(opened)) < 2000


def test_products_beyond_64_bits():
    n = np.array([10 ** 7, 3])
    got = ranked_search.impacts(np.array([5, 5]), np.array([2, 1]), n, 10 ** 11, 10 ** 14)
    m = [25 + 75 * int(x) * 10 ** 11 // 10 ** 14 for x in n]
    assert got.tolist() == [5 * ((10 ** 9 * t) // (1000 * t + 8 * y)) for t, y in zip((2, 1), m, strict=True)]
