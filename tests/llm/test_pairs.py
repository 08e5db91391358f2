"""Repeat removal, Jaccard join and decontamination against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from basketry.llm import components, decontaminate, ngram_join, suffix_dedup
from tests.llm import cases

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return (text or "").encode().lower()


def test_repeats_match_brute_force(spark):
    rows = cases.texts()
    for threshold, k in ((50, 24), (20, 6)):
        first = {}
        for i, t, _ in rows:
            data = (t or "").encode()
            for p in range(len(data) - threshold + 1 if i is not None else 0):
                s = data[p:p + threshold]
                first[s] = min(first.get(s, i), i)
        want = Counter()
        for i, t, _ in rows:
            data = (t or "").encode()
            gone = bytearray(len(data))
            for p in range(len(data) - threshold + 1 if i is not None else 0):
                if first[data[p:p + threshold]] < i:
                    gone[p:p + threshold] = b"\1" * threshold
            left = bytes(x for x, g in zip(data, gone, strict=True) if not g)
            spans = len(re.findall(b"\1+", bytes(gone)))
            want[(i, len(data), sum(gone), spans, hashlib.sha256(left).hexdigest())] += 1
        got = Counter(tuple(r) for r in suffix_dedup.remove_repeats(cases.frame(spark), threshold=threshold, k=k).collect())
        assert got == want


def test_repeats_over_piece_borders(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 97)
    rows = [(i, t, s) for i, t, s in cases.texts() if i is not None]
    got = {(r.doc_id, r.kept_sha256) for r in suffix_dedup.remove_repeats(cases.frame(spark, rows)).collect()}
    monkeypatch.undo()
    assert got == {(r.doc_id, r.kept_sha256) for r in suffix_dedup.remove_repeats(cases.frame(spark, rows)).collect()}


def test_kept_bytes_are_returned(spark):
    got = suffix_dedup.remove_repeats(cases.frame(spark), with_text=True).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in got)


def brute_components(rows, words, percent):
    sets = {}
    for i, t, _ in rows:
        w = lower(t).split()
        if i is not None and w:
            sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sets, find


@pytest.mark.parametrize("words,percent,size", [(4, 85, 768), (2, 60, 3), (1, 50, 2)])
def test_join_matches_brute_force(spark, words, percent, size):
    rows = cases.texts()
    sets, find = brute_components(rows, words, percent)
    got = ngram_join.similarity_components(cases.frame(spark), words=words, percent=percent, group_size=size).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.n_shingles == len(sets.get(r.doc_id, ()))
            assert r.component_id == (find(r.doc_id) if r.doc_id in sets else r.doc_id)
        else:
            assert r.component_id is None


def test_size_classes_hold_every_linked_pair():
    for percent in (50, 60, 85, 90):
        classes = ngram_join.SizeClasses(percent, 3000)
        for x in range(1, 1000):
            y = x * 100 // percent                    # the largest set that may link with x
            cx, cy = classes.of(x), classes.of(y)
            assert cy - cx in (0, 1)
            assert y - x <= classes.differ[cx] < classes.parts[cx]


def test_keep_one_leaves_the_smallest(spark):
    rows = cases.texts()
    sets, find = brute_components(rows, 4, 85)
    kept = ngram_join.keep_one(cases.frame(spark)).collect()
    # one row of each: repeated rows once; of the null ids the text of document 1 goes with it, the null text stays
    assert Counter(r.doc_id for r in kept) == Counter({i: 1 for i, _, _ in rows if i is None or i not in sets or find(i) == i})
    assert [r.text for r in kept if r.doc_id is None] == [None]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(51)} | {100 + i: 100 for i in range(40)} | {200: 200, 201: 200}
    assert got == want


def brute_contamination(rows, items, window):
    wins = defaultdict(set)
    for item, t in items:
        w = WORD.findall(lower(t).decode())
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if k else 0):
            wins[tuple(w[s:s + k])].add(item)
    sizes = {len(w) for w in wins}
    out = Counter()
    for i, t, _ in rows:
        w = WORD.findall(lower(t).decode())
        hit, found = set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in wins:
                    hit.update(range(s, s + k))
                    found |= wins[tuple(w[s:s + k])]
        found = sorted(str(x) for x in found if x is not None)
        out[(i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(),
             bool(hit) and 20 * len(hit) >= len(w))] += 1
    return out


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
@pytest.mark.parametrize("window", [13, 4, 1])
def test_contamination_matches_brute_force(spark, broadcast_rows, window):
    rows = cases.texts()
    plain = [t for _, t, _ in rows if t and len(t) > 60]
    items = [(1, plain[2][10:400]), (2, plain[2][10:400]), (3, " ".join(plain[4].split()[3:9])), (4, "x"), (5, None), (6, "..."),
             (None, plain[6]), (7, plain[7].upper()), (7, "repeated item"), (8, "aa aa"), (9, " ".join(plain[8].split()[:12]))]
    bench = spark.createDataFrame([(i, t, "junk") for i, t in items], "item_id long, text string, doc string")
    got = decontaminate.contamination(cases.frame(spark), bench, window=window, broadcast_rows=broadcast_rows)
    assert Counter(tuple(r) for r in got.drop("tag").collect()) == brute_contamination(rows, items, window)


def test_contaminated_documents_and_spans_go(spark):
    rows = cases.texts()
    bench = spark.createDataFrame([(1, rows[2][1])], "item_id long, text string")
    kept = decontaminate.drop_contaminated(cases.frame(spark), bench)
    assert kept.columns == cases.frame(spark).columns
    bad = {k[0] for k, _ in brute_contamination(rows, [(1, rows[2][1])], 13).items() if k[5]}
    assert 2 in bad and {r.doc_id for r in kept.collect()} == {i for i, _, _ in rows} - bad
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(cases.frame(spark), bench).collect()}
    assert not WORD.findall(cut[2]) and cut[5] == rows[5][1]
    assert cut[42].endswith("tail2") and len(WORD.findall(cut[42])) == 1


def test_empty_tables(spark):
    none = cases.empty(spark)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert ngram_join.similarity_components(none).count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    clean = decontaminate.contamination(cases.frame(spark), bench).collect()
    assert len(clean) == len(cases.texts()) and not any(r.contaminated for r in clean)
