"""Kernel ridge regression and attention scores against plain forms."""

import math

import numpy as np

from basketry.llm import quality_mil, string_kernel
from tests.llm import cases


def blocks(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(x) for x in data])


# ------------------------------------------------------------ language
_PLACES: dict[bytes, set] = {}


def place_of(gram):
    """The place of one n-gram, in Python integers."""
    if gram not in _PLACES:
        n = len(gram)
        raw, x = np.frombuffer(gram, np.uint8).astype(np.uint64), 0
        for k in range(n):
            x |= int(raw[k]) << 8 * k
        mixed = ((x ^ x >> 15) * 0x2C1B3C6D + (n * 0x9E3779B1 & 0xFFFFFFFF)) & 0xFFFFFFFF
        _PLACES[gram] = {(((mixed ^ mixed >> 12) * 0x297A2D39) & 0xFFFFFFFF) >> 17}
    return _PLACES[gram]


def sets_of(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    return set().union(*(place_of(raw[i:i + n]) for n in range(1, 5) for i in range(len(raw) - n + 1)), set())


def kernel(a, b):
    return len(a & b) / math.sqrt(max(len(a), 1) * max(len(b), 1))


def test_scores_equal_plain_kernel_ridge_regression():
    rng = np.random.default_rng(4)
    stems = {"aa": ["ka", "to", "mi", "re"], "bb": ["sch", "ung", "ein", "der"], "cc": ["que", "los", "ci", "del"]}
    labels = [lang for lang, n in (("aa", 12), ("bb", 9), ("cc", 15)) for _ in range(n)]
    make = lambda lang: " ".join("".join(rng.choice(stems[lang], rng.integers(1, 4))) for _ in range(rng.integers(3, 12)))
    texts, fresh = [make(x) for x in labels], [make(x) for x in ("aa", "bb", "cc")] + ["Q", "Zz top"]
    raw, offsets = blocks(texts)
    model = string_kernel.fit(string_kernel.presence(raw, offsets), labels, landmarks=10, ridge=0.1)
    got = model.scores(string_kernel.presence(*blocks(fresh)))
    # the same from sets, kernels and one least-squares problem a language
    own, asked = [sets_of(t) for t in texts], [sets_of(t) for t in fresh]
    seen, turn = {}, []
    for x in labels:
        turn.append(seen.get(x, 0))
        seen[x] = turn[-1] + 1
    marks = [own[i] for i in sorted(range(len(labels)), key=lambda i: (turn[i], labels[i]))[:10]]
    between = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(between)
    root = vectors / np.sqrt(values)
    mapped = np.array([[kernel(a, b) for b in marks] for a in own]) @ root
    weight = np.array([1 / seen[x] for x in labels])
    weight *= len(labels) / weight.sum()
    out = np.zeros((len(fresh), 3))
    for k, lang in enumerate(sorted(seen)):
        target = np.array([1.0 if x == lang else -1.0 for x in labels])
        left = np.vstack([np.sqrt(weight)[:, None] * np.hstack([mapped, np.ones((len(own), 1))]),
                          np.hstack([np.sqrt(0.1) * np.eye(mapped.shape[1]), np.zeros((mapped.shape[1], 1))])])
        right = np.concatenate([np.sqrt(weight) * target, np.zeros(mapped.shape[1])])
        beta = np.linalg.lstsq(left, right, rcond=None)[0]
        out[:, k] = np.array([[kernel(a, b) for b in marks] for a in asked]) @ root @ beta[:-1] + beta[-1]
    assert np.allclose(got, out, atol=2e-4)


# ------------------------------------------------------------ quality
def test_scores_equal_a_plain_forward_pass(spark):
    """Document by document, passage by passage, with Python's own functions."""
    rng = np.random.default_rng(2)
    texts = [t or "" for _, t, _ in cases.texts()]
    bags = []
    for t in texts:
        found, _ = quality_mil.passage_features(*blocks([t]), 64)
        bags.append(found)
    net = quality_mil.fit(bags, rng.integers(0, 2, len(bags)), hidden=5, attention=3, epochs=2, rate=0.01, decay=1e-3, seed=1)
    p = net.p
    got = net.scores(np.concatenate(bags), np.repeat(np.arange(len(bags)), [len(b) for b in bags]))
    for bag, score in zip(bags, got.tolist(), strict=True):
        hidden, energy = [], []
        for f in bag:
            x = [min(max((a - m) / s, -6), 6) for a, m, s in zip(f, net.mean, net.scale, strict=True)]
            h = [math.tanh(sum(x[i] * p["W"][i][j] for i in range(len(x))) + p["b"][j]) for j in range(5)]
            e = 0.0
            for k in range(3):
                v, u = (sum(h[j] * p[name][j][k] for j in range(5)) for name in "VU")
                e += p["w"][k] * math.tanh(v) / (1 + math.exp(-u))
            hidden.append(h)
            energy.append(e)
        top = [math.exp(e - max(energy)) for e in energy]
        z = [sum(a * h[j] for a, h in zip(top, hidden, strict=True)) / sum(top) for j in range(5)]
        want = 1 / (1 + math.exp(-(sum(z[j] * p["c"][j] for j in range(5)) + p["d"][0])))
        assert abs(score - want) < 1e-9
