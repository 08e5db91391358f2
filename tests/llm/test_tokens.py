"""SentencePiece offsets against the library."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from basketry.llm import piece_offsets, queries, token_alignment
from tests.llm import cases

PIECES = queries.tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "  two  spaces ", "\n\ttab\n", "a▁b ▁ c", "<s> </s> <unk> <0x41>", "é é ﬁ ㎏ ①½ Å", "가각힣 가", "\U0001f600‍\U0001f525 ॐ", "\x00\x01 nul", "ＡＢＣ　ｆｕｌｌ",
       "x" * 300, " lead", "trail ", "　   wide", "ｶﾞｷﾞ ﾊﾟ", "﻿bom �", "ㅎㅏㄴ", "…‥ ™ ℡ ㍿"]


def block(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(x) for x in data])


def strange(seed, n):
    rng = random.Random(seed)
    alphabet = [c for x in ODD for c in x] + list("abc de. ") * 6 + [chr(k) for k in (*range(0x300, 0x320), *range(0xAC00, 0xAC20), *range(0xFF00, 0xFF60), *range(0x2460, 0x2470))]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf"])
@pytest.mark.parametrize("prefix,strip,escape", [(True, True, True), (True, False, True), (False, True, True), (False, False, False)])
def test_normaliser_and_its_alignment_equal_the_library(rule, prefix, strip, escape):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=strip, escape_whitespaces=escape)
    own = piece_offsets.Normaliser(library.serialized_normalizer_spec())
    assert (own.dummy_prefix, own.strip, own.escape) == (prefix, strip, escape)
    texts = ODD + strange(3, 400)
    data, to, align = own(*block(texts))
    for r, text in enumerate(texts):
        got = data[to[r]:to[r + 1]].tobytes().decode()
        want, offsets = library.normalize(text, with_offsets=True)
        assert got == want, text
        # the library tells characters, we tell bytes
        byte_at = np.cumsum([0] + [len(c.encode()) for c in text])
        edge = np.cumsum([0] + [len(c.encode()) for c in got])
        if want:
            assert align[to[r] + r + edge].tolist() == [byte_at[k] for k in offsets], text


def model(rule=None, **options):
    proto = sentencepiece.SentencePieceProcessor(model_file=PIECES).serialized_model_proto()
    if rule is None:
        return proto
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule, **options).serialized_normalizer_spec()
    kept = b"".join(proto[a:b] for number, _, a, b in piece_offsets._fields(proto) if number not in (3, 4))
    return kept + piece_offsets._message(3, spec)


def without_bytes():
    """The model without byte fallback: characters it lacks are unknown pieces."""
    out, proto = b"", model()
    for number, value, a, b in piece_offsets._fields(proto):
        if number == 1 and b"\x18\x06" in value:                  # a piece of kind BYTE becomes UNUSED
            out += piece_offsets._message(1, value.replace(b"\x18\x06", b"\x18\x05"))
        elif number == 2:
            out += piece_offsets._message(2, value + bytes([35 << 3 & 127 | 128, 35 << 3 >> 7, 0]))
        elif number != 4:
            out += proto[a:b]
    return out


@pytest.mark.parametrize("proto", [model(), without_bytes(), model("nmt_nfkc", add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True),
                                   model("nfkc_cf", add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=True)])
def test_pieces_and_spans_equal_the_library(proto):
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    own = piece_offsets.Encoder(proto)
    texts = ODD + strange(4, 300) + [t or "" for _, t, _ in cases.texts()]
    ids, count, begin, end = own.encode(*block(texts))
    edge = np.cumsum(count)
    decoded = own.decode(ids, count)
    for r, text in enumerate(texts):
        a, b = edge[r] - count[r], edge[r]
        assert ids[a:b].tolist() == library.encode(text), text
        assert decoded[r] == library.decode(library.encode(text))
        pieces = library.encode(text, return_type="proto").pieces
        for k, p in enumerate(pieces):
            if not library.is_byte(p.id):      # the library gives all bytes of a character to the last of its pieces
                assert (begin[a + k], end[a + k]) == (p.begin, p.end), (text, k)
        assert (begin[a:b] <= end[a:b]).all() and (begin[a:b][1:] == end[a:b][:-1]).all()


def test_byte_pieces_stand_for_their_own_bytes():
    text = "a \U0001f525b"
    own = piece_offsets.Encoder(model())
    ids, count, begin, end = own.encode(*block([text]))
    raw = text.encode()
    for i, a, b in zip(ids.tolist(), begin.tolist(), end.tolist(), strict=True):
        if own.whole.is_byte(i):
            assert b - a == 1 and own.whole.id_to_piece(i) == f"<0x{raw[a]:02X}>"
    assert sum(end - begin) == len(raw)


def test_encode_on_spark_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = piece_offsets.encode(cases.frame(spark), PIECES).collect()
    want = Counter((i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t, _ in cases.texts())
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == want
    assert piece_offsets.encode(cases.empty(spark), PIECES).count() == 0


def test_encode_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for i, t in rows:
        ids = library.encode(t or "")
        want.add((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), len((t or "").encode())))
    got = queries.op13_piece_offsets(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_source_bytes").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(rows)


# ------------------------------------------------------------ alignment of two tokenizers
BYTES = queries.tokenizer_path("byte_bpe_50k.json")


def plain_alignment(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, sha) of each text, token by token."""
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(BYTES)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = token_alignment.ByteLevel(open(BYTES, encoding="utf-8").read())
    spelled = {}
    docs = []
    for text in texts:
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        for k in a:
            spelled.setdefault(k, own.data[own.start[k]:own.start[k] + own.size[k]].tobytes())
        b_bytes = [bytes([int(p[3:5], 16)]) if b_side.is_byte(k) else p.replace("▁", " ").encode() for k, p in ((k, b_side.id_to_piece(k)) for k in b)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(spelled[k] for k in a) != whole or b"".join(b_bytes) != whole:
            docs.append(None)
            continue
        spans = []
        for ids, sizes in ((a, [len(spelled[k]) for k in a]), (b, [len(x) for x in b_bytes])):
            edge = np.cumsum([0] + sizes).tolist()
            spans.append(list(zip(ids, edge[:-1], edge[1:], strict=True)))
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        group = {cut: ([], []) for cut in cuts}
        for k, side in enumerate(spans):
            at = 0
            for token, _, e in side:
                at += e > cuts[at]
                group[cuts[at]][k].append(str(token))
        written = ["|".join(",".join(x) for x in group[cut]) for cut in cuts]
        links, first = [], 0
        for k, s, e in spans[0]:
            while spans[1][first][2] <= s:
                first += 1
            at = first
            while at < len(spans[1]) and spans[1][at][1] < e:
                links.append((k, spans[1][at][0]))
                at += 1
        docs.append((len(a), len(b), len(cuts), links, hashlib.sha256(";".join(written).encode()).hexdigest()))
    count = Counter(p for d in docs if d for p in set(d[3]))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (*d[:3], len(d[3]), sum(count[p] == most[p[0]] for p in d[3]), sum(count[p] for p in d[3]), d[4]) for d in docs]


@pytest.mark.parametrize("table,block,flush", [(1 << 20, 1 << 18, 2_000_000), (100, 3000, 500), (0, 100, 1)])
def test_alignment_equals_plain_alignment(spark, monkeypatch, table, block, flush):
    monkeypatch.setattr(token_alignment, "TABLE_PAIRS", table)
    monkeypatch.setattr(token_alignment, "BLOCK", block)
    monkeypatch.setattr(token_alignment, "FLUSH", flush)
    rows = cases.texts() + [(2000 + k, t, "s") for k, t in enumerate([*ODD, *strange(6, 60), "<|endoftext|> plain", " <s>", "ab" * 2000])]
    rows += [(3000 + k, rows[2][1], "hot") for k in range(len(rows) // 2)]
    got = token_alignment.align(cases.frame(spark, rows), BYTES, PIECES).collect()
    want = Counter((i, *x) for (i, _, _), x in zip(rows, plain_alignment([t for _, t, _ in rows]), strict=True))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert Counter(tuple(r[n] for n in names) for r in got) == want


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.align(cases.empty(spark), BYTES, PIECES).count() == 0


def test_groups_equal_cuts_at_common_ends(spark):
    rows = [(k, t, "s") for k, t in enumerate(ODD + strange(8, 30))]
    for r in token_alignment.groups(cases.frame(spark, rows), BYTES, PIECES).collect():
        assert sorted(set(r.a_group)) == sorted(set(r.b_group)) == list(range(len(set(r.a_group))))
        assert list(r.a_group) == sorted(r.a_group) and list(r.b_group) == sorted(r.b_group)


def test_pointers_reach_the_terminal_of_long_chains():
    """Tokens that overlap like bricks over 100,000 bytes are one group."""
    a = np.arange(0, 100_001, 2)
    b = np.concatenate([[0], np.arange(1, 100_000, 2), [100_000]])
    in_a, in_b = token_alignment.groups_of(a[:-1], a[1:], b[:-1], b[1:])
    assert len(set(in_a.tolist())) == 1 and set(in_b.tolist()) == set(in_a.tolist())
    cut = np.array([0, 4, 7, 9, 12])
    in_a, in_b = token_alignment.groups_of(cut[:-1], cut[1:], np.array([0, 2, 4, 8, 9]), np.array([2, 4, 8, 9, 12]))
    assert in_a.tolist() == [0, 2, 2, 3] and in_b.tolist() == [0, 0, 2, 2, 3]


def test_alignment_query_equals_plain_alignment(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {(i, *x) for (i, _), x in zip(rows, plain_alignment([t for _, t in rows]), strict=True)}
    assert {tuple(r) for r in queries.op12_token_alignment(spark, sf).collect()} == want
