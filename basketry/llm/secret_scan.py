"""Secret scanning with corpus-wide ownership frequency.

*Candidates* are found per text: the base kinds (assignments, access keys, long
hex strings) and further ones which only the corpus can judge (vendor-prefixed keys,
web tokens, private key blocks, and long mixed strings of high entropy).

*Ownership.*  Spark counts, for the hash of each candidate's value, the distinct
owners and repositories that hold it; rows are made distinct and summed before
each shuffle, so a value found everywhere is no hot key.  A value held by
``wide_owners`` owners or more, or in ``wide_repos`` repositories or more (of one
owner or several), is a widely copied example; one held by fewer is
owner-specific and live-looking, unless it is an obvious placeholder.

Base spans are always reported; the other candidates only if live-looking.

Work on a text grows linearly with its length and its candidates.  Defined cases: a null or
empty text has no candidates; of overlapping candidates the kind listed first, then the first place, is taken; a null owner counts as
one owner of its own, a null repository as one repository; repeated rows get the same result each.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common as C

KINDS = ("assign", "access", "hex", "vendor", "jwt", "pem", "mixed")
BASE_KINDS = 3
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
# Public prefixes and shapes of credentials.
VENDOR = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
                    r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|ASIA[A-Z0-9]{16})", re.A)
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", re.A)
# the header, then lines of a key (20 characters or more, the last one before the end line may be shorter): prose is none
PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:\s+[A-Za-z0-9+/=]{20,}+(?!\S))+(?:\s+[A-Za-z0-9+/=]{1,19}(?=\s+-----END))?"
                 r"(?:\s+-----END (?:[A-Z]+ )*PRIVATE KEY-----)?", re.A)
MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{24,}", re.A)
PLACEHOLDER = re.compile(r"example|sample|changeme|placeholder|dummy|your[_-]?|xxxx|\*\*\*\*|(.)\1{7}", re.I | re.A)
#: Bytes of text turned into Python strings at once.
BLOCK = 1 << 18
#: Bits a character of a mixed string must have on average.
ENTROPY = 3.5

_SPAN = "struct<start:bigint,kind:int,end:bigint,value:binary,dummy:boolean>"


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the three base kinds, by start and kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def _disjoint(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places in order, overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(places):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def further_spans(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Candidates of the other kinds that no span found before overlaps."""
    found: list[tuple[int, int, int, str]] = []
    covered = _disjoint([(s, e) for s, _, e, _ in taken])

    def add(kind: int, pattern: re.Pattern, good=lambda s: True) -> None:
        nonlocal covered
        more, at = [], 0
        for m in pattern.finditer(text):                 # matches and covered places both come in order
            while at < len(covered) and covered[at][1] <= m.start():
                at += 1
            if (at == len(covered) or covered[at][0] >= m.end()) and good(m[0]):
                more.append((m.start(), kind, m.end(), m[0]))
        found.extend(more)
        covered = _disjoint(covered + [(s, e) for s, _, e, _ in more])

    if any(sign in text for sign in ("_", "glpat-", "xox", "AIza", "ASIA")):
        add(3, VENDOR)
    if "eyJ" in text:
        add(4, JWT)
    if "-----BEGIN" in text:
        add(5, PEM)
    add(6, MIXED, lambda s: re.search("[a-z]", s) and re.search("[A-Z]", s) and _entropy(s) >= ENTROPY)
    return sorted(found)


def _slices(batches, column: str):
    """Slices of the batches with about BLOCK bytes of text each (or one row)."""
    for batch in batches:
        _, offsets = C.texts_of(batch.column(column))
        for i, j in C.blocks(offsets, BLOCK):
            yield batch.slice(i, j - i)


def _rows(batches):
    for batch in _slices(batches, "text"):
        counts, shas, spans = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text) if text else []
            counts.append([sum(1 for s in base if s[1] == k) for k in range(BASE_KINDS)])
            joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base)
            shas.append(hashlib.sha256(joined.encode()).hexdigest())
            rest = further_spans(text, base) if text else []
            spans.append([{"start": s, "kind": k, "end": e, "value": hashlib.blake2b(v.encode("utf-8", "surrogatepass"), digest_size=16).digest(),
                           "dummy": bool(PLACEHOLDER.search(v))} for s, k, e, v in sorted(base + rest)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.binary()), ("dummy", pa.bool_())]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc", "owner", "repo", "tag")), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(BASE_KINDS)),
             pa.array(shas, pa.string()), pa.array(spans, kind)],
            names=["doc", "owner", "repo", "tag", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def ownership(candidates: DataFrame) -> DataFrame:
    """value, n_owners, n_repos, n_places of candidate values (columns value, owner, repo)."""
    by_repo = candidates.groupBy("value", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_places"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None,
         wide_owners: int = 5, wide_repos: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example, live (the places of live-looking spans), held (owners and repositories of each
    candidate's value) and tag (hash of the text).

    ``repo_col`` defaults to the id: each document is then a repository of its owner.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(owner_col).cast("string").alias("owner"),
                         F.col(repo_col or id_col).cast("string").alias("repo"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text"))
    # the checkpoint fixes rows and partitions, so the numbers given to rows stay the same
    rows = C.checkpointed(source.mapInArrow(
        lambda it: C.trimmed(_rows(it)), f"doc long, owner string, repo string, tag long, n_assign long, n_access long, n_hex long, base_sha256 string, found array<{_SPAN}>"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    places = rows.select("row", "owner", "repo", F.explode("found").alias("s")).select("row", "owner", "repo", "s.*")
    known = ownership(places.select("value", "owner", "repo"))
    live = (F.col("n_owners") < wide_owners) & (F.col("n_repos") < wide_repos) & ~F.col("dummy")
    judged = (places.join(known, "value").withColumn("is_live", live)
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "is_live", "n_owners", "n_repos"))).alias("all")))
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    spans = F.expr(f"array_join(transform(filter(all, s -> s.kind < {BASE_KINDS} or s.is_live), "
                   f"s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')")
    return rows.join(judged, "row", "left").select(
        F.col("doc").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(spans, F.lit("")).alias("spans"),
        F.expr("coalesce(size(filter(all, s -> s.is_live)), 0)").cast("long").alias("n_live"),
        F.expr("coalesce(size(filter(all, s -> not s.is_live)), 0)").cast("long").alias("n_example"),
        F.expr("coalesce(transform(filter(all, s -> s.is_live), s -> struct(s.start, s.end)), array())").alias("live"),
        F.expr("coalesce(transform(all, s -> struct(s.start, s.end, s.n_owners, s.n_repos)), array())").alias("held"), "tag")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
           wide_owners: int = 5, mark: str = "[secret]", wide_repos: int = 100) -> DataFrame:
    """``docs`` with live-looking spans replaced by ``mark``; widely copied examples stay.

    Texts are matched by id and hash, so rows that repeat are all redacted.
    """
    found = scan(docs, id_col, text_col, owner_col, wide_owners=wide_owners, wide_repos=wide_repos)
    live = (found.filter("n_live > 0").groupBy(F.col("doc_id").alias("__doc"), F.col("tag").alias("__tag"))
            .agg(F.first("live").alias("__live")))
    columns = docs.columns
    joined = docs.withColumn("__own", F.xxhash64(text_col)).join(
        C.join_side(live, 100_000), F.col(id_col).cast("long").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__tag")), "left")

    def change(batches):
        at = columns.index(text_col)
        for batch in _slices(batches, text_col):
            texts = [_masked(t, live, mark) if live else t for t, live in
                     zip(batch.column(at).to_pylist(), batch.column("__live").to_pylist(), strict=True)]
            arrays = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return joined.select(*columns, "__live").mapInArrow(lambda it: C.trimmed(change(it)), docs.schema)


def _masked(text: str, live: list[dict], mark: str) -> str:
    out, at = [], 0
    for start, end in sorted((s["start"], s["end"]) for s in live):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)         # overlapping spans are one
    return "".join(out) + text[at:]
