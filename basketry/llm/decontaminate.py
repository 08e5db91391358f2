"""Benchmark decontamination with built-in DataFrame functions only.

A benchmark item's windows are its runs of ``window`` (13) consecutive words;
an item of fewer words, but not none, is one window.  A document word inside
any occurrence of a window is hit.

* *Hash set.*  A run of k words that starts anywhere in a document contains a
  whole aligned block of b = (k+1) // 2 words (it starts at a multiple of b).  So
  the set holds the hashes of every b-word run inside a window, and a
  document only probes its aligned blocks: one probe per 7 words for 13-word
  windows, instead of one per word.
* *Probe.*  The set is broadcast when it has at most ``broadcast_rows`` rows, and
  the probing rows are generated and joined inside one code-generated stage;
  words are sliced only for blocks that hit.  A larger set is joined by shuffle
  on the block's hash, each block carrying the words around it.
* *Verification.*  Around a block that hits, the full windows are compared as
  text with the benchmark's windows.  Coverage is the union of the verified
  windows' word ranges per document.

Defined cases: null texts and texts without words have no words and no hits;
an item without words has no window; a null item id hits but is not listed;
rows which share id and text get the same result each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common as C

#: ASCII letters (lower-cased), digits, and every character from U+0080 on.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(col):
    found = F.regexp_extract_all(C.ascii_lower(col), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct (item, k, win): every window's text (words joined by one space)."""
    words = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("w")).filter("size(w) > 0")
    sized = words.withColumn("k", F.least(F.size("w"), F.lit(window)))
    return sized.select("item", "k", F.explode(F.expr(
        "transform(sequence(0, size(w) - k), s -> array_join(slice(w, s + 1, k), ' '))")).alias("win")).distinct()


def _blocks(windows: DataFrame) -> DataFrame:
    """Distinct hashes of the runs of (k+1) div 2 words inside the windows."""
    return windows.withColumn("w", F.split("win", " ")).select(F.explode(F.expr(
        "transform(sequence(0, k - (k + 1) div 2), s -> xxhash64(cast((k + 1) div 2 as int), slice(w, s + 1, (k + 1) div 2)))")).alias("h")).distinct()


def find_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text", window: int = 13,
              broadcast_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(texts, hits): doc, tag, n_words of every row of ``docs``; doc, tag, p, k, win, item of the
    verified window occurrences (p: the window's first word, from 0; one row per item that has it)."""
    windows = C.checkpointed(benchmark_windows(items, item_id_col, item_text_col, window))
    sizes = sorted(r.k for r in windows.select("k").distinct().collect())     # at most ``window`` values
    blocks = _blocks(windows)
    small = blocks.count() <= broadcast_rows
    texts = windows.select("win").distinct()

    source = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("tag"), words_of(F.col(text_col)).alias("w"))
    by_block = {b: [k for k in sizes if (k + 1) // 2 == b] for b in sorted({(k + 1) // 2 for k in sizes})}
    # the first entry stands for the text itself and survives the join without a partner
    probes = ["array(named_struct('h', cast(null as bigint), 'at', -1, 'b', 0))"]
    probes += [f"if(size(w) >= {b}, transform(sequence(0, size(w) div {b} - 1), "
               f"i -> named_struct('h', xxhash64({b}, slice(w, i * {b} + 1, {b})), 'at', i * {b}, 'b', {b})), "
               f"cast(array() as array<struct<h:bigint,at:int,b:int>>))" for b in by_block]
    probing = source.withColumn("probes", F.expr(f"concat({', '.join(probes)})"))
    # explode_outer: for explode Catalyst infers a filter on the array and would compute it, lambdas and all, from the text
    exploded = probing.select("doc", "tag", "w", F.size("w").alias("n_words"), F.explode_outer("probes").alias("probe")).select(
        "doc", "tag", "w", "n_words", F.col("probe.h").alias("h"), F.col("probe.at").alias("at"), F.col("probe.b").alias("b"))
    marked = blocks.withColumn("hit", F.lit(True))
    # words around a block: from the first to the last window that holds it
    around = F.expr(f"slice(w, greatest(at + b - least(2 * b, {window}), 0) + 1, 2 * least(2 * b, {window}) - b)")
    if small:
        kept = exploded.join(F.broadcast(marked), "h", "left").filter("hit or at < 0").withColumn("near", around)
    else:
        kept = exploded.withColumn("near", around).drop("w").join(marked, "h", "left").filter("hit or at < 0")

    options = ["array(named_struct('p', -1, 'k', 0, 'win', ''))"]
    for b, ks in by_block.items():
        for k in ks:
            lo, hi = f"greatest(at + {b - k}, 0)", f"least(at, n_words - {k})"
            base = f"greatest(at + {b - min(2 * b, window)}, 0)"
            options.append(f"if(b = {b} and {hi} >= {lo}, transform(sequence({lo}, greatest({lo}, {hi})), "
                           f"p -> named_struct('p', p, 'k', {k}, 'win', array_join(slice(near, p - {base} + 1, {k}), ' '))), "
                           f"cast(array() as array<struct<p:int,k:int,win:string>>))")
    runs = f"filter(concat({', '.join(options)}), run -> run.k > 0)"
    kept = C.checkpointed(kept.select("doc", "tag", "n_words", "at", F.expr(f"if(at < 0, null, {runs})").alias("runs")))

    found = (kept.filter("at >= 0").select("doc", "tag", F.explode("runs").alias("run"))
             .select("doc", "tag", F.col("run.p").alias("p"), F.col("run.k").alias("k"), F.col("run.win").alias("win")))
    hits = found.join(F.broadcast(texts) if small else texts, "win", "left_semi").distinct()
    return kept.filter("at < 0").select("doc", "tag", "n_words"), (C.checkpointed(hits), windows.select("win", "item"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = 13,
                  share: int = 20, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    tag (hash of the text).  Contaminated: n_hit > 0 and share * n_hit >= n_words."""
    texts, (hits, owners) = find_hits(docs, items, id_col, text_col, item_id_col, item_text_col, window, broadcast_rows)
    before = Window.partitionBy("doc", "tag").orderBy("p", "k").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("p") + F.col("k")).over(before), F.lit(0))
    new_words = F.greatest(F.lit(0), F.col("p") + F.col("k") - F.greatest(F.col("p"), reached))
    covered = (hits.select("doc", "tag", "p", "k").distinct().withColumn("new", new_words)
               .groupBy("doc", "tag").agg(F.sum("new").alias("n_hit")))
    listed = (hits.select("doc", "tag", "win").distinct().join(owners.filter("item is not null"), "win")
              .select("doc", "tag", F.col("item").cast("string").alias("item")).distinct()
              .groupBy("doc", "tag").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items")))
    found = covered.join(listed, _same(covered, listed), "left").select(covered.doc, covered.tag, "n_hit", "n_items", "items")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    joined = texts.join(found, _same(texts, found), "left")
    return joined.select(
        texts.doc.alias("doc_id"), texts.tag.alias("tag"), F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


def _same(left: DataFrame, right: DataFrame):
    return left.doc.eqNullSafe(right.doc) & left.tag.eqNullSafe(right.tag)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text is not contaminated."""
    bad = contamination(docs, items, id_col, text_col, **options).filter("contaminated").select(
        F.col("doc_id").alias("__doc"), F.col("tag").alias("__tag")).distinct()
    tagged, bad = docs.withColumn("__own", F.xxhash64(text_col)), C.join_side(bad)
    return tagged.join(bad, tagged[id_col].eqNullSafe(bad["__doc"]) & (F.col("__own") == F.col("__tag")), "left_anti").drop("__own")


def cut_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut out of the texts; what stands between words stays."""
    _, (hits, _) = find_hits(docs, items, id_col, text_col, **options)
    spans = hits.groupBy("doc", "tag").agg(F.array_distinct(F.flatten(F.collect_list(F.expr("sequence(p, p + k - 1)")))).alias("__hit")).select(
        F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), "__hit")
    tagged = docs.withColumn("__own", F.xxhash64(text_col))
    joined = tagged.join(spans, tagged[id_col].eqNullSafe(spans["__doc"]) & (F.col("__own") == F.col("__tag")), "left")
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    parts = (joined.withColumn("__w", F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0)))
             .withColumn("__gap", F.split(text_col, pattern)))
    rebuilt = F.expr("array_join(transform(__gap, (g, i) -> concat(g, if(i >= size(__w) or array_contains(__hit, i), '', __w[i]))), '')")
    return parts.withColumn(text_col, F.when(F.col("__hit").isNull(), F.col(text_col)).otherwise(rebuilt)).select(*docs.columns)
