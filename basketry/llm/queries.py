"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import brown_lm, common, decontaminate, htmltree, lz_fingerprint, ngram_join, oracle, packing, piece_offsets, quality_mil, ranked_search, secret_scan, string_kernel, suffix_dedup, token_alignment
from basketry.llm.common import read_table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file; it stays outside this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the benchmark's 13-word windows."""
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("tag")


def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram model learnt from six sevenths of the documents; log10 probability of all."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = common.id_crc(F.col("doc_id"), 7) == 2
    model, scores = brown_lm.learn_and_score(docs, ~held_out)
    return scores.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, judged by how many sources hold the same value."""
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of the labelled ones."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = common.id_crc(F.col("doc_id"), 4) == 2
    model = string_kernel.learn(docs.filter(~held_out))
    return string_kernel.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase fingerprints of every document and of its edited text."""
    return lz_fingerprint.fingerprints(read_table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltree.extract(read_table(spark, sf_dir, "pages"))


def op8_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from two thirds of the labelled ones."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = common.id_crc(F.col("doc_id"), 3) == 1
    net = quality_mil.learn(docs, labels.filter(~held_out))
    return quality_mil.score(docs, net).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes repeated from documents with smaller ids (50 bytes and more) are cut out."""
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return ngram_join.similarity_components(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document."""
    return token_alignment.align(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_piece_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in SentencePiece ids and back; the source bytes that its pieces cover."""
    found = piece_offsets.encode(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    covered = F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), covered.alias("n_source_bytes"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_brown_lm": op2_brown_lm,
        "op3_packing": op3_packing,
        "op4_secret_scan": op4_secret_scan,
        "op5_language_id": op5_language_id,
        "op6_lz_fingerprint": op6_lz_fingerprint,
        "op7_html_extract": op7_html_extract,
        "op8_quality_mil": op8_quality_mil,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_ngram_join": op10_ngram_join,
        "op11_ranked_search": op11_ranked_search,
        "op12_token_alignment": op12_token_alignment,
        "op13_piece_offsets": op13_piece_offsets,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
