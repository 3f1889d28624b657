"""The registered queries of this package: thin calls of its operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import os
import uuid

import public_tokenizers

from clickstream.llm import (
    hard_negatives, language_id, lexical_search, quality_classifier, quality_rules, secret_scan, token_files, toxicity, url_filter,
)
from clickstream.llm.common import held_out, prepare, read
from clickstream.llm.decontam import contamination
from clickstream.llm.line_dedup import build_state, clean
from clickstream.llm.sentencepiece_viterbi import decode_column, encode_column
from clickstream.llm.simhash import near_duplicates
from clickstream.session import scratch_path

#: Folder of the public tokenizer files (the same on every machine).
TOKENIZER_DIR = os.path.dirname(public_tokenizers.path("piece_bpe_32k.model"))


def tokenizer_file(name: str, folder: str | None = None) -> str:
    return os.path.join(folder or TOKENIZER_DIR, name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from the others' languages outside the held-out fold."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, usable=~held_out(F.col("doc_id")))
    guessed = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                          language_id.predict(F.col("text"), model).alias("guess"))
    return guessed.select("doc_id", "held_out", "guess.lang_pred", "guess.score")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: base patterns, and random-looking tokens at a false-discovery rate of 1 %."""
    prepare(spark)
    found = secret_scan.scan(read(spark, sf_dir, "documents").select("doc_id", "text"), fdr=0.01)
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.written(F.col("found")).alias("spans"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-word windows of ``benchmark`` items inside all documents."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, read(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"), "leak.contaminated")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 4-word shingles, up to 4 differing bits."""
    prepare(spark)
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, radius=4)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40+ code points found in 5+ documents, cut everywhere but in the largest doc_id."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    cut = clean(build_state(docs, min_chars=40, min_docs=5), docs)
    return cut.select("doc_id", "lines.n_lines", "lines.n_dropped", "lines.kept_sha256")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with the 32k piece model and decoded again."""
    prepare(spark)
    path = tokenizer_file("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ids = docs.select("doc_id", "text", encode_column(F.col("text"), path).alias("ids"))
    back = ids.select("doc_id", "text", "ids", decode_column(F.col("ids"), path).alias("back"))
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.crc32(F.array_join("ids", ",").cast("binary")).alias("ids_crc32"),
        (F.coalesce("text", F.lit("")) == F.col("back")).alias("round_trip"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token-id files in doc_id order, and read back from them."""
    prepare(spark)
    path = scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    token_files.write_token_files(read(spark, sf_dir, "documents").select("doc_id", "text"), path,
                                  tokenizer_file("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2)
    return token_files.read_token_files(spark, path)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of all documents against the languages' histograms."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside the held-out fold."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), usable=~held_out(F.col("doc_id")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         toxicity.toxicity_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; the site is that of the document's page, or else its source."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    paged = quality_classifier.page_sites(read(spark, sf_dir, "pages"))
    rest = (docs.select("doc_id", F.col("source").alias("host"), F.lit(None).cast("string").alias("path"))
            .join(paged, "doc_id", "left_anti"))
    got = quality_classifier.classify(docs, read(spark, sf_dir, "labels"), paged.unionByName(rest),
                                      usable=~held_out(F.col("doc_id")))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "host_rate", "path_rate", "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each 50th vector and its 5 best rows of its label: the 3 best rows of other labels between half and 95 % of that score."""
    prepare(spark)
    vectors = read(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95,
                               vector_col="embedding", scale=256.0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item by ranked terms."""
    prepare(spark)
    return lexical_search.search(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"), top=20)


#: The url rules of :func:`op13_url_filter`: host and path prefix, verdict.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page url: by rule, or by trust and distrust over the host links."""
    prepare(spark)
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    judged = url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


QUERIES = {f.__name__: f for f in (
    op1_language_id,
    op2_secret_scan,
    op3_benchmark_decontamination,
    op4_simhash_near_dedup,
    op5_line_dedup,
    op6_sentencepiece,
    op7_token_files,
    op8_quality_rules,
    op9_toxicity,
    op10_quality_classifier,
    op11_hard_negatives,
    op12_lexical_search,
    op13_url_filter,
)}
