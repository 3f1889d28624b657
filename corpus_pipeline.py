"""The corpus pipeline: documents in, cleaned documents encoded as SentencePiece ids out.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; each result is written as Parquet and
read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstream.llm import toxicity as tox
from clickstream.llm.common import fresh, held_out, prepare, read
from clickstream.llm.decontam import decontaminate
from clickstream.llm.line_dedup import build_state, clean
from clickstream.llm.queries import tokenizer_file
from clickstream.llm.sentencepiece_viterbi import encode_column
from clickstream.llm.simhash import keep_one
from clickstream.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.5 or more; learned from labels outside the held-out fold."""
    prepare(spark)
    model = tox.fit(docs, read(spark, sf_dir, "labels"), usable=~held_out(F.col("doc_id")))
    return tox.drop_toxic(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines of 40+ code points that 5+ documents hold, except in the largest doc_id; ``n_chars`` follows the text."""
    prepare(spark)
    cut = clean(build_state(docs, min_chars=40, min_docs=5), docs)
    lost = F.col("lines.n_dropped") > 0
    new = {"text": F.when(lost, F.col("lines.kept")).otherwise(F.col("text")),
           "n_chars": F.when(lost, F.char_length("lines.kept").cast("long")).otherwise(F.col("n_chars"))}
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash group (4-word shingles, up to 4 bits)."""
    prepare(spark)
    return keep_one(docs, shingle=4, radius=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a 10-word window of any benchmark item."""
    prepare(spark)
    return decontaminate(docs, read(spark, sf_dir, "benchmark"), window=10)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents and ``ids``: their texts as pieces of the 32k model."""
    prepare(spark)
    name = "ids" if "ids" not in {c.lower() for c in docs.columns} else fresh(docs, "ids")
    return docs.withColumn(name, encode_column(F.col("text"), tokenizer_file("piece_bpe_32k.model")))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Not expressible in SQL (a learned scorer, XXH64 fingerprints); tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a written table."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
