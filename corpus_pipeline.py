"""From raw documents to the token ids of a training mix. Each stage reads what its predecessor kept, as Parquet."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorakit.llm import langid, linededup, mixing, pieces, simhash
from agorakit.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
MODEL = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without a letter, or that no learned language shortens, go."""
    return langid.in_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on too many pages of a source of any size are taken out; all documents stay, also if no line is left.

    The rule is that of the registered query: pages count by what else is on them, so copies and near copies do not wipe their own lines.
    """
    found = linededup.line_dedup(docs)
    length = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", length).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the least doc_id."""
    return simhash.representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks, once at least."""
    return mixing.mix(docs).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each whole text, and digests of the ids and of the text they decode to."""
    return pieces.digests(pieces.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path(MODEL)), "doc_id", "source", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing to target weights", mixing_stage),
    ("SentencePiece encoding", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"corpus-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Trained models, fingerprints by XXH64 and tokenizers have no SQL form.
ORACLE_SQL = None
