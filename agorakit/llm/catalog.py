"""The registered queries of this folder and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agorakit.llm import alignment, bpe, exactdedup, fillmiddle, fingerprints, langid, linededup, mixing, pieces, secrets, sharding, simhash, tokenfiles
from agorakit.llm.common import documents

_MODULES = {
    "op1_sentencepiece": pieces,
    "op2_token_files": tokenfiles,
    "op3_sharding": sharding,
    "op4_secret_scan": secrets,
    "op5_exact_dedup": exactdedup,
    "op6_fingerprints": fingerprints,
    "op7_mixing": mixing,
    "op8_line_dedup": linededup,
    "op9_language_id": langid,
    "op10_simhash": simhash,
    "op11_alignment": alignment,
    "op12_bpe": bpe,
    "op13_fill_in_middle": fillmiddle,
}


def _bound(query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(module.query) for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE for name, module in _MODULES.items() if hasattr(module, "ORACLE")}
