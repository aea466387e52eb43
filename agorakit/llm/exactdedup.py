"""Exact dedup by progressive refinement: by length, then by the hash of a prefix, then by the hash of the full text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorakit.llm.common import fresh, text_of
from agorakit.session import cut

PREFIX = 256
#: Bits of one piece of Spark's bitmaps; a piece has 4 KiB.
PIECE_BITS = 32_768
#: Pieces of the filter of surviving groups: 1,024 pieces are 4 MiB whatever the input. A full filter only costs hashing.
PIECES = 1_024


def survivors(narrow: DataFrame, size: str, head: str) -> DataFrame:
    """(length, prefix hash) of groups with more than one row: lengths seen twice first, then prefixes seen twice.

    Rows are counted by both before anything is shuffled by length alone, so a copied text is one row in each step.
    """
    counted = narrow.groupBy(size, head).agg(F.count(F.lit(1)).alias("_n"))
    by_length = counted.groupBy(size).agg(F.sum("_n").alias("_all")).where("_all > 1").select(size)
    return counted.join(by_length, size, "left_semi").where("_n > 1").select(size, head)


def _place(key: Column, pieces: int) -> Column:
    return F.pmod(key, F.lit(pieces * PIECE_BITS))


def group_filter(groups: DataFrame, key: Column, pieces: int = PIECES) -> DataFrame:
    """Surviving groups as bitmap pieces of 4 KiB, at most `pieces` rows. Every group's bit is set; others may be."""
    at = _place(key, pieces)
    return groups.groupBy(F.floor(at / PIECE_BITS).cast("int").alias("_piece")).agg(F.bitmap_construct_agg((at % PIECE_BITS).cast("long")).alias("_bits"))


def _is_set(bits: Column, at: Column) -> Column:
    """Whether a bit of a bitmap piece is set; false without a piece."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor((at % PIECE_BITS) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX, pieces: int = PIECES) -> DataFrame:
    """Every row of docs without its text, with keep_id, group_size and kept.

    Of rows with equal texts (null counts as empty) the one with the largest id stays; null ids come last. If that id is
    repeated in its group, all rows with it have kept = true. The first pass reads lengths and prefix hashes and counts
    them; the second hashes full texts only of rows whose group may have survived, beside the scan, so texts are never
    shuffled. Rows of groups that did not survive are alone by length and prefix. Groups of any size are counted with
    partial sums and joined back by key. An empty table stays empty; columns named keep_id, group_size or kept are replaced.
    """
    kept = [c for c in docs.columns if c != text_col and c.lower() not in ("keep_id", "group_size", "kept")]
    size, head, full, piece, held = fresh(docs, "_size", "_head", "_full", "_piece", "_bits")
    text = text_of(text_col)
    keys = {size: F.octet_length(text), head: F.xxhash64(F.substring(text, 1, prefix))}
    groups = survivors(docs.select(*[k.alias(c) for c, k in keys.items()]), size, head)
    key = F.xxhash64(F.col(size), F.col(head))
    bits = cut(group_filter(groups, key, pieces), "surviving-groups").toDF(piece, held)

    keyed = docs.withColumns(keys)
    at = _place(key, pieces)
    # The filter has at most `pieces` rows of 4 KiB, whatever the input.
    found = keyed.join(F.broadcast(bits), F.floor(at / PIECE_BITS).cast("int") == F.col(piece), "left")
    hashed = found.select(*kept, size, head, F.when(_is_set(F.col(held), at), F.sha2(text, 256)).otherwise(F.lit("")).alias(full))
    rows = cut(hashed, "refined")
    best = rows.groupBy(size, head, full).agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(best, [size, head, full]).select(*kept, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"))


def query(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", F.sha2(text_of(), 256).alias("text_sha256"))
    return exact_dedup(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
