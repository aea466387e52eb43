"""Document fingerprints: threshold-scaled sketches that keep every shingle hash below a fixed fraction of all hashes.

Sketches of unequal documents are merged and compared without regard to their lengths: what is below the threshold is whole in both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agorakit.llm.common import text_of
from agorakit.session import cut

WORDS = 5
#: One in SCALE shingles is kept: the threshold decides for all documents of some dozens of words. Only below LEAST hashes, in texts of about
#: LEAST * SCALE words and fewer, the smallest hashes come in beside those below the threshold, so that short documents have sketches too.
SCALE = 4
LEAST = 8
#: Stands for a null id while documents are in order.
NO_ID = -(1 << 63)


def _limit(scale: int) -> int:
    """The first signed hash that is too large: hashes run from -2^63."""
    return -(1 << 63) + (1 << 64) // scale


def sketch(text: Column, words: int = WORDS, scale: int = SCALE, least: int = LEAST) -> Column:
    """The sketch of a text: an ascending array of different hashes. Empty without a word.

    Words are lower-cased and parted by ASCII white space; a shingle is `words` words in a row, or all of a shorter text. All hashes
    below the threshold are kept, and the `least` smallest in any case.
    """
    tokens = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        n = F.size(h)
        each = F.transform(F.sequence(F.lit(0), n - F.lit(words)), lambda i: F.xxhash64(*[F.get(h, i + F.lit(k)) for k in range(words)]))
        return F.when(n >= words, each).when(n > 0, F.array(F.xxhash64(F.array_join(h.cast("array<string>"), " ")))).otherwise(F.array().cast("array<bigint>"))

    def kept(all_hashes: Column) -> Column:
        below = F.sort_array(F.array_distinct(F.filter(all_hashes, lambda x: x < F.lit(_limit(scale)))))
        return F.transform(F.array(below), lambda b: F.when(F.size(b) >= least, b).otherwise(F.slice(F.sort_array(F.array_distinct(all_hashes)), 1, least)))

    # Arrays of one element, so that each step is computed once.
    return F.flatten(F.flatten(F.transform(F.transform(F.array(hashes), shingles), kept)))


def merge(one: Column, other: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """The sketch of two documents together, from their sketches alone."""
    both = F.sort_array(F.array_union(one, other))
    below = F.filter(both, lambda x: x < F.lit(_limit(scale)))
    return F.when(F.size(below) >= least, below).otherwise(F.slice(both, 1, least))


def _reach(s: Column, scale: int, least: int) -> Column:
    """Up to which hash a sketch is whole: everything if it is not full, else the threshold or its last hash."""
    return F.when(F.size(s) < least, F.lit((1 << 63) - 1)).otherwise(F.greatest(F.array_max(s), F.lit(_limit(scale) - 1)))


def _compared(one: Column, other: Column, scale: int, least: int, result: Callable[[Column, Column, Column], Column]) -> Column:
    """A result from how many hashes up to the lesser reach are in the one, the other, and both."""
    reach = F.least(_reach(one, scale, least), _reach(other, scale, least))

    def counts(r: Column) -> Column:
        a, b, both = (F.size(F.filter(s, lambda x: x <= r)) for s in (one, other, F.array_intersect(one, other)))
        return F.struct(a.alias("a"), b.alias("b"), both.alias("both"))

    # Arrays of one element, so that the reach and the counts are computed once and not for each hash.
    return F.get(F.transform(F.transform(F.array(reach), counts), lambda c: result(c["a"], c["b"], c["both"])), F.lit(0))


def likeness(one: Column, other: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """Estimated share of common shingles among all of both, 0 to 1. Two texts without a word are alike, one without is like none with."""
    same = (F.size(one) == F.size(other)).cast("double")
    return _compared(one, other, scale, least, lambda a, b, both: F.when(a + b == 0, same).otherwise(both / (a + b - both)))


def containment(one: Column, other: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """Estimated share of the one's shingles that the other has; 1 if the one has none, null if none of its hashes is within reach of both."""
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(_compared(one, other, scale, least, lambda a, b, both: F.when(a > 0, both / a)))


def fingerprint(df: DataFrame, text: str = "text", out: str = "sketch", **options: int) -> DataFrame:
    """df with the sketch of each whole text. Null counts as empty, an empty text has an empty sketch. A row is computed by itself."""
    return df.withColumn(out, sketch(text_of(text), **options))


def as_text(s: Column) -> Column:
    """Fixed-width hex, in order."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def following(ids: DataFrame, key: list[str], size: str) -> DataFrame:
    """Each different row of ids with `_prev` (key, and n, the size) of its predecessor in ascending order of key; the first row's is the last row.

    Ranges of rows are looked at by themselves; what a range lacks is the last row of the range before it, one row a range.
    """
    ranged = cut(ids.distinct().repartitionByRange(*key).withColumn("_range", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("_range").orderBy(*key)
    row = F.struct(*key, F.col(size).alias("n"))
    ends = ranged.groupBy("_range").agg(F.max(row).alias("_end"))
    whole = Window.orderBy("_range")  # one row a range
    last = F.last("_end").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = ends.select("_range", F.coalesce(F.lag("_end").over(whole), last).alias("_before"))
    found = ranged.withColumn("_prev", F.lag(row).over(own)).join(before, "_range")
    return found.select(*key, F.coalesce("_prev", "_before").alias("_prev"))


def query(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text (the last quarter replaced by the next document's beginning).

    The order is that of doc_id, nulls first, then of the text's hash. Rows that repeat an id and a text count as one document, and each
    of them gets its results.
    """
    key = ["_id", "_hash"]
    # Both joins read the same columns, so that Spark shuffles the texts once.
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), text_of().alias("text")).withColumn("_hash", F.xxhash64("text"))
    order = following(rows.select(*key, F.char_length("text").alias("n")), key, "n")
    # What the document before needs of this one: the beginning and the sketch. Of repeated rows one is enough.
    once = F.row_number().over(Window.partitionBy(*key).orderBy("_id"))
    heads = rows.join(order, key).withColumn("_once", once).where("_once = 1").select(
        *[F.col(f"_prev.{k}").alias(k) for k in key], F.substring("text", F.lit(1), F.floor(F.col("_prev.n") / 4).cast("int")).alias("head"),
        sketch(F.col("text")).alias("next_sketch"),
    )
    n = F.char_length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("head"))
    both = fingerprint(rows.join(heads, key).withColumn("edited", edited))
    both = fingerprint(both, "edited", "edited_sketch")
    return both.select(
        F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"), likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
