"""SimHash near-dedup: a self-join of the binary trie of all fingerprints.

Two fingerprints with at most d differing bits agree fully in one of d + 1 blocks of bits. Each fingerprint is turned so that each
block comes first once, and the tries of equal first blocks are joined with themselves: node pairs go down together, differing bits add up,
and a pair is left as soon as they exceed the budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from agorakit.llm.arrow import with_columns_of_text
from agorakit.llm.common import fresh
from agorakit.llm.components import components
from agorakit.session import cut

WORDS = 3
SEED = 42
BITS = 64
BUDGET = 3
#: Fingerprints that a task joins at once, at least; a group above it is dealt again by its other bits.
CHUNK = 200_000


def fingerprint(text: str, words: int = WORDS) -> int:
    """The bits set in over half of the shingle hashes; 0 without a word. Unsigned."""
    found = text.encode().lower().split()  # bytes: A-Z and the six ASCII white spaces only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    last = ends[words - 1 :] - 1 if len(found) >= words else ends[-1:] - 1
    starts = np.concatenate(([0], ends[: len(last) - 1]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), last.tolist())], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        counts += np.unpackbits(hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", words: int = WORDS) -> DataFrame:
    """The columns `keep` and `fp`, the fingerprint as a bigint. Null texts count as empty."""

    def make():
        return lambda texts: [pa.array(np.array([fingerprint(x, words) for x in texts], np.uint64).view(np.int64))]

    return with_columns_of_text(df, text, make, [("fp", T.LongType())], keep)


class Forest:
    """Joins many tries at once. Keys are sorted by (trie, value); a node is a range of them that agrees down to some bit."""

    def __init__(self, trie: np.ndarray, value: np.ndarray, budget: int):
        self.value, self.budget = value, budget
        self.trie = trie

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs that link every two keys of a trie within the budget, at least by a path of such keys."""
        value, out = self.value, []
        starts = np.flatnonzero(np.r_[True, self.trie[1:] != self.trie[:-1]])
        ends = np.r_[starts[1:], len(value)]
        # Node pairs: ranges a and b, and the bits in which they differ so far. Roots are paired with themselves.
        stack = [(BITS - 1, starts, ends, starts, ends, np.zeros(len(starts), np.int8))]
        while stack:
            bit, a0, a1, b0, b1, off = stack.pop()
            same = a0 == b0
            live = ~(same & (a1 - a0 == 1))
            leaf = live & ~same & (a1 - a0 == 1) & (b1 - b0 == 1)
            if leaf.any():
                x, y = a0[leaf], b0[leaf]
                near = np.bitwise_count(value[x] ^ value[y]) <= self.budget
                out.append((x[near], y[near]))
            live &= ~leaf
            if bit < 0 or not live.any():
                continue
            a0, a1, b0, b1, off, same = (x[live] for x in (a0, a1, b0, b1, off, same))
            if len(a0) > 500_000:  # bounded memory: halves one after the other
                for half in (slice(None, len(a0) // 2), slice(len(a0) // 2, None)):
                    stack.append((bit, a0[half], a1[half], b0[half], b1[half], off[half]))
                continue
            am, bm = self._middle(a0, a1, bit), self._middle(b0, b1, bit)
            kids = []
            for x0, x1, y0, y1, add, mask in (
                (a0, am, b0, bm, 0, None), (am, a1, bm, b1, 0, None), (a0, am, bm, b1, 1, None), (am, a1, b0, bm, 1, ~same),
            ):
                ok = (x1 > x0) & (y1 > y0) & (off + add <= self.budget)
                if mask is not None:
                    ok &= mask
                kids.append((x0[ok], x1[ok], y0[ok], y1[ok], (off[ok] + add).astype(np.int8)))
            stack.append((bit - 1, *(np.concatenate(x) for x in zip(*kids))))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out))

    def _middle(self, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
        """Where in each range the keys with a 1 at this bit begin; keys of a range agree above it, so those are last."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high) // 2
            one = ((self.value[np.minimum(mid, len(self.value) - 1)] >> np.uint64(bit)) & np.uint64(1)).astype(bool)
            high = np.where(open_ & one, mid, high)
            low = np.where(open_ & ~one, mid + 1, low)


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least index that each of n indexes reaches by the links (x, y)."""
    root = np.arange(n)
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_ = low != high
        if not open_.any():
            break
        x, y, low, high = x[open_], y[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
    return root


def _local_links(budget: int):
    """From rows sorted by group and value to links (u, v) to the least fingerprint of each local component."""

    def join(group: np.ndarray, turned: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        trie = np.cumsum(np.r_[False, (group[1:] != group[:-1]).any(1)])
        order = np.lexsort((turned, trie))
        trie, turned, fp = trie[order], turned[order], fp[order]
        root = _roots(len(fp), *Forest(trie, turned, budget).links())
        moved = np.flatnonzero(root != np.arange(len(fp)))
        u, v = fp[moved], fp[root[moved]]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            group = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            held.append((group, batch.column(4).to_numpy().view(np.uint64), batch.column(5).to_numpy()))
            if sum(len(h[2]) for h in held) >= CHUNK:
                group, turned, fp = (np.concatenate(x) for x in zip(*held))
                # Whole groups only: the last one may go on in the next batch.
                end = len(fp) - int(np.argmax((group[::-1] != group[-1]).any(1))) if (group[0] != group[-1]).any() else 0
                held = [(group[end:], turned[end:], fp[end:])]
                if end:
                    yield join(group[:end], turned[:end], fp[:end])
        if held and sum(len(h[2]) for h in held):
            yield join(*(np.concatenate(x) for x in zip(*held)))

    return run


def _turned(df: DataFrame, blocks: int, budget: int) -> DataFrame:
    """Each fingerprint once for each block that may agree: block number, the block's bits, and all bits turned to begin with it."""
    width = BITS // blocks
    value = F.shiftleft("fp", 0)
    turns = []
    for k in range(blocks):
        left = width * k
        whole = value if not left else F.shiftleft(value, left).bitwiseOR(F.shiftrightunsigned(value, BITS - left))
        turns.append(F.struct(F.lit(k).cast("int").alias("block"), whole.alias("turned")))
    each = df.select("fp", F.explode(F.array(*turns)).alias("t")).select("fp", "t.block", "t.turned")
    return each.withColumn("head", F.shiftrightunsigned("turned", BITS - width))


def near_links(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (u, v) between different fingerprints that connect what the trie join connects: any two within the budget.

    Groups that agree in a block and are larger than CHUNK are dealt once more by equal parts of their other bits; one of budget + 1 parts
    must agree again. So a group that stays large holds near copies only.
    """
    blocks = budget + 1
    turned = _turned(distinct, blocks, budget)
    large = turned.groupBy("block", "head").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK).select("block", "head", F.lit(True).alias("large"))
    rest = BITS - BITS // blocks
    part = rest // blocks
    parts = [F.struct(F.lit(j).cast("int").alias("j"), F.shiftright("turned", rest - part * (j + 1)).bitwiseAND(F.lit((1 << part) - 1).cast("long")).alias("bits")) for j in range(blocks)]
    marked = turned.join(large, ["block", "head"], "left")
    whole = F.array(F.struct(F.lit(-1).cast("int").alias("j"), F.lit(0).cast("long").alias("bits")))
    dealt = marked.withColumn("p", F.explode(F.when(F.col("large"), F.array(*parts)).otherwise(whole)))
    rows = dealt.select(F.col("block").cast("long").alias("block"), "head", F.col("p.j").cast("long").alias("j"), F.col("p.bits").alias("bits"), "turned", "fp")
    keys = ["block", "head", "j", "bits"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_local_links(budget), "u bigint, v bigint")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """(id_col, fp, component_id) for each row: the least id over all rows whose fingerprints are reached by links of at most
    `budget` differing bits.

    Null texts count as empty; texts without a word have fingerprint 0, which links like any other. Rows with equal
    texts or equal fingerprints are in one component; components of rows whose ids are all null have a null
    component_id. Only distinct fingerprints are joined, and of their links only those to the least member of
    each local component leave a task. Repeated ids and rows stay as they are; an empty table stays empty.
    """
    rows = cut(fingerprints(df, [id_col], text, words), "simhash")
    distinct = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = components(near_links(distinct.select("fp"), budget)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(names, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(id_col, "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay when one document of each component does, with all columns: the one with the least id.

    Rows that repeat an id and a text count as one row and the first of them stays. A row without an id stays only if
    its component has no id, and then the row with the least hash of all columns.
    """
    key, least, turn = fresh(docs, "_key", "_least", "_turn")
    plain = [F.col(c).cast("string") for c in docs.columns]
    # The order of rows: ids first, nulls last, then a hash of all columns. Equal rows are one.
    keyed = docs.withColumn(key, F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.xxhash64(*plain).alias("h")))
    found = simhash_components(keyed, key, text)
    stay = found.where(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(f"{key}.h").alias(least)).distinct()
    kept = docs.withColumn(least, F.xxhash64(*plain)).join(stay, least, "left_semi")
    once = Window.partitionBy(least).orderBy(F.col(id_col))
    return kept.withColumn(turn, F.row_number().over(once)).where(F.col(turn) == 1).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    found = simhash_components(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
