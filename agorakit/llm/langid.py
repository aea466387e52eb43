"""Language ID by prediction by partial matching: the language whose frozen byte contexts give a text the shortest code."""

from __future__ import annotations

import hashlib
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from agorakit.llm.arrow import ROWS, tool_of_worker, with_columns_of_text
from agorakit.llm.common import fresh, text_of
from agorakit.session import cut

ORDER = 4
#: Different labelled texts of a language that are learned at most: those with the least hash.
SAMPLE = 300
PARTS = 64
KNOWN = 200_000
UNKNOWN = "und"
#: Bits a byte of letters above which a text is in none of the learned languages: more than equal bytes and an escape cost.
REJECT_BITS = 10.0
LETTERS = re.compile(r"[^\W\d_]+")
FIELDS = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("bits", T.DoubleType()), ("n_bytes", T.LongType())]

Tree = dict[str, tuple[dict[bytes, int], dict[bytes, tuple[int, int]]]]


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; none if the text has no letter."""
    words = LETTERS.findall(text.lower())
    if any(map(str.isalpha, words)) or any(c.isalpha() for w in words for c in w):
        return words
    return []


def context_tree(counts: dict[str, dict[str, int]], order: int = ORDER) -> Tree:
    """For each language how often a byte followed a context of up to `order` bytes, and each context's total and distinct followers.

    Contexts begin with the space before a word and never reach back over it, so the code length of a text is the sum over its words.
    """
    tree: Tree = {}
    for lang in sorted(counts):
        grams: dict[bytes, int] = defaultdict(int)
        for word, n in counts[lang].items():
            line = b" " + word.encode() + b" "
            for i in range(1, len(line)):
                for k in range(min(order, i) + 1):
                    grams[line[i - k : i + 1]] += n
        after: dict[bytes, tuple[int, int]] = {}
        for gram, n in grams.items():
            total, kinds = after.get(gram[:-1], (0, 0))
            after[gram[:-1]] = total + n, kinds + 1
        tree[lang] = dict(grams), after
    return tree


class Scorer:
    """Code lengths in bits under each language of a context tree."""

    def __init__(self, tree: Tree, order: int = ORDER):
        self.order, self.langs, self.models = order, list(tree), list(tree.values())
        self.place: dict[str, int] = {}
        self.costs = np.zeros((1024, len(self.langs) + 1))
        self.bits: dict[bytes, tuple[float, ...]] = {}

    def _bits(self, gram: bytes) -> tuple[float, ...]:
        """Code length of the last byte of gram after the others: escape to shorter contexts (method C), at last to 256 equal bytes."""
        out = []
        for grams, after in self.models:
            bits, at = 0.0, 0
            while at < len(gram):
                known = after.get(gram[at:-1])
                if known:
                    total, kinds = known
                    seen = grams.get(gram[at:])
                    if seen:
                        bits -= log2(seen / (total + kinds))
                        break
                    bits -= log2(kinds / (total + kinds))
                at += 1
            else:
                bits += 8.0
            out.append(bits)
        return tuple(out)

    def word(self, word: str) -> list[float]:
        line, order = b" " + word.encode() + b" ", self.order
        rows = []
        if len(self.bits) > KNOWN:
            self.bits.clear()
        for i in range(1, len(line)):
            gram = line[max(0, i - order) : i + 1]
            row = self.bits.get(gram)
            if row is None:
                row = self.bits[gram] = self._bits(gram)
            rows.append(row)
        return [sum(x) for x in zip(*rows)] + [float(len(line) - 1)]

    def score(self, text: str) -> tuple[str, float, float, int]:
        """Language, its share of the probability over all languages, code length in bits, and bytes coded. Ties: the first name."""
        words = words_of(text)
        if not words or not self.langs:
            return UNKNOWN, 0.0, 0.0, 0
        if len(self.place) > KNOWN:
            self.place.clear()
        for w in set(words).difference(self.place):
            at = len(self.place)
            if at >= len(self.costs):
                self.costs = np.concatenate([self.costs, np.zeros_like(self.costs)])
            self.costs[at] = self.word(w)
            self.place[w] = at
        total = np.zeros(len(self.langs) + 1)
        rest = iter(words)
        while part := list(islice(rest, 100_000)):
            total += self.costs[np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))].sum(0)
        bits = total[:-1]
        best = int(np.argmin(bits))
        share = 1.0 / float(np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())
        return self.langs[best], min(1.0, share), float(bits[best]), int(total[-1])


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE, order: int = ORDER) -> Tree:
    """The context tree of labelled rows. Null languages are left out; copies of a text count once.

    At most `sample` texts a language are read, those with the least hash. Finding them takes a number for each row and a bounded
    top-k; only the sample's texts are split. Its word counts come to the driver; they are bounded by the sample.
    """
    order_by, limit = fresh(labelled, "_order", "_limit")
    known = labelled.where(F.col(lang).isNotNull()).withColumn(order_by, F.xxhash64(text_of(text)))
    first = known.select(lang, order_by).distinct()
    # The least of each of PARTS parts of a language, then the least of those: no task sees a whole language.
    part = F.pmod(F.xxhash64(order_by), F.lit(PARTS))
    for group in ([lang, part], [lang]):
        first = first.withColumn(limit, F.row_number().over(Window.partitionBy(*group).orderBy(order_by))).where(F.col(limit) <= sample)
    limits = cut(first.groupBy(lang).agg(F.max(order_by).alias(limit)), "sample-limits")
    picked = known.join(limits, lang).where(F.col(order_by) <= F.col(limit)).dropDuplicates([lang, order_by])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                found: Counter = Counter()
                part = batch.slice(at, ROWS)
                for name, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found.update((name, w) for w in words_of(x or ""))
                names, words = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(words, pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    counts: dict[str, dict[str, int]] = defaultdict(dict)
    rows = picked.select(F.col(lang).cast("string"), text).mapInArrow(count, "lang string, word string, n bigint")
    for name, word, n in rows.groupBy("lang", "word").agg(F.sum("n")).collect():
        counts[name][word] = n
    return context_tree(counts, order)


def identify(df: DataFrame, tree: Tree, keep: list[str], text: str = "text", order: int = ORDER, names: list[str] | None = None) -> DataFrame:
    """The columns `keep` and lang_pred, score (0 to 1), bits and n_bytes, or other `names` for them, of each row's whole text.

    Null texts and texts without a letter are `und` with score 0, and so are all texts if nothing was learned. Nothing but the text
    takes part in a prediction; repeated rows get the same one, and an empty table stays empty. Columns with the names of the new ones are replaced.
    """
    fields = [(n, t) for n, (_, t) in zip(names or [n for n, _ in FIELDS], FIELDS)]
    keep = [c for c in keep if c.lower() not in {n.lower() for n, _ in fields}]
    key = hashlib.sha256(pickle.dumps(sorted((k, sorted(v[0].items())) for k, v in tree.items()))).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(tree)  # bounded by the sample

    def make():
        scorer = tool_of_worker(("langid", key, order), lambda: Scorer(shared.value, order))

        def compute(texts: list[str]) -> list[pa.Array]:
            langs, scores, bits, sizes = zip(*map(scorer.score, texts))
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64()), pa.array(sizes, pa.int64())]

        return compute

    return with_columns_of_text(df, text, make, fields, keep)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def in_language(docs: DataFrame) -> DataFrame:
    """The documents whose text is in a learned language: it has letters and a code of REJECT_BITS bits a byte at most."""
    names = fresh(docs, *[n for n, _ in FIELDS])
    predicted, _, bits, size = names
    found = identify(docs, learn(docs.where(~held_out())), docs.columns, names=names)
    return found.where((F.col(predicted) != UNKNOWN) & (F.col(bits) <= REJECT_BITS * F.col(size))).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    tree = learn(docs.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, tree, ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "bits", "n_bytes")
