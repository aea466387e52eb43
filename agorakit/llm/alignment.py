"""Cross-tokenizer alignment by lockstep merging: one state vector has the place of every document in its two rows of tokens.

Each step looks at one token of A and one of B in every document at once, emits that link, emits a cut where both end, and goes on
with the one that ends first. Finished documents leave the vector. Long documents are several lanes of it, parted at cuts.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from agorakit.llm.arrow import Recent
from agorakit.llm.common import fresh
from agorakit.llm.flat import flat_bytes, parts, sums_before
from agorakit.llm.pieces import SPACE
from agorakit.session import cut

#: Tokens of A after which a lane ends at the next cut.
LANE = 512
KNOWN, KNOWN_LENGTH, TOGETHER = 300_000, 48, 500
#: Bytes of text that are worked on at once, if the texts are not longer.
MOST_BYTES = 2 << 20
#: A space beside white space or at an end of the text. Where there is none, both tokenizers begin a token at each space and at no other place
#: look beyond it, so words between spaces can be encoded one by one.
IRREGULAR = re.compile(rf"^\s|\s\Z|\s | \s|{SPACE}")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of byte-level tokens: visible bytes are themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Two tokenizers that keep all bytes: a byte-level BPE file (A) and a SentencePiece BPE model (B)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as file:
            described = json.load(file)
        before = described["pre_tokenizer"] or {}
        if before.get("type") != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"] or described["normalizer"]:
            raise ValueError(f"{a_path} is not a byte-level file")
        self.library = Tokenizer.from_file(a_path)
        self.library.encode_special_tokens = True
        self.other = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.words = Recent(KNOWN)
        alphabet, vocab = byte_alphabet(), described["model"]["vocab"]
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = bytes(alphabet[c] for c in token)
        pieces = [self.other.id_to_piece(i) for i in range(self.other.get_piece_size())]
        b_bytes = [
            bytes([int(x[3:5], 16)]) if self.other.is_byte(i) else b"" if self.other.is_control(i) or self.other.is_unknown(i) else x.replace(SPACE, " ").encode()
            for i, x in enumerate(pieces)
        ]
        #: Whether no piece goes on with a space after other characters.
        self.cuts = not any(SPACE in x.lstrip(SPACE) for x in pieces)
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary())
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (a_bytes, b_bytes))
        # Ids as text with what follows them: "," or "|" after A, "," or ";" or nothing after B.
        self.shown = pa.array([f"{i}{e}" for i in range(len(a_bytes)) for e in ",|"] + [f"{i}{e}" for i in range(len(b_bytes)) for e in (",", ";", "")])

    def learn_words(self, words: list[str]) -> None:
        """Ids of A and of B for each word, as bytes. A encodes many words in a row, as a token begins at each space."""
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            a = np.array(self.library.encode(" " + " ".join(some), add_special_tokens=False).ids, np.int32)
            ends = np.cumsum([len(w.encode()) + 1 for w in some])
            cuts = np.append(0, np.searchsorted(np.cumsum(self.a_size[a]), ends) + 1).tolist()
            for word, first, last, b in zip(some, cuts, cuts[1:], self.other.encode(some, num_threads=1)):
                self.words.known[word] = a[first:last].tobytes(), array("i", b).tobytes()

    def ids(self, text: str, words: list[str] | None) -> tuple[np.ndarray, np.ndarray]:
        if words:
            a, b = (b"".join(x) for x in zip(*map(self.words.known.__getitem__, words)))
            return np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)
        if not text:
            return np.empty(0, np.int32), np.empty(0, np.int32)
        return np.array(self.library.encode(" " + text, add_special_tokens=False).ids, np.int32), np.array(self.other.encode(text), np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and their cuts by text, and the same of B. Texts whose tokens do not join to a space and the text have none."""
        data, cuts = flat_bytes(texts)
        as_text = [x or "" for x in texts.to_pylist()]
        split = [x.split(" ") if x and self.cuts and not IRREGULAR.search(x) else None for x in as_text]
        new = list(self.words.missing(set().union(*filter(None, split))))
        self.learn_words(new)
        a, b = map(list, zip(*map(self.ids, as_text, split)))
        for word in new:
            if len(word) > KNOWN_LENGTH:
                del self.words.known[word]
        for k, (x, y) in enumerate(zip(a, b)):
            whole = b" " + data[cuts[k] : cuts[k + 1]].tobytes() if as_text[k] else b""
            if joined(self.a_bytes, x) != whole or joined(self.b_bytes, y) != whole:
                a[k] = b[k] = np.empty(0, np.int32)
        return np.concatenate(a), sums_before(np.array([len(x) for x in a])), np.concatenate(b), sums_before(np.array([len(x) for x in b]))


def joined(table: pa.Array, ids: np.ndarray) -> bytes:
    found = table.take(pa.array(ids))
    return found.buffers()[2].to_pybytes() if len(ids) else b""


@lru_cache(maxsize=1)
def pair(a_path: str, b_path: str) -> Pair:
    gc.disable()  # a worker keeps many words and makes no cycles: looking through the words again and again costs more than to encode them
    return Pair(a_path, b_path)


def lanes(a_end: np.ndarray, b_end: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, length: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First tokens of A and of B in each lane, and where A ends in it: documents, and long ones parted near every `length`-th token."""
    n = np.diff(a_cuts)
    more = np.maximum((n - 1) // length, 0)
    at = np.repeat(a_cuts[:-1], more) + length * (np.arange(more.sum()) - np.repeat(sums_before(more)[:-1], more) + 1) - 1
    stop = np.repeat(a_cuts[1:], more) - 1
    open_, found = np.arange(len(at)), []
    while len(open_):  # the first token of A from here on with whose end one of B ends
        k = at[open_]
        j = np.searchsorted(b_end, a_end[k])
        cuts = b_end[j] == a_end[k]
        found.append(np.stack([k[cuts], j[cuts]], 1)[k[cuts] < stop[open_[cuts]]])
        open_ = open_[~cuts]
        at[open_] += 1
    whole = n > 0
    inner = np.unique(np.concatenate([*found, np.empty((0, 2), np.int64)]), axis=0) + 1
    starts = np.concatenate([np.stack([a_cuts[:-1][whole], b_cuts[:-1][whole]], 1), inner])
    starts = starts[np.argsort(starts[:, 0], kind="stable")]
    return starts[:, 0], starts[:, 1], np.append(starts[1:, 0], a_cuts[-1])[: len(starts)]


@dataclass
class Aligned:
    """Links as places of tokens in the flat rows of A and B, and whether a group ends with a token."""

    a_link: np.ndarray
    b_link: np.ndarray
    a_last: np.ndarray
    b_last: np.ndarray


def lockstep(a_size: np.ndarray, a_cuts: np.ndarray, b_size: np.ndarray, b_cuts: np.ndarray, length: int = LANE) -> Aligned:
    """Links and cuts of documents whose tokens of A and of B have these sizes in bytes, the same sum in each document."""
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    i, j, stop = lanes(a_end, b_end, a_cuts, b_cuts, length)
    a_last, b_last = np.zeros(len(a_size), bool), np.zeros(len(b_size), bool)
    a_links, b_links = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(i):
        a_links.append(i)
        b_links.append(j)
        a, b = a_end[i], b_end[j]
        both = a == b
        a_last[i[both]] = True
        b_last[j[both]] = True
        i, j = i + (a <= b), j + (b <= a)
        goes_on = i < stop
        if not goes_on.all():
            i, j, stop = i[goes_on], j[goes_on], stop[goes_on]
    return Aligned(np.concatenate(a_links), np.concatenate(b_links), a_last, b_last)


def group_texts(tool: Pair, a: np.ndarray, a_cuts: np.ndarray, b: np.ndarray, b_cuts: np.ndarray, found: Aligned) -> pa.Array:
    """`a1,a2|b1;a3|b2,b3` of each document: the ids of the groups in order. Empty without tokens."""
    a_start, b_start = (np.append(0, np.flatnonzero(last) + 1) for last in (found.a_last, found.b_last))
    a_group, b_group = (np.cumsum(last) - last for last in (found.a_last, found.b_last))
    shown = np.empty(len(a) + len(b), np.int64)
    shown[np.arange(len(a)) + b_start[a_group]] = 2 * a.astype(np.int64) + found.a_last
    end = found.b_last.astype(np.int64)
    end[b_cuts[1:][np.diff(b_cuts) > 0] - 1] = 2
    shown[np.arange(len(b)) + a_start[b_group + 1]] = 2 * len(tool.a_size) + 3 * b.astype(np.int64) + end
    return pc.binary_join(pa.ListArray.from_arrays(pa.array((a_cuts + b_cuts).astype(np.int32)), tool.shown.take(pa.array(shown))), "")


def lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, kind))


def by_document(found: Aligned, a_cuts: np.ndarray) -> np.ndarray:
    """The document of each link."""
    return np.searchsorted(a_cuts, found.a_link, "right") - 1


LINKS = "array<struct<a:int,b:int>>"
ALIGNED = [("a_ids", "array<int>"), ("b_ids", "array<int>"), ("a_cuts", "array<int>"), ("b_cuts", "array<int>"), ("links", LINKS), ("groups", "string")]


def align(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """df with a_ids and b_ids, how many of each there are up to each common end (a_cuts, b_cuts), links (places of tokens whose bytes overlap) and groups.

    A encodes a space and the text, B the text, in front of which it puts a space; strings of special tokens are plain text. Null and empty
    texts, and texts that one of the two does not keep byte by byte, have no tokens and empty lists. Texts are never cut short; a row is
    computed by itself, so repeated rows, other columns and empty tables need nothing. Columns with the names of the new
    ones are replaced. Both paths must open on every executor.
    """
    new = [n for n, _ in ALIGNED]
    keep = [c for c in df.columns if c.lower() not in new]
    (body,) = fresh(df, "_body")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, T.DataType.fromDDL(t)) for n, t in ALIGNED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = pair(a_path, b_path)
        for whole in batches:
            for batch in parts(whole, len(keep), MOST_BYTES):
                a, a_cuts, b, b_cuts = tool.encode(batch.column(len(keep)))
                found = lockstep(tool.a_size[a], a_cuts, tool.b_size[b], b_cuts)
                order = np.lexsort((found.b_link, found.a_link))
                i, j = found.a_link[order], found.b_link[order]
                doc = np.searchsorted(a_cuts, i, "right") - 1
                links = pa.StructArray.from_arrays([pa.array((x - cuts[doc]).astype(np.int32)) for x, cuts in ((i, a_cuts), (j, b_cuts))], ["a", "b"])
                ends = []
                for last, cuts in ((found.a_last, a_cuts), (found.b_last, b_cuts)):
                    at = np.flatnonzero(last)
                    of = np.searchsorted(cuts, at, "right") - 1
                    ends.append(lists((at - cuts[of] + 1).astype(np.int32), np.searchsorted(at, cuts), pa.int32()))
                columns = [
                    lists(a, a_cuts, pa.int32()), lists(b, b_cuts, pa.int32()), *ends,
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)), links),
                    group_texts(tool, a, a_cuts, b, b_cuts, found),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], [*keep, *new])

    return df.select(*keep, F.col(text).cast("string").alias(body)).mapInArrow(run, schema)


STATISTICS = [("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"), ("n_links", "bigint"), ("groups", "string")]
HELD = [("_part", "bigint"), ("_at", "array<int>"), ("_times", "array<int>"), ("_pairs", "array<bigint>"), ("_docs", "array<int>")]


def _linked(df: DataFrame, keep: list[str], held: list[str], a_path: str, b_path: str, text: str) -> DataFrame:
    """Counts and groups of each document, and its different id pairs as places in the list of its part, with how often each is linked.

    The last document of a part has the list: all pairs of the part, and in how many of its documents each is.
    """
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, T.DataType.fromDDL(t)) for n, t in STATISTICS + [(h, t) for h, (_, t) in zip(held, HELD)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number = pair(a_path, b_path), TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in parts(whole, len(keep), MOST_BYTES):
                n = batch.num_rows
                a, a_cuts, b, b_cuts = tool.encode(batch.column(len(keep)))
                found = lockstep(tool.a_size[a], a_cuts, tool.b_size[b], b_cuts)
                doc = by_document(found, a_cuts)
                pairs, place = np.unique(a[found.a_link].astype(np.int64) << 32 | b[found.b_link], return_inverse=True)
                each, times = np.unique(doc * max(len(pairs), 1) + place, return_counts=True)
                of, at = np.divmod(each, max(len(pairs), 1))
                by_doc, last = np.searchsorted(of, np.arange(n + 1)), np.append(np.zeros(n, np.int64), len(pairs))
                columns = [
                    pa.array(np.diff(a_cuts)), pa.array(np.diff(b_cuts)), pa.array(np.diff(sums_before(found.a_last)[a_cuts])),
                    pa.array(np.bincount(doc, minlength=n)), group_texts(tool, a, a_cuts, b, b_cuts, found), pa.array(np.full(n, number)),
                    lists(at.astype(np.int32), by_doc, pa.int32()), lists(times.astype(np.int32), by_doc, pa.int32()),
                    lists(pairs, last, pa.int64()), lists(np.bincount(at, minlength=len(pairs)).astype(np.int32), last, pa.int32()),
                ]
                number += 1
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], schema.names)

    (body,) = fresh(df, "_body")
    return df.select(*keep, F.col(text).cast("string").alias(body)).mapInArrow(run, schema)


def link_statistics(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """df without its text, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document.

    The count of a pair of ids is in how many documents it is linked; repeated rows are documents of their own. n_best has the links
    whose count is the highest of all pairs with their id of A, count_sum the sum over all links. What has no tokens, see
    align, has zeros and an empty digest.

    Counts go through one row for each different pair of a part (some MB of text), not of a document, and come back
    the same way: each part is joined with the counts of its own pairs. A pair that stands everywhere has a row a part, and the pairs of one
    id of A are as many as B has ids at most, so no task depends on how often a pair occurs.
    """
    public = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum", "groups_sha256"]
    keep = [c for c in df.columns if c != text and c.lower() not in public]
    part, at, times, pairs, docs = fresh(df, *[h for h, _ in HELD])
    linked = _linked(df, keep, [part, at, times, pairs, docs], a_path, b_path, text)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    stored = cut(linked.select(*keep, "n_a", "n_b", "n_groups", "n_links", digest, part, at, times, pairs, docs), "aligned")
    each = stored.where(F.size(pairs) > 0).select(F.col(part).alias("part"), F.posexplode(F.arrays_zip(F.col(pairs).alias("pair"), F.col(docs).alias("docs"))).alias("at", "x"))
    each = each.select("part", "at", "x.pair", "x.docs")
    counts = each.groupBy("pair").agg(F.sum("docs").alias("n"))
    best = F.col("n") == F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    worth = counts.select("pair", (F.col("n") * 2 + best.cast("bigint")).alias("worth"))
    back = each.drop("docs").join(worth, "pair").select("part", "at", "worth")

    own = stored.drop(pairs, docs)
    schema = T.StructType([own.schema[c] for c in [*keep, "n_a", "n_b", "n_groups", "n_links"]] + [T.StructField(n, T.LongType()) for n in ("n_best", "count_sum")] + [own.schema["groups_sha256"]])
    names = schema.names

    def weigh(documents: pa.Table, found: pa.Table) -> pa.Table:
        worth = np.zeros(found.num_rows, np.int64)
        worth[found.column("at").to_numpy()] = found.column("worth").to_numpy()
        places, often = (documents.column(c).combine_chunks() for c in (at, times))
        value, often_flat = worth[places.flatten().to_numpy()], often.flatten().to_numpy().astype(np.int64)
        cuts = sums_before(pc.list_value_length(places).to_numpy())
        sums = [np.diff(sums_before(x)[cuts]) for x in (often_flat * (value & 1), often_flat * (value >> 1))]
        columns = {c: documents.column(c) for c in documents.column_names} | dict(zip(("n_best", "count_sum"), map(pa.array, sums)))
        return pa.table({c: columns[c] for c in names})

    return own.groupBy(part).cogroup(back.groupBy("part")).applyInArrow(weigh, schema)


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return link_statistics(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
