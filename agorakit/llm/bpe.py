"""BPE encoding and decoding by batched merge rounds on one flat array with the symbols of many words.

Each round finds the lowest-ranked pair of every word and joins it, for all words at once. Ranks of pairs come from a binary search over
the sorted keys of all pairs. Words without a pair that joins leave the array.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorakit.llm.arrow import Recent
from agorakit.llm.common import fresh
from agorakit.llm.flat import parts, sums_before
from agorakit.llm.words import Rows, by_runs, by_words, known_rules, of_strings

#: What a worker keeps, in words (twice: words and pieces) and runs, and the longest of them. At some 250 bytes each it is below 50 MB, as an executor has a worker a core.
KNOWN, KNOWN_RUNS, KNOWN_LENGTH = 40_000, 100_000, 48
#: Bytes of text that are encoded at once.
MOST_BYTES = 2 << 20
#: Words that are encoded together.
TOGETHER = 5_000
NONE = np.int64(1) << 62
#: White space within words.
OTHER_SPACE = re.compile(r"[^\S\n]")


class Merges:
    """The merge rules of a BPE model: sorted pair keys, and the rank and the joined symbol of each."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.width = max(vocab.values()) + 1
        left, right, joined = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in merges)))
        keys = left * self.width + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.joined = keys[order], order.astype(np.int64), joined
        last = np.full(self.width, -1, np.int64)
        np.maximum.at(last, joined, np.arange(len(merges)))
        #: No symbol comes from a rule after one that uses it: equal pairs of a word can then be joined in one round.
        self.ordered = bool((np.maximum(last[left], last[right]) < np.arange(len(merges))).all())

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def join(self, symbols: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after the last join, with their cuts. cuts has where each word begins, with the end as last."""
        words = len(cuts) - 1
        done_word, done_symbols, sizes = [], [], np.zeros(words, np.int64)
        word = np.repeat(np.arange(words), np.diff(cuts))
        rank = np.full(len(symbols), NONE)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            counts = np.diff(begins, append=len(word))
            best = np.minimum.reduceat(rank, begins)
            over = best == NONE
            if over.any():  # compact: finished words leave
                gone = np.repeat(over, counts)
                done_word.append(word[begins[over]])
                sizes[word[begins[over]]] = counts[over]
                done_symbols.append(symbols[gone])
                symbols, word, rank = symbols[~gone], word[~gone], rank[~gone]
                best, counts = best[~over], counts[~over]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, counts))
            if self.ordered:  # of pairs that share a symbol, as in aaa, every second one joins, from the left
                run = np.cumsum(np.diff(hit, prepend=-2) != 1)
                place = np.arange(len(hit)) - np.searchsorted(run, run)
                hit = hit[place % 2 == 0]
            else:
                hit = hit[np.diff(word[hit], prepend=-1) != 0]
            symbols[hit] = self.joined[rank[hit]]
            stays = np.ones(len(symbols), bool)
            stays[hit + 1] = False
            at = hit - np.arange(len(hit))  # where the joined symbols are after the others have gone
            symbols, word, rank = symbols[stays], word[stays], rank[stays]
            for k in (at, at[at > 0] - 1):
                ends = (k + 1 == len(word)) | (word[k] != word[np.minimum(k + 1, len(word) - 1)])
                rank[k] = np.where(ends, NONE, self.rank(symbols[k], symbols[np.minimum(k + 1, len(word) - 1)]))
        # Words come back in their order.
        if not done_word:
            return np.empty(0, np.int64), sums_before(sizes)
        order, found = np.concatenate(done_word), np.concatenate(done_symbols)
        from_cuts, out_cuts = sums_before(sizes[order]), sums_before(sizes)
        move = np.repeat(out_cuts[order] - from_cuts[:-1], sizes[order])
        out = np.empty(len(found), np.int64)
        out[np.arange(len(found)) + move] = found
        return out, out_cuts


class WordBpe:
    """Encodes and decodes as the library does with a file of this kind: BPE with word ends whose pre-tokenizer drops white space.

    Words of plain letters are split here, others by the file's own normalizer and pre-tokenizer; what follows is done here. Another kind of file raises an error.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, library = described["model"], Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges", "byte_fallback") if model.get(k)]
        added = described["added_tokens"]
        odd += [t["content"] for t in added if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]]
        if model["type"] != "BPE" or odd or described["decoder"] or [x for x, _ in self.split(f"{ascii_letters} \n\tb")] != [ascii_letters, "b"]:
            raise ValueError(f"{path} is not a plain BPE file with words: {odd}")
        self.vocab, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(self.vocab, merges)
        self.special = {t["content"]: t["id"] for t in added}
        self.marked = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        # Symbols of byte-level characters, in a word and at its end.
        byte_level = [c for c in self.vocab if len(c) == 1]
        self.inside, self.last = (np.zeros(max(map(ord, byte_level)) + 1, np.int64) for _ in "ab")
        for c in byte_level:
            self.inside[ord(c)], self.last[ord(c)] = self.vocab[c], self.vocab[c + self.end]
        self.words, self.pieces, self.runs = Recent(KNOWN), Recent(KNOWN), Recent(KNOWN_RUNS)
        self.by_runs = known_rules(described)
        #: The byte-level form of letters beyond ASCII in runs.
        self.letters = {n: self.split(chr(n))[0][0] for n in range(ord("ß"), ord("ÿ") + 1) if chr(n).isalpha()}

    def parted(self, words: list[str]) -> list[list[str | int]]:
        """The byte-level pieces of each word without a space or line end, and the ids of added tokens in it."""
        together = "\n".join(words)
        normal = self.normalize(together).split(" ")
        if len(normal) != len(words) or OTHER_SPACE.search(together) or self.marked.search(together):  # some word holds other white space or an added token
            return list(map(self.pieces_of, words))
        out = [[x] for x in normal]
        # A run of ASCII letters is a piece of its own.
        others = [k for k, x in enumerate(normal) if not (x.isascii() and x.isalpha())]
        rest = [normal[k] for k in others]
        begins = sums_before(np.array([len(x) + 1 for x in rest], np.int64))
        found = self.split(" ".join(rest))
        ends = np.searchsorted([at for _, (at, _) in found], begins).tolist()
        for k, a, b in zip(others, ends, ends[1:]):
            out[k] = [x for x, _ in found[a:b]]
        return out

    def pieces_of(self, word: str) -> list[str | int]:
        out, at = [], 0
        for m in self.marked.finditer(word):
            out += [x for x, _ in self.split(self.normalize(word[at : m.start()]))] + [self.special[m[0]]]
            at = m.end()
        return out + [x for x, _ in self.split(self.normalize(word[at:]))]

    def merged(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece by merge rounds over all pieces at once."""
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        cuts = sums_before(np.array([len(x) for x in pieces], np.int64))
        symbols = self.inside[codes]
        symbols[cuts[1:] - 1] = self.last[codes[cuts[1:] - 1]]
        joined, cuts = self.merges.join(symbols, cuts)
        flat, cuts = joined.astype(np.uint32).tobytes(), (4 * cuts).tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def merged_runs(self, runs: list[str]) -> Iterator[bytes]:
        for at in range(0, len(runs), TOGETHER):
            yield from self.merged([x if x.isascii() else x.translate(self.letters) for x in runs[at : at + TOGETHER]])

    def encode_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word, as unsigned 32-bit integers. Pieces are encoded once and kept, as words are."""
        for at in range(0, len(words), TOGETHER):
            parted = self.parted(words[at : at + TOGETHER])
            new = list(self.pieces.missing({x for word in parted for x in word if isinstance(x, str)}))
            known = self.pieces.known
            known.update(zip(new, self.merged(new)))
            for word in parted:
                yield known[word[0]] if len(word) == 1 and isinstance(word[0], str) else b"".join(known[x] if isinstance(x, str) else x.to_bytes(4, "little") for x in word)
            for piece in new:
                if len(piece) > KNOWN_LENGTH:
                    del known[piece]

    def _word_rows(self, words: pa.Array) -> Rows:
        return of_strings(words, self.words, self.encode_words, "<u4", KNOWN_LENGTH)

    def _run_rows(self, runs: pa.Array) -> Rows:
        return of_strings(runs, self.runs, self.merged_runs, "<u4", KNOWN_LENGTH)

    def encode_array(self, texts: pa.Array) -> Rows:
        """Ids of texts without nulls. Different words between spaces and line ends are encoded once, plain ones from their runs."""
        return by_words(texts, lambda x: by_runs(x, list(self.special), self._run_rows, self._word_rows) if self.by_runs else self._word_rows(x))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as unsigned 32-bit integers."""
        found = self.encode_array(pa.array(texts, pa.string()))
        flat, cuts = found.flat.tobytes(), (4 * sums_before(found.sizes)).tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordBpe:
    gc.disable()  # a worker keeps many words and makes no cycles: looking through the words again and again costs more than to encode them
    return WordBpe(path)


@lru_cache(maxsize=1)
def token_names(path: str) -> pa.Array:
    """The name of each id. Only files without a decoder are known here; another one raises an error."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    if described["decoder"]:
        raise ValueError(f"{path} has a decoder of its own")
    names = {i: t for t, i in described["model"]["vocab"].items()} | {t["id"]: t["content"] for t in described["added_tokens"]}
    return pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string())


def decode_lists(names: pa.Array, ids: pa.ListArray) -> pa.Array:
    """The texts of lists of ids: the names of all tokens, joined by spaces, as a file without a decoder has it."""
    cuts = sums_before(pc.list_value_length(ids).to_numpy()).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), names.take(ids.flatten())), " ")


def id_lists(found: Rows) -> pa.ListArray:
    """An Arrow list of the ids of each row."""
    return pa.ListArray.from_arrays(pa.array(sums_before(found.sizes).astype(np.int32)), pa.array(found.flat.astype(np.int32)))


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """df with `ids`, the token ids of each whole text by the file at `path`, which every executor can open.

    Strings of added tokens in a text become these tokens, no others are added. Null and empty texts have no ids. Texts are never cut
    short; a row is computed by itself, so repeated rows, other columns and empty tables need nothing. A column named ids is replaced.
    """
    keep = [c for c in df.columns if c.lower() != "ids"]
    (body,) = fresh(df, "_body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tokenizer(path)
        for whole in batches:
            for batch in parts(whole, len(keep), MOST_BYTES):
                ids = id_lists(tool.encode_array(pc.fill_null(batch.column(len(keep)), "")))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], ids], [*keep, "ids"])

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(*keep, F.col(text).cast("string").alias(body)).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the text that its ids stand for. Null counts as no ids; an id that the file lacks raises an error."""
    keep = [c for c in df.columns if c.lower() != out.lower()]
    (own,) = fresh(df, "_own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(path)
        for whole in batches:
            for batch in parts(whole, len(keep), MOST_BYTES):
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], decode_lists(names, batch.column(len(keep)))], [*keep, out])

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.StringType())])
    return df.select(*keep, F.coalesce(F.col(ids), F.array()).cast("array<int>").alias(own)).mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    """Digests of the ids of each text and of the text they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
