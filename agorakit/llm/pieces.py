"""SentencePiece encoding and decoding with a table of each prefix's last token.

Merge-type encodings have this property: a row of tokens is the encoding of its text exactly if each adjacent pair is the
encoding of its own text. So each prefix of a text has one last token: of the pieces that end there, found by an
automaton over all pieces, the one that fits the last token of the prefix before it. The ids are read backwards from the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorakit.llm.arrow import Recent, tool_of_worker, with_columns_of_text

#: The character that stands for a space in pieces (fixed value).
SPACE = "▁"
#: Words, and pairs of tokens, that a worker keeps at most.
KNOWN, KNOWN_PAIRS = 300_000, 150_000
KNOWN_LENGTH = 48
NONE = float("-inf")
ID_COLUMNS = [("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())]


class PieceEncoder:
    """Encodes and decodes as the library does for BPE models with byte fallback, an identity normalizer and a space put in front."""

    def __init__(self, model: str):
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.text, self.score, self.ids = [], {}, {}
        self.byte: dict[int, int] = {}
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                self.ids[piece], self.score[piece] = i, library.get_score(i)
            self.text.append("" if library.is_control(i) or library.is_byte(i) else " ⁇ " if library.is_unknown(i) else piece.replace(SPACE, " "))
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.automaton = ahocorasick.Automaton()
        self.characters = set().union(*self.ids)
        for piece in self.characters.union(self.ids):  # a character that is no piece may still join others
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # Texts can be cut before each run of spaces if no piece goes on after other characters with a space.
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.words = Recent(KNOWN)
        self.fit: dict[tuple[str, str], bool] = {}
        self.edge: dict[str, tuple[list[tuple[str, float]], list[tuple[str, float]]] | None] = {}

    def joins(self, text: str) -> Iterator[tuple[list[str], int, float]]:
        """The encoding of a short text by its definition: the best pair joins first, of equals the leftmost. Parts, place and score of each step."""
        parts = list(text)
        while True:
            scores = [self.score.get(x + y, NONE) for x, y in zip(parts, parts[1:])]
            best = max(scores, default=NONE)
            at = scores.index(best) if best > NONE else -1
            yield parts, at, best
            if at < 0:
                return
            parts = parts[:at] + [parts[at] + parts[at + 1]] + parts[at + 2 :]

    def edges(self, token: str) -> tuple[list[tuple[str, float]], list[tuple[str, float]]] | None:
        """What stands at the left and at the right edge while a token forms, each with the score of the join that ends it.

        None for a piece that its text does not encode to, or that holds several spaces: those pieces share one score.
        """
        found = self.edge.get(token, "")
        if found == "":
            left, right = [], []
            for parts, at, best in self.joins(token):
                if at <= 0:
                    left.append((parts[0], best))
                if at < 0 or at == len(parts) - 2:
                    right.append((parts[-1], best))
            odd = len(parts) > 1 or SPACE + SPACE in token
            found = self.edge[token] = None if odd else (left, right)
        return found

    def fits(self, left: str, right: str) -> bool:
        """Whether two tokens stay as they are side by side; left is empty at the start of a text.

        They do if no join across their border comes before the joins that end what stands there; of equals the left one is first.
        """
        known = self.fit.get((left, right))
        if known is None:
            one, two = self.edges(left) if left else ([], []), self.edges(right)
            if one is None or two is None:
                *_, (parts, _, _) = self.joins(left + right)
                known = parts == ([left, right] if left else [right])
            else:
                score = self.score
                known = not any(a > x and a >= y for r, x in one[1] for l, y in two[0] if (a := score.get(r + l, NONE)) > NONE)
            if len(self.fit) >= KNOWN_PAIRS:
                self.fit.clear()
            self.fit[left, right] = known
        return known

    def known_ids(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are in pieces: the table of last tokens, and the way back through it."""
        last: list[str | None] = [None] * (len(text) + 1)
        last[0] = ""
        fit = self.fit
        for at, piece in self.automaton.iter(text):
            if last[at + 1] is None:
                left = last[at + 1 - len(piece)]
                if left is not None:
                    fits = fit.get((left, piece))
                    if fits or (fits is None and self.fits(left, piece)):
                        last[at + 1] = piece
        found, end, ids = [], len(text), self.ids
        while end:
            piece = last[end]
            end -= len(piece)
            if piece in ids:
                found.append(ids[piece])
            else:
                found += [self.byte[b] for b in reversed(piece.encode())]
        return found[::-1]

    def ids_of(self, text: str) -> tuple[int, ...]:
        if self.characters.issuperset(text):
            return tuple(self.known_ids(text))
        # Characters that are in no piece join nothing and stand for their bytes.
        return tuple(chain.from_iterable(
            self.known_ids("".join(run)) if known else (self.byte[b] for b in "".join(run).encode())
            for known, run in groupby(text, self.characters.__contains__)
        ))

    def part(self, word: str) -> tuple[int, ...]:
        """Ids of a space and what follows it up to the next one. Short parts are kept for their next time."""
        body, end = word, ""
        while len(body) > 1 and body[-1] in ".,;:!?\n" and body[-2:] not in self.inside:  # no piece spans this place
            body, end = body[:-1], body[-1] + end
        ids = self.words.known.get(body) if end else None
        if ids is None:
            ids = self.ids_of(SPACE + body)
            if end and len(body) <= KNOWN_LENGTH:
                self.words.known[body] = ids
        return ids + self.ids_of(end) if end else ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if not self.cuts:
            return list(self.ids_of(SPACE + text.replace(" ", SPACE)))
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            words = [x[1:] for x in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]
        else:
            words = text.split(" ")
        new = self.words.missing(set(words))
        known = self.words.known
        for word in new:
            if len(word) <= KNOWN_LENGTH:
                known[word] = self.part(word)
        if any(len(w) > KNOWN_LENGTH for w in words):
            return list(chain.from_iterable(known[w] if len(w) <= KNOWN_LENGTH else self.part(w) for w in words))
        return list(chain.from_iterable(map(known.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes in a row form characters (a byte that belongs to none is U+FFFD); the space put in front goes."""
        text = self.text
        if self.byte_of.keys().isdisjoint(ids):
            out = "".join(map(text.__getitem__, ids))
        else:
            out = "".join(
                _characters(bytes(self.byte_of[i] for i in run)) if is_bytes else "".join(map(text.__getitem__, run))
                for is_bytes, run in groupby(ids, self.byte_of.__contains__)
            )
        return out[1:] if ids and text[ids[0]][:1] == " " else out


def _characters(data: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        for width in (4, 3, 2, 1):
            try:
                out.append(data[at : at + width].decode())
            except UnicodeDecodeError:
                continue
            at += width
            break
        else:
            out.append("\ufffd")
            at += 1
    return "".join(out)


def encode(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """df with `ids` and `decoded`, the text that decoding the ids gives back.

    Null and empty texts have no ids and an empty decoded text. Texts are never cut short; a row is computed by itself, so
    repeated rows, other columns and empty tables need nothing. Columns named ids or decoded are replaced. `model` is a path
    that every executor can open.
    """

    def make():
        tool = tool_of_worker(("pieces", model), lambda: PieceEncoder(model))

        def compute(texts: list[str]) -> list[pa.Array]:
            ids = [tool.encode(x) for x in texts]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = pa.array(np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1])))
            return [pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array([tool.decode(x) for x in ids], pa.string())]

        return compute

    keep = [c for c in df.columns if c.lower() not in ("ids", "decoded")]
    return with_columns_of_text(df, text, make, ID_COLUMNS, keep, rows=64)


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep`, the number of ids, and digests of the ids and of the text they decode to."""
    return encoded.select(
        *keep, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return digests(encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")), "doc_id")
