"""Fill-in-middle by displacement scatter: each byte of a batch has a shift, and one scatter moves all of them.

The cuts of all texts of a batch are found in one flat array of bytes. A difference array has the change of the shift at each
cut; its cumulative sum is the shift of each byte, and a scatter builds all outputs at once. The way back finds the
markers, and gathers with the shifts of the restored bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorakit.llm.common import fresh
from agorakit.llm.flat import as_strings, flat_bytes, parts, sums_before

#: The markers of prefix, suffix and middle, and the forms.
PREFIX, SUFFIX, MIDDLE = (np.frombuffer(m, np.uint8) for m in (b"<P>", b"<S>", b"<M>"))
MARK = 3
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
#: Of 100 texts, those from here on stay plain; of 100 others, those below have the suffix first.
PLAIN_FROM, SUFFIX_FIRST = 90, 20
SEED = "1"


def units(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where units begin: runs of ASCII letters, and other code points one by one. No unit goes over the end of a text."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[cuts[:-1][np.diff(cuts) > 0]] = True
    return np.flatnonzero(begins)


def markers(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the markers, and the text that each is in."""
    kind = data[1:-1]
    at = np.flatnonzero((data[:-2] == PREFIX[0]) & (data[2:] == PREFIX[2]) & ((kind == PREFIX[1]) | (kind == SUFFIX[1]) | (kind == MIDDLE[1])))
    text = np.searchsorted(cuts, at, "right") - 1
    inside = at + MARK <= cuts[text + 1]
    return at[inside], text[inside]


def draws(ids: list, seed: str = SEED) -> np.ndarray:
    """Four numbers for each id: the first 8-digit groups of the SHA-256 of `seed:id`. A null id counts as an empty one."""
    digests = b"".join(sha256(f"{seed}:{'' if i is None else i}".encode()).digest() for i in ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 8)[:, :4].astype(np.int64)


def shifts(begins: np.ndarray, moves: np.ndarray, size: int) -> np.ndarray:
    """The shift of each of `size` bytes, from segments in order: where they begin, and how far they move. Segments may be empty."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begins, np.diff(moves, prepend=0))
    return np.cumsum(change[:-1])


def scatter(data: np.ndarray, cuts: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outputs of texts cut at the bytes low and high, in their forms, as flat bytes with their cuts."""
    first, last = cuts[:-1], cuts[1:]
    p, m, s = low - first, high - low, last - high
    out_cuts = sums_before(last - first + 3 * MARK * (form != PLAIN))
    out = np.empty(out_cuts[-1], np.uint8)
    start = out_cuts[:-1]
    to_prefix = np.choose(form, [start, start + MARK, start + 2 * MARK + s])
    to_middle = np.choose(form, [start + p, *[start + 3 * MARK + p + s] * 2])
    to_suffix = np.choose(form, [start + p + m, start + 2 * MARK + p, start + MARK])
    begins, moves = np.stack([first, low, high], 1), np.stack([to_prefix - first, to_middle - low, to_suffix - high], 1)
    out[np.arange(len(data)) + shifts(begins.ravel(), moves.ravel(), len(data))] = data
    marked = form != PLAIN
    for marker, to in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        out[(to[marked] - MARK)[:, None] + np.arange(MARK)] = marker
    return out, out_cuts


def gather(out: np.ndarray, out_cuts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts from outputs and forms alone, as flat bytes with their cuts."""
    start, end = out_cuts[:-1], out_cuts[1:]
    marked = np.flatnonzero(form != PLAIN)
    at, text = markers(out, out_cuts)
    at = at[form[text] != PLAIN]
    if len(at) != 3 * len(marked) or not (np.repeat(marked, 3) == text[form[text] != PLAIN]).all():
        raise ValueError("an output in the form psm or spm has three markers")
    one, two, three = at.reshape(-1, 3).T
    suffix_first = form[marked] == SPM
    from_prefix, from_middle, from_suffix = start.copy(), end.copy(), end.copy()
    from_prefix[marked] = np.where(suffix_first, two, one) + MARK
    from_suffix[marked] = np.where(suffix_first, one, two) + MARK
    from_middle[marked] = three + MARK
    p, m = end - start, end - from_middle
    p[marked] = np.where(suffix_first, three, two) - from_prefix[marked]
    cuts = sums_before(end - start - 3 * MARK * (form != PLAIN))
    first = cuts[:-1]
    begins = np.stack([first, first + p, first + p + m], 1)
    moves = np.stack([from_prefix, from_middle, from_suffix], 1) - begins
    return out[np.arange(cuts[-1]) + shifts(begins.ravel(), moves.ravel(), int(cuts[-1]))], cuts


NEW = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType())]


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text: str = "text", seed: str = SEED, plain_from: int = PLAIN_FROM, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """df with n (units), form, prefix_chars, middle_chars (code points, null if plain) and output.

    A text is cut at two of its unit borders that its id draws. Null and empty texts are plain with an empty output, texts that hold
    a marker stay as they are. Texts are never cut short; a row is computed by itself, so repeated rows, other columns and
    empty tables need nothing, and rows that share an id draw alike. Columns with the names of the new ones are replaced.
    """
    new = [n for n, _ in NEW]
    keep = [c for c in df.columns if c.lower() not in new]
    ident, body = fresh(df, "_ident", "_body")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, t) for n, t in NEW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, len(keep) + 1):
                data, cuts = flat_bytes(batch.column(len(keep) + 1))
                h1, h2, h3, h4 = draws(batch.column(len(keep)).to_pylist(), seed).T
                begins = units(data, cuts)
                first = np.searchsorted(begins, cuts)
                n = np.diff(first)
                at, mod = np.append(begins, len(data)), n + 1
                low, high = (np.where(k < n, at[np.minimum(first[:-1] + k, len(begins))], cuts[1:]) for k in (np.minimum(h1 % mod, h2 % mod), np.maximum(h1 % mod, h2 % mod)))
                stays = (n == 0) | (h3 % 100 >= plain_from)
                stays[markers(data, cuts)[1]] = True
                form = np.where(stays, PLAIN, np.where(h4 % 100 < suffix_first, SPM, PSM))
                before = sums_before((data & 0xC0) != 0x80)
                prefix, middle = before[low] - before[cuts[:-1]], before[high] - before[low]
                columns = [
                    pa.array(n), pa.array(FORMS).take(pa.array(form)), pa.array(prefix, mask=stays), pa.array(middle, mask=stays),
                    as_strings(*scatter(data, cuts, low, high, form)),
                ]
                yield pa.RecordBatch.from_arrays(batch.columns[: len(keep)] + columns, [*keep, *new])

    return df.select(*keep, F.col(id_col).cast("string").alias(ident), F.col(text).cast("string").alias(body)).mapInArrow(run, schema)


def restore(df: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """df with the text that each output was made from, by its form. An output that lacks its markers raises an error."""
    keep = [c for c in df.columns if c.lower() != out.lower()]
    code, body = fresh(df, "_code", "_body")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, len(keep) + 1):
                data, cuts = flat_bytes(batch.column(len(keep) + 1))
                texts = as_strings(*gather(data, cuts, batch.column(len(keep)).to_numpy()))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], [*keep, out])

    codes = F.when(F.col(form) == "psm", PSM).when(F.col(form) == "spm", SPM).otherwise(PLAIN)
    return df.select(*keep, codes.alias(code), F.col(output).alias(body)).mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    """Digests of each output and of the text restored from it."""
    filled = restore(fill_in_middle(docs.select("doc_id", "text")).drop("text"))
    return filled.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
