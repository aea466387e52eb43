"""Token files: flat unsigned integers of all documents and 64-bit document offsets, both memory-mapped when read.

A folder holds one pair of files for each partition of the document order. `NNNNNN.bin` has the ids, each with `width` little-endian
bytes. `NNNNNN.idx` has MAGIC, then width, documents and documents without an id as unsigned 64-bit integers, then the ids of the documents
(signed 64-bit) and the offsets of their first tokens in the file, with the end as last (unsigned 64-bit). The first token of a
file in the whole order is its base, a prefix sum over the files before it.
"""

from __future__ import annotations

import gc
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agorakit.llm.arrow import Recent
from agorakit.llm.common import fresh, text_of
from agorakit.llm.words import Rows, by_runs, by_words, known_rules, of_strings
from agorakit.session import cut, scratch_path

MAGIC = b"TOKENIX1"
HEADER = len(MAGIC) + 24
KNOWN = 1_600_000
KNOWN_LENGTH = 48
ROWS = 256
TOGETHER = 500
#: Bytes of text that are encoded at once (or one text, if it is longer).
TEXT_BYTES = 8 << 20
MOST_READERS = 10_000
END_ID = 2


class WordTokenizer:
    """A tokenizers file whose pre-tokenizer drops white space: texts are split at spaces and line ends, equal words of a batch are coded once.

    Words of PLAIN letters are split further by Arrow, into runs that the file's pattern never joins, if the file has the rules which that
    split knows. A worker keeps the ids of runs; many new runs are encoded in one text, which the end-of-word mark of their last
    tokens parts again. Other words are kept and encoded whole. NumPy puts ids of runs together to words, and those of words to texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules, vocab = json.loads(self.tokenizer.to_str()), self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if len(vocab) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.added = [x["content"] for x in rules["added_tokens"]]
        mark = rules["model"].get("end_of_word_suffix")
        self.by_runs = bool(mark) and known_rules(rules)
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        if mark:
            self.last[[i for x, i in vocab.items() if x.endswith(mark)]] = True
        self.words, self.runs = Recent(KNOWN), Recent(KNOWN)

    def _whole(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word; no offsets are asked for."""
        for at in range(0, len(words), TOGETHER):
            for x in self.tokenizer.encode_batch_fast(words[at : at + TOGETHER], add_special_tokens=False):
                yield np.array(x.ids, self.kind).tobytes()

    def _together(self, runs: list[str]) -> Iterator[bytes]:
        """Ids of each run, from texts of many."""
        for at in range(0, len(runs), TOGETHER):
            some = runs[at : at + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = (np.flatnonzero(self.last[ids]) + 1) * self.width
            if len(ends) != len(some):
                yield from self._whole(some)
                continue
            raw, first = ids.tobytes(), 0
            for end in ends.tolist():
                yield raw[first:end]
                first = end

    def _whole_rows(self, words: pa.Array) -> Rows:
        return of_strings(words, self.words, self._whole, self.kind, KNOWN_LENGTH)

    def _run_rows(self, runs: pa.Array) -> Rows:
        return of_strings(runs, self.runs, self._together, self.kind, KNOWN_LENGTH)

    def _words(self, words: pa.Array) -> Rows:
        return by_runs(words, self.added, self._run_rows, self._whole_rows) if self.by_runs else self._whole_rows(words)

    def encode(self, texts: pa.Array, end_id: int | None = None) -> Rows:
        """The ids of all texts, with the end id behind each text if there is one."""
        found = by_words(texts, self._words)
        if end_id is None:
            return found
        return Rows(np.insert(found.flat, np.cumsum(found.sizes), end_id), found.sizes + 1)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    gc.disable()  # a worker keeps many words and makes no cycles: looking through the words again and again costs more than to encode them
    return WordTokenizer(path)


def mounted(folder: str) -> str:
    """The folder as a path; memory-mapped files need one that all executors mount."""
    at = urlparse(folder)
    if at.scheme not in ("", "file"):
        raise ValueError(f"token files need a mounted folder, not {folder}")
    return at.path


def write_tokens(df: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Writes the ids of all texts in ascending order of id_col, and returns the files: part, path, n_docs, n_tokens, base_docs, base_tokens.

    Null ids come first, then ascending; rows with equal ids are ordered by the hash of their text, so one id may fill many files. Null
    texts count as empty; each document gets the end id (if there is one), so an empty one has that id alone. Rows are
    dealt out by ranges, and a file is named after its range: a task that runs again writes the same file, and the file
    appears whole or not at all. An empty table has no files. The bases are prefix sums over one row for each file.
    """
    spark, at = df.sparkSession, mounted(folder)
    (tie,) = fresh(df, "_tie")
    # Text hashes part rows that share an id, also between ranges.
    ranged = df.select(F.col(id_col).cast("bigint").alias("id"), text_of(text).alias("text")).withColumn(tie, F.xxhash64("text"))
    ordered = ranged.repartitionByRange(F.col("id").asc_nulls_first(), F.col(tie)).sortWithinPartitions(F.col("id").asc_nulls_first(), tie)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _tokenizer(tokenizer)
        context = TaskContext.get()
        part = context.partitionId()
        final, mine = f"{at}/{part:06d}", f"{at}/{part:06d}.{context.taskAttemptId()}.tmp"
        ids, sizes, nulls, out = [], [], 0, None
        for batch in batches:
            bytes_to = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64) // TEXT_BYTES
            firsts = np.flatnonzero(np.diff(bytes_to, prepend=-1)).tolist()
            for first, last in zip(firsts, [*firsts[1:], batch.num_rows]):
                rows = batch.slice(first, last - first)
                if out is None:
                    os.makedirs(at, exist_ok=True)
                    out = open(f"{mine}.bin", "wb")
                nulls += rows.column(0).null_count
                ids.append(rows.column(0).fill_null(0).to_numpy())
                found = tool.encode(rows.column(1), end_id)
                sizes.append(found.sizes.astype(np.uint64))
                out.write(found.flat.tobytes())
        if out is not None:
            out.close()
            n = sum(map(len, ids))
            offsets = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.concatenate(sizes), dtype=np.uint64)])
            with open(f"{mine}.idx", "wb") as index:
                index.write(MAGIC + np.array([tool.width, n, nulls], "<u8").tobytes())
                index.write(np.concatenate(ids).astype("<i8").tobytes() + offsets.astype("<u8").tobytes())
            for kind in ("bin", "idx"):
                os.replace(f"{mine}.{kind}", f"{final}.{kind}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([final]), pa.array([n], pa.int64()), pa.array([int(offsets[-1])], pa.int64())],
                ["part", "path", "n_docs", "n_tokens"])

    files = cut(ordered.select("id", "text").mapInArrow(write, "part int, path string, n_docs bigint, n_tokens bigint"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return files.withColumns({f"base_{x}": F.coalesce(F.sum(f"n_{x}").over(before), F.lit(0)) for x in ("docs", "tokens")})


def mapped(path: str) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Document ids, offsets, the number of documents without an id (they are first), and the tokens of a pair of files; nothing is read yet."""
    with open(f"{path}.idx", "rb") as index:
        head = index.read(HEADER)
    if head[: len(MAGIC)] != MAGIC:
        raise ValueError(f"{path}.idx is not an index of token files")
    width, n, nulls = np.frombuffer(head[len(MAGIC) :], "<u8").tolist()
    ids = np.memmap(f"{path}.idx", "<i8", "r", HEADER, (n,))
    offsets = np.memmap(f"{path}.idx", "<u8", "r", HEADER + 8 * n, (n + 1,))
    tokens = np.memmap(f"{path}.bin", f"<u{width}", "r", 0, (int(offsets[-1]),)) if offsets[-1] else np.empty(0, f"<u{width}")
    return ids, offsets, nulls, tokens


def read_tokens(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """From the files that write_tokens returns: doc_id, start (tokens of all documents before), n_tokens, ids_crc32 and ids.

    ids_crc32 is the checksum of the ids as little-endian unsigned 32-bit integers.
    """
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, offsets, nulls, tokens = mapped(path)
                for first in range(0, len(ids), ROWS):
                    last = min(first + ROWS, len(ids))
                    cuts = offsets[first : last + 1].astype(np.int64)
                    rows = [tokens[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                    columns = [
                        pa.array(ids[first:last], mask=np.arange(first, last) < nulls), pa.array(cuts[:-1] + base), pa.array(np.diff(cuts)),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in rows], pa.int64()),
                    ]
                    if with_ids:
                        flat = pa.array(tokens[cuts[0] : cuts[-1]].astype(np.int32))
                        columns.append(pa.ListArray.from_arrays(pa.array((cuts - cuts[0]).astype(np.int32)), flat))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    spread = files.select("path", "base_tokens").repartition(max(1, min(files.count(), MOST_READERS)))
    return spread.mapInArrow(read, schema)


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    files = write_tokens(docs, scratch_path(docs.sparkSession, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(files, with_ids=False)
