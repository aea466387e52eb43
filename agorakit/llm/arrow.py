"""Python over whole texts in bounded pieces: a few hundred rows at a time, whatever Spark's batches hold."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROWS = 256

_TOOL: dict[tuple, object] = {}


def tool_of_worker(key: tuple, make: Callable[[], object]) -> object:
    """The tool with this key, and what it already knows about words. A worker process keeps one: that of the operator before it goes."""
    if key not in _TOOL:
        _TOOL.clear()
        _TOOL[key] = make()
    return _TOOL[key]


class Recent:
    """What a worker knows about words: `known`, the newer half of `most` entries, and the older half, from which words in use come back."""

    def __init__(self, most: int):
        self.most, self.known, self.older = most // 2, {}, {}

    def missing(self, words: set[str]) -> set[str]:
        """The words that are not known; the others are in `known` now."""
        if len(self.known) > self.most:
            self.older, self.known = self.known, {}
        new = words.difference(self.known)
        again = {w: self.older[w] for w in new if w in self.older}
        self.known.update(again)
        return new.difference(again)


def with_columns_of_text(
    df: DataFrame, text: str, make: Callable[[], Callable[[list[str]], list[pa.Array]]], fields: list[tuple[str, T.DataType]], keep: list[str], rows: int = ROWS,
) -> DataFrame:
    """The columns `keep` of df and new columns computed from its texts (null: empty).

    `make()` is called once a task and returns a function from texts to one Arrow array for each new field.
    """
    kept = [c for c in keep if c != text] + [text]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, t) for n, t in fields])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                by_name = dict(zip(kept, part.columns))
                texts = [x or "" for x in by_name[text].to_pylist()]
                yield pa.RecordBatch.from_arrays([by_name[c] for c in keep] + compute(texts), names)

    return df.select(*kept).mapInArrow(run, schema)
