"""Words of whole batches of texts: Arrow splits and codes them, each different word is worked on once, and NumPy puts ids together again."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from agorakit.llm.arrow import Recent

#: The pattern of the tokenizer file that RUNS follows, on lower-case words of PLAIN letters, whose normal form they are.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = "^[!-~À-ÖØ-öø-ÿ]*$"
RUNS = "('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+)"


class Rows(NamedTuple):
    """The ids of many entries, one after the other, and the number of ids of each."""

    flat: np.ndarray
    sizes: np.ndarray

    def at(self, index: np.ndarray) -> Rows:
        """The entries at these places."""
        sizes, starts = self.sizes[index], np.cumsum(self.sizes) - self.sizes
        before = np.cumsum(sizes) - sizes
        return Rows(self.flat[np.repeat(starts[index] - before, sizes) + np.arange(sizes.sum())], sizes)

    def joined(self, offsets: np.ndarray) -> Rows:
        """Entries between neighbouring offsets as one entry each."""
        return Rows(self.flat, np.diff(np.concatenate([np.zeros(1, np.int64), np.cumsum(self.sizes)])[offsets]))


def known_rules(described: dict) -> bool:
    """Whether a tokenizer file lowers letters and splits by KNOWN_PATTERN."""
    patterns = [x.get("pattern", {}).get("Regex") for x in (described["pre_tokenizer"] or {}).get("pretokenizers", [])]
    return KNOWN_PATTERN in patterns and {"type": "Lowercase"} in (described["normalizer"] or {}).get("normalizers", [])


def of_strings(strings: pa.Array, kept: Recent, ids_of: Callable[[list[str]], Iterable[bytes]], kind: str, longest: int) -> Rows:
    """The ids of different strings; ids_of is asked for those that are not kept, and those up to the longest are kept. An empty string has none."""
    listed = strings.to_numpy(zero_copy_only=False).tolist()
    new = [x for x in kept.missing(set(listed)) if x]
    known = kept.known
    known[""] = b""
    known.update(zip(new, ids_of(new)))
    each = list(map(known.__getitem__, listed))
    for x in new:
        if len(x) > longest:
            del known[x]
    return Rows(np.frombuffer(b"".join(each), kind), np.fromiter(map(len, each), np.int64, len(each)) // np.dtype(kind).itemsize)


def by_runs(words: pa.Array, added: list[str], of_runs: Callable[[pa.Array], Rows], of_others: Callable[[pa.Array], Rows]) -> Rows:
    """The ids of different words: plain ones without an added token in them from their lower-case runs, the others as they are."""
    plain = pc.match_substring_regex(words, PLAIN)
    for x in added:
        plain = pc.and_not(plain, pc.match_substring(words, x))
    runs = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), RUNS, r"\1 "), " ")
    coded = runs.flatten().dictionary_encode()
    split = of_runs(coded.dictionary).at(coded.indices.to_numpy()).joined(runs.offsets.to_numpy())
    whole = of_others(words.filter(pc.invert(plain)))
    first = plain.to_numpy(zero_copy_only=False)
    place = np.where(first, np.cumsum(first) - 1, len(split.sizes) + np.cumsum(~first) - 1)
    return Rows(np.concatenate([split.flat, whole.flat]), np.concatenate([split.sizes, whole.sizes])).at(place)


def by_words(texts: pa.Array, of_words: Callable[[pa.Array], Rows]) -> Rows:
    """The ids of texts without nulls from those of their different words between spaces and line ends."""
    split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    coded = split.flatten().dictionary_encode()
    return of_words(coded.dictionary).at(coded.indices.to_numpy()).joined(split.offsets.to_numpy())
