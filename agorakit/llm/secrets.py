"""Secret scan with Spark's own expressions: fixed patterns, and windows of high entropy in strings of one character class."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorakit.llm.common import fresh, text_of

#: The base patterns, and the least length of the secret in each.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
BASE = ("assign", "access", "hex")

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


@dataclass(frozen=True)
class CharacterClass:
    """Strings of these characters with a window of `window` characters that has at least `bits` bits of entropy a character."""

    name: str
    characters: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        return f"[{self.characters.replace('-', '')}{'-' if '-' in self.characters else ''}]{{{self.window},}}"


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (
    CharacterClass("entropy_hex", DIGITS + "abcdefABCDEF", 20, 2.9),
    CharacterClass("entropy_text", DIGITS + LOWER + UPPER + "+/_-", 24, 3.8),
)
#: Candidates that are left alone: words and words joined by separators, numbers, UUIDs. No group repeats without a bound: Java would go one call deeper each time.
ALLOWED = (
    r"^[A-Za-z][A-Za-z+/_-]*$",
    r"^[0-9+/_-]+$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
)
#: Words with a placeholder or a run of the alphabet part a candidate: they are left alone, and what stands on either side is looked at by itself.
PLACEHOLDERS = r"(?i)(?<![A-Za-z0-9])[A-Za-z0-9]*?(?:example|placeholder|dummy|changeme|xxxx|0123456789|abcdefghij)[A-Za-z0-9]*"


def _located(text: Column, pattern: str, matches: Column) -> Column:
    """Start and end of each match in code points, from the matches and the text between them."""
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("hit"))
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["hit"])
        span = F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))
        return F.struct(end.cast("bigint").alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    return F.aggregate(pairs, empty, step, lambda s: s["out"])


def _spans(kind: int, located: Column, kept: Column) -> Column:
    """Spans of the matches whose flag is true."""
    both = F.filter(F.arrays_zip(located.alias("s"), kept.alias("k")), lambda x: x["k"])
    return F.transform(both, lambda x: F.struct(x["s"]["start"].alias("start"), F.lit(kind).alias("kind"), x["s"]["end"].alias("end")))


def hot_windows(candidate: Column, of: CharacterClass) -> Column:
    """Ranges (start, end) of a candidate that its windows of high entropy cover, as offsets.

    The window slides by one character: one count falls, one rises, and the sum of c log2 c changes by those two counts alone.
    """
    w, size = of.window, len(of.characters)
    table = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(w + 1)])
    most = w * (log2(w) - of.bits)
    characters = F.slice(F.split(candidate, ""), F.lit(1), F.char_length(candidate))
    codes = F.transform(characters, lambda c: F.instr(F.lit(of.characters), c) - 1)
    no_ranges = F.array().cast("array<struct<start:int,end:int>>")

    def ranges(codes: Column) -> Column:
        first = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.size(F.filter(F.slice(codes, 1, w), lambda c: c == k)))
        begin = F.struct(
            first.alias("counts"), F.aggregate(first, F.lit(0.0), lambda s, c: s + F.get(table, c)).alias("sum"),
            F.lit(-1).alias("start"), F.lit(-1).alias("end"), no_ranges.alias("out"),
        )

        def slide(state: Column, i: Column) -> Column:
            gone, new = F.get(codes, i - 1), F.get(codes, i + F.lit(w - 1))
            moves = (i > 0) & (gone != new)
            counts = F.when(moves, F.transform(state["counts"], lambda c, k: c + (k == new).cast("int") - (k == gone).cast("int"))).otherwise(state["counts"])
            less, more = F.get(state["counts"], gone), F.get(state["counts"], new)
            total = F.when(
                moves, state["sum"] + F.get(table, less - 1) - F.get(table, less) + F.get(table, more + 1) - F.get(table, more),
            ).otherwise(state["sum"])
            hot = total <= most
            joined = hot & (i <= state["end"])
            closed = F.when(hot & ~joined & (state["end"] >= 0), F.concat(state["out"], F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))))
            return F.struct(
                counts.alias("counts"), total.alias("sum"), F.when(hot & ~joined, i).otherwise(state["start"]).alias("start"),
                F.when(hot, i + F.lit(w)).otherwise(state["end"]).alias("end"), F.coalesce(closed, state["out"]).alias("out"),
            )

        last = lambda s: F.when(s["end"] >= 0, F.concat(s["out"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))).otherwise(s["out"])
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - F.lit(w)), begin, slide, last)

    # One element, so that the codes are computed once and not in each step.
    return F.flatten(F.transform(F.array(codes), ranges))


def _between(run: Column, pattern: str) -> Column:
    """(at, text) of the parts of a run between matches of the pattern."""
    gaps, hits = F.split(run, pattern, -1), F.regexp_extract_all(run, F.lit(pattern), F.lit(0))
    empty = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<at:int,text:string>>").alias("out"))
    each = F.transform(gaps, lambda gap, k: F.struct(gap.alias("gap"), F.coalesce(F.char_length(F.get(hits, k)), F.lit(0)).alias("hit")))
    step = lambda s, x: F.struct(
        (s["end"] + F.char_length(x["gap"]) + x["hit"]).alias("end"), F.concat(s["out"], F.array(F.struct(s["end"].alias("at"), x["gap"].alias("text")))).alias("out"),
    )
    return F.aggregate(each, empty, step, lambda s: s["out"])


def _entropy_spans(kind: int, located: Column, candidates: Column, of: CharacterClass, allowed: tuple[str, ...], placeholders: str | None) -> Column:
    def parts(run: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).alias("at"), run.alias("text")))
        found = F.when(F.rlike(run, F.lit(placeholders)), _between(run, placeholders)).otherwise(whole) if placeholders else whole
        fits = lambda x: reduce(Column.__and__, [F.char_length(x["text"]) >= of.window, *[~F.rlike(x["text"], F.lit(p)) for p in allowed]])
        return F.filter(found, fits)

    def spans(start: Column, part: Column) -> Column:
        return F.transform(hot_windows(part["text"], of), lambda r: F.struct(
            (start + part["at"] + r["start"]).alias("start"), F.lit(kind).alias("kind"), (start + part["at"] + r["end"]).alias("end"),
        ))

    each = F.arrays_zip(located.alias("s"), candidates.alias("c"))
    return F.flatten(F.transform(each, lambda x: F.flatten(F.transform(parts(x["c"]), lambda part: spans(x["s"]["start"], part)))))


def find_secrets(df: DataFrame, text: str = "text", classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
                 placeholders: str | None = PLACEHOLDERS) -> DataFrame:
    """df with `secrets`: an array of (start, kind, end), in code points, end exclusive, ordered by start, kind and end.

    Kinds 0 to 2 are the base patterns: matches from the left that do not overlap, without those that are too short; the span is the whole
    match. Kinds from 3 on are the character classes: the parts of a run of class characters that windows of high
    entropy cover, each of the parts between words with a placeholder by itself. The allow-list suppresses those, never base spans. Null and empty texts have no secrets. Texts are never
    cut short, and a row is computed by itself: repeated rows, other columns and empty tables need nothing. A column named
    secrets is replaced.
    """
    body, *names = fresh(df, "_body", "_a", "_v", "_k", "_h", *[f"_c{i}" for i in range(len(classes))])
    assign, value, access, hexes, *runs = names
    found = df.withColumn(body, text_of(text)).withColumns({
        assign: F.regexp_extract_all(F.col(body), F.lit(ASSIGN), F.lit(0)), value: F.regexp_extract_all(F.col(body), F.lit(ASSIGN), F.lit(2)),
        access: F.regexp_extract_all(F.col(body), F.lit(f"{ACCESS[:-1]}{{{ACCESS_LENGTH - 4},}}"), F.lit(0)),
        hexes: F.regexp_extract_all(F.col(body), F.lit(f"{HEX[:-1]}{{{HEX_LENGTH},}}"), F.lit(0)),
    } | {run: F.regexp_extract_all(F.col(body), F.lit(c.pattern), F.lit(0)) for run, c in zip(runs, classes)})
    none = F.array().cast(SPAN)
    long_enough = F.transform(value, lambda v: F.char_length(v) >= ASSIGN_LENGTH)
    all_kept = lambda column: F.transform(column, lambda _: F.lit(True))
    spans = [
        # A match that is too short still takes up its place, so the base pattern is used as it is. The other two patterns
        # match whole runs, and a run that is too short holds no match that is long enough.
        (assign, _spans(0, _located(F.col(body), ASSIGN, F.col(assign)), long_enough)),
        (access, _spans(1, _located(F.col(body), f"{ACCESS[:-1]}{{{ACCESS_LENGTH - 4},}}", F.col(access)), all_kept(access))),
        (hexes, _spans(2, _located(F.col(body), f"{HEX[:-1]}{{{HEX_LENGTH},}}", F.col(hexes)), all_kept(hexes))),
        *[(run, _entropy_spans(3 + i, _located(F.col(body), c.pattern, F.col(run)), F.col(run), c, allowed, placeholders)) for i, (run, c) in enumerate(zip(runs, classes))],
    ]
    parts = [F.when(F.size(column) > 0, found_spans).otherwise(none) for column, found_spans in spans]
    return found.select(*[c for c in df.columns if c.lower() != "secrets"], F.sort_array(F.concat(*parts)).alias("secrets"))


def query(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    kinds = F.array(*[F.lit(k) for k in (*BASE, *[c.name for c in CLASSES])])
    found = find_secrets(docs.select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"] < len(BASE))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))
