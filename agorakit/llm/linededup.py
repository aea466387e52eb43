"""Line dedup by site-relative frequency: lines that stand on too large a share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorakit.llm.common import fresh
from agorakit.session import cut

#: A line on more than this share of a host's pages is boilerplate.
RATIO = 0.1
#: Pages on which a line must stand in any case: on fewer it is a chance hit, however small the host.
LEAST = 3


def line_key(line: Column) -> Column:
    """60 bits of the MD5 of a line."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("bigint")


def _keys(text: Column) -> Column:
    """The keys of the different lines of a page, without outer spaces and not blank, in order."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.sort_array(F.array_distinct(F.transform(lines, line_key)))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """One row per host: `_drop`, the keys of its boilerplate lines.

    A line, without outer spaces and not blank, is boilerplate if the pages of its host that have it are more than `ratio` of the
    host's pages, and `least` pages at least. The rule is the same for hosts of every size. Copies must not make a page's own lines boilerplate,
    so pages count by what else is on them, in two ways: a page stands for its two lines of least key in the host's total, and for the
    least of its other lines where a line is counted; and the same with the greatest. The rule must hold in both. Exact copies are one page
    so, and near copies few, unless the edit hits both lines; a line that different pages share meets different lines on them and counts for
    each. Null hosts are one host. A host with L lines a page has at most L / ratio such lines, so the arrays do not grow
    with the host. A line of another text is taken for a boilerplate line with a chance of 2^-60.
    """
    ends = F.array(*[F.struct(F.lit(k).alias("k"), F.get("_lines", at).alias("one"), F.get("_lines", then).alias("two")) for k, at, then in (
        (0, F.lit(0), F.lit(1)), (1, F.size("_lines") - 1, F.size("_lines") - 2))])
    seen = docs.select(F.col(host).alias("_h"), _keys(F.col(text)).alias("_lines")).withColumn("_end", F.explode(ends))
    totals = seen.select(F.col("_h").alias("_site"), F.col("_end.k").alias("_way"), "_end").distinct().groupBy("_site", "_way").agg(F.count(F.lit(1)).alias("_total"))
    other = F.when(F.col("_line") == F.col("_end.one"), F.col("_end.two")).otherwise(F.col("_end.one"))
    pages = seen.select("_h", "_end", F.explode("_lines").alias("_line")).select("_h", "_line", F.col("_end.k").alias("_k"), other.alias("_other")).distinct()
    often = pages.groupBy("_h", "_line", "_k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    over = often.join(totals, F.col("_h").eqNullSafe(F.col("_site")) & (F.col("_k") == F.col("_way"))).where(F.col("_n") > F.col("_total") * ratio)
    both = over.groupBy("_h", "_line").agg(F.count(F.lit(1)).alias("_ways")).where("_ways = 2")
    return both.groupBy("_h").agg(F.sort_array(F.collect_list("_line")).alias("_drop"))


def line_dedup(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """docs with boilerplate lines taken out of the text, and n_lines and n_dropped.

    Every row stays, also one whose lines all go (its text is then empty). A text without boilerplate stays as it is;
    null texts stay null and have 0 lines, an empty text has one. The same line several times in a page counts once and goes
    everywhere. Columns named n_lines or n_dropped are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    hit, site, drop = fresh(docs, "_hit", "_site", "_drops")
    rules = cut(boilerplate(docs, host, text, ratio, least), "boilerplate").select(F.col("_h").alias(site), F.col("_drop").alias(drop))
    found = docs.select(*kept).join(rules, F.col(host).eqNullSafe(F.col(site)), "left")
    lines = F.split(F.col(text), "\n")
    keys = F.transform(lines, lambda x: line_key(F.trim(x)))
    found = found.withColumn(hit, F.when(F.col(drop).isNotNull(), F.array_intersect(keys, F.col(drop))))
    any_hit = F.coalesce(F.size(hit), F.lit(0)) > 0
    left = F.filter(lines, lambda x: ~F.array_contains(F.col(hit), line_key(F.trim(x))))
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    out = [F.when(any_hit, F.array_join(left, "\n")).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in kept]
    return found.select(*out, F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
                        F.when(any_hit, F.size(lines) - F.size(left)).otherwise(0).cast("long").alias("n_dropped"))


def query(docs: DataFrame) -> DataFrame:
    """Each document with its source as host: its lines, how many went, and the text that is left."""
    return line_dedup(docs.select("doc_id", "source", "text")).select("doc_id", "source", "n_lines", "n_dropped", "text")


_KEY = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"

ORACLE = f"""
WITH pages AS (
  SELECT doc_id, source, list_sort(list_distinct(list_transform(list_filter(list_transform(string_split(text, chr(10)),
    lambda x: trim(x, ' ')), lambda x: x <> ''), lambda x: {_KEY.format('x')}))) AS keys
  FROM documents
), ends AS (
  SELECT source, keys, 0 AS k, keys[1] AS one, keys[2] AS two FROM pages UNION ALL SELECT source, keys, 1, keys[len(keys)], keys[len(keys) - 1] FROM pages
), totals AS (SELECT source, k, count(*) AS n FROM (SELECT DISTINCT source, k, one, two FROM ends) GROUP BY source, k),
stands AS (
  SELECT DISTINCT p.source, p.k, u.line, CASE WHEN u.line = p.one THEN p.two ELSE p.one END AS other FROM ends p, unnest(p.keys) AS u(line)
), often AS (
  SELECT s.source, s.line FROM stands s JOIN totals t ON s.source IS NOT DISTINCT FROM t.source AND s.k = t.k
  GROUP BY s.source, s.k, s.line, t.n HAVING count(*) >= {LEAST} AND count(*) > t.n * CAST({RATIO} AS DOUBLE)
), frequent AS (SELECT source, line FROM often GROUP BY source, line HAVING count(*) = 2
), rules AS (SELECT source, list(line) AS dropped FROM frequent GROUP BY source),
parted AS (
  SELECT d.*, string_split(d.text, chr(10)) AS lines, list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(coalesce(r.dropped, []), {_KEY.format("trim(x, ' ')")})) AS kept
  FROM documents d LEFT JOIN rules r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, source, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped,
  CASE WHEN coalesce(len(kept) = len(lines), true) THEN text ELSE array_to_string(kept, chr(10)) END AS text
FROM parted
"""
