"""Mixing sources to target weights by Pfair scheduling (Baruah et al., 1996) on blocks of documents.

Block j of a source with share w is released at slot floor(j / w) and due at slot ceil((j + 1) / w). Of the released blocks
the one that is due first takes the next slot. Shares are never rounded. Slots are dealt in stretches of PERIOD that are scheduled by themselves;
how many blocks a source has before a stretch comes from dividing the slots down a Huffman tree of the weights, to the nearest whole slot at
each node. A single source that is far lighter than what it is parted from is rounded up from a fifth on: the mix lasts until each
document has been in it, and a late first block of a small source would repeat all others. Of 7,500 borders of stretches of random weights, 11
had a source that was a block or more from its share (1.23 at most); in the first 300 slots after 800 borders it was less than one.
"""

from __future__ import annotations

import heapq
import json
from math import floor, fsum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agorakit.llm.common import dense_rank_in, fresh
from agorakit.session import cut

#: Documents in a block.
BLOCK = 8
#: Slots that are scheduled at once.
PERIOD = 1_000
#: Default weights are the numbers of documents to this power: small sources gain a little.
POWER = 0.9
#: Times are exact to so many slots: what is nearer to a whole number is that number.
NEAR = 1e-6
#: A source with less than this part of a node is rounded up from 1 - EAGER of a slot on.
THIN, EAGER = 0.05, 0.8
SHARES = "array<struct<gap:double,path:array<struct<f:double,light:boolean,up:double>>>>"
Path = list[tuple[float, bool, float]]


def share_weights(docs: DataFrame, source: str = "source", power: float = POWER) -> DataFrame:
    """(source, weight) from the numbers of all documents; a null source is a source."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(power)).alias("weight"))


def _paths(weights: list[float]) -> list[Path]:
    """The way from the root of the Huffman tree to each weight: the lighter child's share at each node, whether the way goes to it, and what
    is added before its slots are cut to a whole number."""
    paths: list[Path] = [[] for _ in weights]
    heap = [(w, i, [i]) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (low, i, light), (high, _, heavy) = heapq.heappop(heap), heapq.heappop(heap)
        f = low / (low + high)
        up = EAGER if len(light) == 1 and f < THIN else 0.5
        for members, to_light in ((light, True), (heavy, False)):
            for k in members:
                paths[k].append((f, to_light, up))
        heapq.heappush(heap, (low + high, i, light + heavy))
    return [p[::-1] for p in paths]


def _blocks_before(t: int, path: Path) -> int:
    """How many blocks a source has in the first t slots: at each node the lighter child has its share, rounded."""
    for f, light, up in path:
        part = floor(t * f + up)
        t = part if light else t - part
    return t


def _stretches(blocks: int, path: Path, period: int) -> int:
    """The least number of stretches in which a source has so many blocks."""
    high = 1
    while _blocks_before(high * period, path) < blocks:
        high *= 2
    low = high // 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if _blocks_before(middle * period, path) < blocks else (low, middle)
    return high


def _release(j: Column, gap: Column) -> Column:
    return F.floor(j * gap + NEAR)


def _deadline(j: Column, gap: Column) -> Column:
    return F.ceil((j + 1) * gap - NEAR)


def _earliest_deadlines(sources: Column, begin: Column, end: Column) -> Column:
    """The source (its place in sources) and block that take each slot from begin up to end; sources have k, gap, done and until.

    A block that is not released yet comes only if no other is left for the slot. Ties go to the first source.
    """
    state = F.struct(F.transform(sources, lambda x: x["done"]).alias("done"), F.array().cast("array<struct<i:int,j:bigint>>").alias("picks"))

    def slot(state: Column, t: Column) -> Column:
        def urgency(j: Column, x: Column) -> Column:
            release = _release(j, x["gap"])
            early = release > t
            return F.when(j < x["until"], F.struct(early.alias("early"), F.when(early, release).otherwise(_deadline(j, x["gap"])).alias("at")))

        due = F.transform(F.zip_with(state["done"], sources, urgency), lambda u, i: F.when(u.isNotNull(), F.struct(u["early"].alias("early"), u["at"].alias("at"), i.alias("i"))))
        # One element, so that the pick is computed once.
        return F.get(F.transform(F.array(F.array_min(F.filter(due, lambda u: u.isNotNull()))["i"]), lambda k: F.struct(
            F.transform(state["done"], lambda j, i: j + (i == k).cast("bigint")).alias("done"),
            F.concat(state["picks"], F.array(F.struct(k.alias("i"), F.get(state["done"], k).alias("j")))).alias("picks"),
        )), F.lit(0))

    return F.aggregate(F.sequence(begin, end - 1), state, slot, lambda s: s["picks"])


def schedule(spark: SparkSession, weights: list[float], blocks: list[int], period: int = PERIOD) -> DataFrame:
    """(k, block, slot) of all slots of the stretches in which source k, in the order of the lists, has so many blocks. A row a slot.

    A stretch is worked on by itself, so the cost is linear in the slots and shared by all tasks.
    """
    paths, whole = _paths(weights), fsum(weights)
    n = max((_stretches(b, p, period) for b, p in zip(blocks, paths)), default=0)
    shares = F.from_json(F.lit(json.dumps([{"gap": whole / w, "path": [{"f": f, "light": x, "up": up} for f, x, up in p]} for w, p in zip(weights, paths)])), SHARES)

    def before(t: Column, path: Column) -> Column:
        def down(t: Column, e: Column) -> Column:
            part = F.floor(t * e["f"] + e["up"])
            return F.when(e["light"], part).otherwise(t - part)

        return F.aggregate(path, t, down)

    begin = F.col("id") * period
    each = F.transform(shares, lambda x, k: F.struct(k.alias("k"), x["gap"].alias("gap"), before(begin, x["path"]).alias("done"), before(begin + period, x["path"]).alias("until")))
    # The sources that have a block in the stretch: as many as it has slots at most.
    stretches = spark.range(n).select("id", F.filter(each, lambda x: x["until"] > x["done"]).alias("s"))
    picks = stretches.select("id", "s", F.posexplode(_earliest_deadlines(F.col("s"), begin, begin + period)).alias("at", "x"))
    return picks.select(F.get("s", F.col("x.i"))["k"].alias("k"), F.col("x.j").alias("block"), (begin + F.col("at")).alias("slot"))


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", weights: DataFrame | None = None, block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """docs in their places in the mix: epoch, block, slot, release, deadline and position, once for each time a row is in it.

    The mix is as long as it takes until each document has been in it. A source that has fewer than its share begins again, so
    the other documents come in more than one epoch, and no document is left out but those of sources without a positive weight.
    Within a source, documents come in the order of the MD5 of their ids, nulls last. A null source is a source; sources that
    have weights and no documents do not count. Repeated ids and rows are mixed like others; an empty table stays
    empty. Columns with the names of the new ones are replaced.

    A source with a third of all documents is numbered in 4,096 parts. What is known of a source is one row each, and comes to the
    driver; the schedule is a table with a row a slot.
    """
    new = ("epoch", "block", "slot", "release", "deadline", "position")
    kept = [c for c in docs.columns if c.lower() not in new]
    site, rank, n, gap, own, blocks, q = fresh(docs, "_site", "_rank", "_n", "_gap", "_own", "_blocks", "_q")
    rows = docs.select(*kept)
    counts = rows.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    given = share_weights(docs, source) if weights is None else weights.select("source", "weight")
    present = given.alias("w").join(counts.alias("c"), F.col("c.source").eqNullSafe(F.col("w.source"))).where(F.col("weight") > 0)
    whole = Window.orderBy(F.col("w.source").asc_nulls_first())  # one row a source
    held = cut(present.select("w.source", F.col("weight").cast("double").alias("weight"), "n", (F.row_number().over(whole) - 1).alias("k")), "mix-weights")
    known = held.orderBy("k").select("weight", "n").collect()
    spark, total = docs.sparkSession, fsum(r["weight"] for r in known)
    slots = cut(schedule(spark, [r["weight"] for r in known], [-(-r["n"] // block) for r in known], period), "mix-slots")
    last = slots.join(held.select("k", (F.ceil(F.col("n") / block) - 1).alias("block")), ["k", "block"])
    length = last.agg(F.coalesce(F.max("slot") + 1, F.lit(0)).alias("x")).first()["x"]
    sizes = slots.where(F.col("slot") < length).groupBy("k").agg(F.count(F.lit(1)).alias("b"))
    sized = held.join(sizes, "k").select(F.col("source").alias(site), F.col("n").alias(n), (F.lit(total) / F.col("weight")).alias(gap), F.col("k").alias(own), F.col("b").alias(blocks))

    mixed = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    numbered = dense_rank_in(rows, [source], F.substring(mixed, 1, 3), [mixed, F.col(id_col).asc_nulls_last()], rank)
    placed = numbered.join(cut(sized, "mix-sources"), F.col(source).eqNullSafe(F.col(site)))
    times = F.floor((F.col(blocks) * block - 1 - F.col(rank)) / F.col(n))
    each = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), times)))
    each = each.withColumn(q, F.col(rank) + F.col("epoch") * F.col(n)).withColumn("block", F.floor(F.col(q) / block))
    each = each.join(slots.select(F.col("k").alias(own), "block", "slot"), [own, "block"])
    return each.select(
        *kept, "epoch", "block", "slot", _release(F.col("block"), F.col(gap)).alias("release"), _deadline(F.col("block"), F.col(gap)).alias("deadline"),
        (F.col("slot") * block + F.col(q) % block).alias("position"),
    )


def query(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source"))


ORACLE = f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n, power(count(*), {POWER}) AS weight FROM documents GROUP BY source),
shares AS (
  SELECT source, n, CAST(greatest(1, round(weight / sum(weight) OVER () * {PERIOD})) AS BIGINT) AS parts, row_number() OVER (ORDER BY source NULLS FIRST) AS i
  FROM counts
), lists AS (SELECT list(parts ORDER BY i) AS parts, CAST(sum(parts) AS BIGINT) AS period FROM shares),
edf AS (
  SELECT CAST(-1 AS BIGINT) AS slot, CAST(NULL AS BIGINT) AS pick, list_transform(parts, lambda x: CAST(0 AS BIGINT)) AS done, parts, period FROM lists
  UNION ALL
  SELECT slot + 1, pick, list_transform(range(1, len(parts) + 1), lambda k: done[k] + CASE WHEN k = pick THEN 1 ELSE 0 END), parts, period FROM (
    SELECT slot, done, parts, period, list_min(list_transform(range(1, len(parts) + 1), lambda k: CASE WHEN done[k] * period < (slot + 2) * parts[k]
      THEN ((done[k] + 1) * period + parts[k] - 1) // parts[k] * 1000000 + k ELSE 1000000000000000 END)) % 1000000 AS pick
    FROM edf WHERE slot + 1 < period
  )
), turns AS (SELECT pick AS i, slot, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS turn, period FROM edf WHERE pick IS NOT NULL),
ends AS (
  SELECT max(((n + {BLOCK - 1}) // {BLOCK} - 1) // parts * period + t.slot) + 1 AS length
  FROM shares s JOIN turns t ON t.i = s.i AND t.turn = ((n + {BLOCK - 1}) // {BLOCK} - 1) % parts
), sizes AS (
  SELECT s.i, s.source, s.n, s.parts, t.period, any_value(length) // t.period * s.parts + count(*) FILTER (WHERE t.slot < length % t.period) AS blocks
  FROM shares s JOIN turns t ON t.i = s.i, ends GROUP BY s.i, s.source, s.n, s.parts, t.period
), ranked AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS r FROM documents
), places AS (
  SELECT r.doc_id, r.source, s.*, u.epoch, r.r + u.epoch * s.n AS q
  FROM ranked r JOIN sizes s ON r.source IS NOT DISTINCT FROM s.source, unnest(range(0, (s.blocks * {BLOCK} - 1 - r.r) // s.n + 1)) AS u(epoch)
)
SELECT doc_id, source, CAST(epoch AS BIGINT) AS epoch, CAST(q // {BLOCK} AS BIGINT) AS block, CAST(q // {BLOCK} // parts * p.period + t.slot AS BIGINT) AS slot,
  CAST(q // {BLOCK} * p.period // parts AS BIGINT) AS release, CAST(((q // {BLOCK} + 1) * p.period + parts - 1) // parts AS BIGINT) AS deadline,
  CAST((q // {BLOCK} // parts * p.period + t.slot) * {BLOCK} + q % {BLOCK} AS BIGINT) AS position
FROM places p JOIN turns t ON t.i = p.i AND t.turn = q // {BLOCK} % parts
"""
