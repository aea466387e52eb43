"""Members that share groups: exact partner counts, pair strengths and top pairs without a row for each pair.

Input everywhere is a membership frame with one row per (group, member):

    grp     group key
    member  member key, the id that results carry
    ord     sort key of the member; in a pair the member with the smaller ``ord`` comes first
    leads   whether the member may come first in a pair through this group
    kind    optional kind of group; groups of different kinds have different keys
    label, since   optional group name and date carried into pair rows

Two members are a pair if they share a group that the first one leads. Pair strength is the number of such groups.

Listing the pairs of a group is quadratic in its size, so only small groups (``SMALL`` members at most) have theirs listed, which takes a
bounded number of rows a membership. What is counted in larger ones goes the other way, from groups that share members:

* a member has as many later partners in a group as the group has later members, a rank;
* a pair that shares several large groups is in all their intersections, so alternating sums of ranks inside intersections count
  it once. Few sets of groups share two members, and only those are looked at (``shared_sets``);
* members with more large groups than that is good for ("wide": over ``DEGREE`` groups, or over ``MOST_SHARED`` groups that share two members
  with another of theirs) take the union of their groups as bitmaps of member ranks, one bit a partner (``bitmap_partners``);
* a pair that shares small groups and large ones is listed with the small ones, and looked up in the large ones.

All three limits choose between exact ways; no group, member or pair is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorakit.session import cut

#: Groups of a member above which its pairs of groups are not formed, and groups shared with others above which its subsets are not.
DEGREE, MOST_SHARED = 64, 6
#: Members of a group up to which its pairs are listed.
SMALL = 64
RANGE_BUCKETS = 256
#: Bits of one of Spark's bitmaps.
BITS = 32_768
#: Members of a block: a group is paired up block by block where all its pairs are the result.
BLOCK = 1_000


def with_defaults(members: DataFrame) -> DataFrame:
    for name, dtype in (("label", "string"), ("since", "timestamp")):
        if name not in members.columns:
            members = members.withColumn(name, F.lit(None).cast(dtype))
    if "leads" not in members.columns:
        members = members.withColumn("leads", F.lit(True))
    if "ord" not in members.columns:
        members = members.withColumn("ord", F.col("member"))
    if "kind" not in members.columns:
        members = members.withColumn("kind", F.lit(""))
    return members


def all_pairs(members: DataFrame, *, own: Sequence[str] = (), small: int = SMALL) -> DataFrame:
    """Every pair with its strength, group names and first date: (first, second, strength, labels, since).

    ``own`` are columns of the first member's row to carry along: those of one of the shared groups. The result is quadratic in groups by nature;
    pairs that share one large group only are streamed out of a join (``_met``), the others are put together by a shuffle.
    """
    rows = with_defaults(members)
    alone, several = _met(rows, rows.where("leads"), (F.col("_ord") < F.col("_p_ord")) & (F.col("member") != F.col("partner")), ["label", "since", *own], small)
    ends = [F.col("member").alias("first"), F.col("partner").alias("second")]
    once = alone.select(*ends, F.lit(1).cast("bigint").alias("strength"), F.array_compact(F.array("label")).alias("labels"), "since", *own)
    return once.unionByName(several.select(*ends, "label", "since", *own).groupBy("first", "second").agg(
        F.count(F.lit(1)).alias("strength"), F.array_sort(F.collect_set("label")).alias("labels"), F.min("since").alias("since"),
        *[F.min(name).alias(name) for name in own],
    ))


def _met(rows: DataFrame, mine: DataFrame, met: Column, own: Sequence[str], small: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``mine`` with the rows of the same group for which ``met`` holds, a row for each group in which two members meet.

    ``met`` reads member, _ord, _leads and partner, _p_ord, _p_leads. The first frame has the meetings in a large group of two members that share no
    other group, so each is a pair of its own and needs no shuffle; the second has all other meetings. Large groups are dealt out in blocks of
    members of ``mine``, one block against the group at a time, so that no task pairs up a large group alone.
    """
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    sized = cut(rows.select("grp", "member", "ord", "leads").join(sizes, "grp"), "sized")
    left = mine.join(sizes, "grp").select("grp", "_n", "member", F.col("ord").alias("_ord"), F.col("leads").alias("_leads"), *own)
    right = sized.select("grp", "_n", F.col("member").alias("partner"), F.col("ord").alias("_p_ord"), F.col("leads").alias("_p_leads"))
    few = left.where(F.col("_n") <= small).join(right.where(F.col("_n") <= small).drop("_n"), "grp").where(met)
    # Groups that have two members in common with a large one, for each member of both.
    far = sized.where(F.col("_n") > small).select("grp", "member")
    beside = far.join(sized.select(F.col("grp").alias("_beside"), "member"), "member").where("grp != _beside")
    common = beside.groupBy("grp", "_beside").agg(F.count(F.lit(1)).alias("_both")).where("_both > 1")
    shared = cut(beside.join(common, ["grp", "_beside"]).select("grp", "member", F.xxhash64("_beside").alias("_other"), F.ceil(F.col("_both") / BLOCK).alias("_blocks")), "beside")
    # A hash that stands for two groups only sends more pairs the longer way.
    shared = shared.groupBy("grp", "member", "_other").agg(F.max("_blocks").alias("_blocks"))
    others = cut(shared.groupBy("grp", "member").agg(F.collect_list("_other").alias("_others")), "others")
    left = left.where(F.col("_n") > small).join(others, ["grp", "member"], "left")
    right = right.where(F.col("_n") > small).join(others.withColumnsRenamed({"member": "partner", "_others": "_p_others"}), ["grp", "partner"], "left")
    dealt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    blocks = F.ceil(F.col("_n") / BLOCK)
    all_right = right.withColumn("_blocks", blocks).select("*", dealt.alias("_block")).drop("_n", "_blocks")
    # Blocks are few rows that make many pairs: dealt to a number of partitions, Spark does not merge them into few tasks by their size.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_blocks = all_right.repartition(parts, "grp", "_block").join(left.withColumn("_block", F.pmod(F.xxhash64("member"), blocks)), ["grp", "_block"])  # a block is what a task holds
    overlap = F.coalesce(F.arrays_overlap("_others", "_p_others"), F.lit(False))
    alone = in_blocks.where(met & ~overlap)
    most = shared.groupBy("grp", "_other").agg(F.max("_blocks").alias("_blocks"))
    by_other = left.select("*", F.explode("_others").alias("_other")).join(most, ["grp", "_other"]).withColumn("_block", F.pmod(F.xxhash64("member"), "_blocks")).drop("_blocks")
    others_of = right.drop("_n").select("*", F.explode("_p_others").alias("_other")).join(most, ["grp", "_other"]).select("*", dealt.alias("_block")).drop("_blocks")
    again = others_of.join(by_other, ["grp", "_other", "_block"]).where(met & (F.col("_other") == F.array_min(F.array_intersect("_others", "_p_others"))))
    columns = ["grp", "member", "partner", *own]
    return alone.select(*columns), few.select(*columns).unionByName(again.select(*columns))


def _subsets(groups: Column) -> Column:
    """All subsets of two groups and more, each in order."""
    nothing = F.array(F.array().cast("array<struct<grp:string,leads:boolean,kind:string>>"))
    found = F.aggregate(groups, nothing, lambda done, g: F.concat(done, F.transform(done, lambda s: F.array_append(s, g))))
    return F.filter(found, lambda s: F.size(s) > 1)


def _held(members: DataFrame) -> DataFrame:
    """Memberships in groups of two members and more, with the number of later members."""
    narrow = with_defaults(members).select("grp", "member", "ord", "leads", "kind")
    return cut(later_members(narrow).where("group_size > 1"), "held")


def shared_sets(held: DataFrame, *, degree: int = DEGREE, most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Sets of groups that share members, and the wide members.

    The first frame has a row per (set, member that is in all its groups): key, level (groups in the set), member, ord, leads (whether the
    member leads all of them), kind (null if they differ), wide. All sets of a member that is not wide are there, whose groups two by two have two
    members in common. ``held`` are memberships in groups of two members and more.
    """
    rows = held.select("grp", "member", "ord", "leads", "kind")
    degrees = rows.groupBy("member").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    of_many = cut(degrees.where(F.col("_n") > degree).select("member"), "many-groups")
    group = F.struct("grp", "leads", "kind")
    profiles = cut(rows.join(degrees.where(F.col("_n") <= degree).select("member"), "member").groupBy("member").agg(
        F.min("ord").alias("ord"), F.sort_array(F.collect_list(group)).alias("_groups"),
    ), "group-lists")
    later = lambda groups, g: F.filter(groups, lambda h: h["grp"] > g["grp"])
    # Pairs of groups are told apart by a hash here; a collision only looks at more sets.
    hashes = F.flatten(F.transform("_groups", lambda g: F.transform(later(F.col("_groups"), g), lambda h: F.xxhash64(g["grp"], h["grp"]))))
    often = profiles.select(F.explode(hashes).alias("_both")).groupBy("_both").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_both")
    one = profiles.select("member", "ord", "_groups", F.explode("_groups").alias("g"))
    two = one.select("member", "ord", "g", F.explode(later(F.col("_groups"), F.col("g"))).alias("h")).withColumn("_both", F.xxhash64("g.grp", "h.grp"))
    many = cut(rows.join(of_many, "member", "left_semi").select("grp", "member"), "groups-of-many")
    seen = two.select("_both", F.col("g.grp").alias("grp"), F.col("h.grp").alias("_h")).join(many, "grp")
    seen = seen.select("_both", "member", F.col("_h").alias("grp")).join(many, ["grp", "member"], "left_semi").select("_both")
    shared = two.join(cut(often.union(seen).distinct(), "shared-pairs"), "_both", "left_semi")
    own = shared.groupBy("member").agg(F.min("ord").alias("ord"), F.sort_array(F.array_distinct(F.concat(F.collect_list("g"), F.collect_list("h")))).alias("_groups"))
    own = cut(own, "shared-groups")
    wide = of_many.union(own.where(F.size("_groups") > most_shared).select("member"))
    sets = own.where(F.size("_groups") <= most_shared).select("member", "ord", F.explode(_subsets(F.col("_groups"))).alias("_set"))
    kinds = F.array_distinct(F.transform("_set", lambda g: g["kind"]))
    narrow = cut(sets.select(
        F.transform("_set", lambda g: g["grp"]).alias("key"), F.size("_set").alias("level"), "member", "ord",
        F.forall("_set", lambda g: g["leads"]).alias("leads"), F.when(F.size(kinds) == 1, F.get(kinds, F.lit(0))).alias("kind"), F.lit(False).alias("wide"),
    ), "shared-sets")
    wide = cut(wide, "wide-members")
    wide_rows = rows.join(wide, "member", "left_semi").select("grp", "member", "ord", "leads")
    # Wide members of a set are looked for in that of its groups which has the fewest of them.
    few = wide_rows.groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    ends = narrow.select("key", "level", "kind").distinct().withColumn("grp", F.explode("key")).join(few, "grp")
    rarest = ends.groupBy("key", "level", "kind").agg(F.min_by("grp", "_n").alias("grp"), F.count(F.lit(1)).alias("_of")).where("_of = level")
    maybe = rarest.join(wide_rows.select("grp", "member"), "grp").select("key", "level", "kind", "member", F.explode("key").alias("grp"))
    inside = maybe.join(wide_rows, ["grp", "member"]).groupBy("key", "level", "kind", "member").agg(
        F.min("ord").alias("ord"), F.every("leads").alias("leads"), F.count(F.lit(1)).alias("_of"),
    ).where("_of = level").drop("_of")
    return cut(narrow.unionByName(inside.withColumn("wide", F.lit(True))), "all-sets"), wide


def _bits_before(bits: Column, at: Column) -> Column:
    """Set bits of a bitmap below a position."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    low = byte.bitwiseAND(F.expr("shiftleft(1, CAST(`_at` % 8 AS INT)) - 1"))
    return F.bitmap_count(F.substring(bits, F.lit(1), F.floor(at / 8).cast("int"))) + F.bit_count(low)


def bitmap_partners(held: DataFrame, wide: DataFrame) -> DataFrame:
    """Distinct later partners of the wide members, per kind and (kind null) over all kinds: (member, kind, partners).

    Members are numbered from the last on, so later ones have smaller numbers. Each group has a bitmap for each stretch of 32,768 numbers
    that it has a member in; a wide member takes the union of its groups' bitmaps up to its own number.
    """
    led = held.where("leads").join(wide, "member", "left_semi").select("grp", "member", "kind")
    rows = held.join(led.select("grp").distinct(), "grp", "left_semi").select("grp", "member", "ord")
    everyone = later_members(rows.select(F.lit("").alias("grp"), "member", "ord").distinct())
    places = cut(everyone.select("member", F.col("later_members").alias("_place")), "member-places")
    stretch, bit = F.floor(F.col("_place") / BITS), F.pmod("_place", F.lit(BITS))
    bitmaps = rows.join(places, "member").groupBy("grp", stretch.alias("_stretch")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    mine = led.join(places.withColumnsRenamed({"_place": "_own"}), "member")
    met = mine.join(bitmaps, "grp").where(F.col("_stretch") <= F.floor(F.col("_own") / BITS))
    by_kind = cut(met.groupBy("member", "kind", "_own", "_stretch").agg(F.bitmap_or_agg("_bits").alias("_bits")), "partner-bitmaps")
    over_all = by_kind.groupBy("member", "_own", "_stretch").agg(F.bitmap_or_agg("_bits").alias("_bits")).withColumn("kind", F.lit(None).cast("string"))
    counted = by_kind.unionByName(over_all).withColumn("_at", F.pmod("_own", F.lit(BITS)))
    whole = F.col("_stretch") < F.floor(F.col("_own") / BITS)
    n = F.when(whole, F.bitmap_count("_bits")).otherwise(_bits_before(F.col("_bits"), F.col("_at")))
    return counted.groupBy("member", "kind").agg(F.sum(n).cast("bigint").alias("partners"))


def _comes_after(a: Column, b: Column) -> Column:
    return (b["ord"] > a["ord"]) | ((b["ord"] == a["ord"]) & (b["member"] < a["member"]))


def _listed_pairs(few: DataFrame) -> DataFrame:
    """Pairs of small groups, a row for each group that the first one leads: (first, second, kind)."""
    lists = few.groupBy("grp", "kind").agg(F.collect_list(F.struct("member", "ord", "leads")).alias("_all")).where(F.size("_all") > 1)
    firsts = lists.select("kind", "_all", F.explode("_all").alias("a")).where("a.leads")
    return firsts.select("kind", F.col("a.member").alias("first"), F.explode(F.filter("_all", lambda b: _comes_after(F.col("a"), b))).alias("b")).select(
        "first", F.col("b.member").alias("second"), "kind",
    )


def _also_far(few: DataFrame, far: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of small groups that share large ones: their kinds of small groups (first, second, kind), and a row for each large one (first, second, far_kind)."""
    ends = far.select("member").distinct()
    listed = cut(_listed_pairs(few.join(ends, "member", "left_semi")).distinct(), "listed-of-far")
    met = listed.select("first", "second").distinct().join(far.where("leads").select(F.col("member").alias("first"), "grp", F.col("kind").alias("far_kind")), "first")
    met = met.join(far.select(F.col("member").alias("second"), "grp"), ["second", "grp"]).select("first", "second", "far_kind")
    return listed, cut(met, "met-far")


def partner_counts(members: DataFrame, *, degree: int = DEGREE, most_shared: int = MOST_SHARED, small: int = SMALL) -> DataFrame:
    """Per member, and per kind of group or (kind null) over all kinds: distinct partners it is first with, and the sum of those pairs' strengths.

    Members that are first in no pair have no row.
    """
    held = _held(members)
    few, far = held.where(F.col("group_size") <= small), held.where(F.col("group_size") > small)
    sets, wide = shared_sets(far, degree=degree, most_shared=most_shared)
    ranked = rows_after(sets, "key", "ord", "after").where("leads AND NOT wide")
    sign = F.when(F.col("level") % 2 == 1, F.col("after")).otherwise(-F.col("after"))
    led = far.where("leads").join(wide.withColumn("_wide", F.lit(True)), "member", "left")
    # Strengths sum over groups for all; partners in large groups likewise for those that are not wide, less what sets of groups count twice.
    once = F.when(F.col("_wide").isNull(), F.col("later_members")).otherwise(0).cast("bigint")
    zero, no_kind = F.lit(0).cast("bigint"), F.lit(None).cast("string").alias("kind")
    parts = led.select("member", "kind", once.alias("partners"), zero.alias("strength"))
    strengths = held.where("leads").select("member", "kind", zero.alias("partners"), F.col("later_members").cast("bigint").alias("strength"))
    parts = parts.unionByName(strengths)
    within = ranked.where("kind IS NOT NULL").select("member", "kind", sign.alias("partners"), zero.alias("strength"))
    across = ranked.select("member", no_kind, sign.alias("partners"), zero.alias("strength"))
    # Listed pairs are dealt by their first member once for all sums.
    pairs = _listed_pairs(few).repartition("first").distinct()
    pairs = pairs.select("first", "second", F.explode(F.array("kind", no_kind)).alias("kind")).distinct()
    near = pairs.groupBy(F.col("first").alias("member"), "kind").agg(F.count(F.lit(1)).alias("partners")).withColumn("strength", zero)
    listed, met = _also_far(few, far)
    twice = listed.join(met.withColumnRenamed("far_kind", "kind").distinct(), ["first", "second", "kind"]).select("first", "kind")
    twice = twice.unionByName(met.select("first", "second").distinct().select("first", no_kind))
    twice = twice.select(F.col("first").alias("member"), "kind", F.lit(-1).cast("bigint").alias("partners"), zero.alias("strength"))
    found = parts.unionByName(within).unionByName(parts.select("member", no_kind, "partners", "strength")).unionByName(across)
    if not wide.isEmpty():
        found = found.unionByName(bitmap_partners(far, wide).withColumn("strength", zero))
    found = found.unionByName(near).unionByName(twice)
    return found.groupBy("member", "kind").agg(F.sum("partners").alias("partners"), F.sum("strength").alias("strength")).where("partners > 0")


def rows_after(df: DataFrame, key: str, order: str, out: str) -> DataFrame:
    """Number of rows of the same key with a larger ``order``.

    A plain rank would sort a hot key in one task. Instead rows are bucketed by value ranges taken from a bounded
    hash sample, ranked inside (key, bucket), and lifted by the sizes of the later buckets.
    """
    sample = df.select(order).distinct().orderBy(F.xxhash64(order)).limit(RANGE_BUCKETS - 1)
    bounds = sample.agg(F.sort_array(F.collect_list(order)).alias("bounds")).scalar()
    bucket = F.size(F.filter("_bounds", lambda b: b < F.col(order)))
    bucketed = df.withColumn("_bounds", bounds).withColumn("_bucket", bucket).drop("_bounds")
    later = Window.partitionBy(key).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    lifts = (
        bucketed.groupBy(key, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_lift", F.coalesce(F.sum("_n").over(later), F.lit(0)))
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(F.desc(order))) - 1
    return (
        bucketed.withColumn("_inside", inside)
        .join(lifts, [key, "_bucket"])
        .withColumn(out, (F.col("_inside") + F.col("_lift")).cast("bigint"))
        .drop("_bucket", "_inside", "_lift")
    )


def first_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows in a total order, found without a task that merges k rows of each partition.

    Rows are dealt by ranges of the order. Ranges before the one in which the k-th row is are taken whole, and of that one its first rows.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_range", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).where(F.col("_before") < k)
    kept = ranged.join(starts, "_range")
    whole = kept.where(F.col("_before") + F.col("_n") <= k)
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    border = kept.where(F.col("_before") + F.col("_n") > k).withColumn("_place", place).where(F.col("_before") + F.col("_place") <= k)
    return whole.unionByName(border.drop("_place")).drop("_range", "_n", "_before")


def _first_lows(rows: DataFrame, k: int) -> DataFrame:
    """Per level the largest member that can be the lower end of one of the first k pairs by (low, high): (level, _most).

    ``rows`` has key, level, member and after, the number of pairs of the set with the member as lower end at least. The most of any one set
    is a lower bound for the member's pairs, so members up to the one at which the bounds reach k have k pairs among them.
    """
    ends = rows.groupBy("level", "member").agg(F.max("after").alias("_n"))
    ranged = cut(ends.repartitionByRange("level", "member").withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("level").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a level and range
    sums = ranged.groupBy("level", "_range").agg(F.sum("_n").alias("_sum"))
    sums = sums.select("level", "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")).where(F.col("_before") < k)
    running = F.sum("_n").over(Window.partitionBy("level", "_range").orderBy("member").rowsBetween(Window.unboundedPreceding, -1))
    reached = ranged.join(sums, ["level", "_range"]).withColumn("_run", F.coalesce(running, F.lit(0)) + F.col("_before"))
    return reached.where(F.col("_run") < k).groupBy("level").agg(F.max("member").alias("_most"))


def _rank_inside(few: DataFrame) -> DataFrame:
    """Leading members of small groups with the number of leading ones after them by id, as rows of level 1."""
    lists = few.where("leads").groupBy("grp").agg(F.collect_list("member").alias("_all"))
    each = lists.select("_all", F.explode("_all").alias("member"))
    return each.select(F.lit(1).alias("level"), "member", F.size(F.filter("_all", lambda m: m > F.col("member"))).cast("bigint").alias("after"))


def top_pairs(members: DataFrame, k: int, *, degree: int = DEGREE, most_shared: int = MOST_SHARED, small: int = SMALL) -> DataFrame:
    """The ``k`` strongest pairs (low, high, strength), the strength within one kind of group, ties by ids.

    Pairs of small groups are listed. In large ones a pair of strength s is in a set of s groups; at each level only members up to a bound can be the
    lower end of one of the first k pairs, and only those are paired up, so the rows are about k times the groups of a member whatever the
    size of the groups. Pairs of two wide members are the exception: they are counted group by group. A pair of both sorts
    of groups counts with all of them in the first list, which no count of its large groups alone exceeds.
    """
    held = _held(members)
    few, far = held.where(F.col("group_size") <= small), held.where(F.col("group_size") > small)
    sets, wide = shared_sets(far, degree=degree, most_shared=most_shared)
    columns = ["key", "level", "member", "ord", "leads"]
    levels = cut(sets.where("kind IS NOT NULL").select(*columns).unionByName(far.select(F.array("grp").alias("key"), F.lit(1).alias("level"), *columns[2:])), "levels")
    # Any two members that lead a set are a pair; those are enough for the bound.
    after = rows_after(levels.where("leads"), "key", "member", "after").select("level", "member", "after")
    bounds = cut(_first_lows(after.unionByName(_rank_inside(few)), k), "first-lows")
    lows = levels.join(bounds, "level", "left").where(F.col("_most").isNull() | (F.col("member") <= F.col("_most")))
    low = lows.select("key", "level", F.col("member").alias("low"), F.col("ord").alias("_low_ord"), F.col("leads").alias("_low_leads"))
    high = levels.select("key", F.col("member").alias("high"), F.col("ord").alias("_high_ord"), F.col("leads").alias("_high_leads"))
    first_leads = F.when(F.col("_low_ord") < F.col("_high_ord"), F.col("_low_leads")).otherwise(F.col("_high_leads"))
    distant = low.join(high, "key").where((F.col("low") < F.col("high")) & first_leads).select("low", "high", F.col("level").cast("bigint").alias("strength"))
    of_wide = far.join(wide, "member", "left_semi")
    a = of_wide.select("grp", "kind", F.col("member").alias("low"), F.col("ord").alias("_low_ord"), F.col("leads").alias("_low_leads"))
    b = of_wide.select("grp", F.col("member").alias("high"), F.col("ord").alias("_high_ord"), F.col("leads").alias("_high_leads"))
    dense = a.join(b, "grp").where((F.col("low") < F.col("high")) & first_leads).groupBy("low", "high", "kind").agg(F.count(F.lit(1)).alias("strength")).drop("kind")
    low_first = [F.least("first", "second").alias("low"), F.greatest("first", "second").alias("high"), "kind"]
    met = _also_far(few, far)[1].withColumnRenamed("far_kind", "kind")
    near = _listed_pairs(few).select(*low_first).unionByName(met.select(*low_first)).repartition("low", "high")
    near = near.groupBy("low", "high", "kind").agg(F.count(F.lit(1)).alias("strength")).groupBy("low", "high").agg(F.max("strength").alias("strength"))
    # Up to the bound of level 1 there are k pairs, so a pair of one group behind it is none of the first k.
    bound = bounds.where("level = 1").agg(F.max("_most").alias("_most")).scalar()
    near = near.where((F.col("strength") > 1) | bound.isNull() | (F.col("low") <= bound))
    best = near.unionByName(distant).unionByName(dense).groupBy("low", "high").agg(F.max("strength").alias("strength"))
    return first_rows(best, [F.desc("strength"), F.col("low"), F.col("high")], k)


def meetings(members: DataFrame, chosen: DataFrame) -> DataFrame:
    """The groups through which chosen pairs (low, high) are pairs: one row for each."""
    rows = with_defaults(members).select("grp", "kind", "label", "member", "ord", "leads")
    one = chosen.select("low", "high").join(rows.withColumnsRenamed({"member": "low", "ord": "_low_ord", "leads": "_low_leads"}), "low")
    other = rows.select("grp", F.col("member").alias("high"), F.col("ord").alias("_high_ord"), F.col("leads").alias("_high_leads"))
    first_leads = F.when(F.col("_low_ord") < F.col("_high_ord"), F.col("_low_leads")).otherwise(F.col("_high_leads"))
    return one.join(other, ["grp", "high"]).where(first_leads).select("low", "high", "grp", "kind", "label")


def later_members(members: DataFrame) -> DataFrame:
    """members with ``group_size`` and ``later_members``, the number of members of the group with a larger ``ord``.

    Rows are dealt by ranges of (grp, ord), so a large group fills many ranges. Each range is numbered by itself; what is in later ranges
    is one number per group and range.
    """
    rows = with_defaults(members)
    ranged = cut(rows.repartitionByRange("grp", "ord").withColumn("_range", F.spark_partition_id()), "ranges")
    parts = Window.partitionBy("grp")
    behind = parts.orderBy("_range").rowsBetween(1, Window.unboundedFollowing)
    sizes = ranged.groupBy("grp", "_range").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("grp", "_range", F.sum("_n").over(parts).alias("group_size"), F.coalesce(F.sum("_n").over(behind), F.lit(0)).alias("_behind"))
    own = Window.partitionBy("grp", "_range").orderBy(F.col("ord").desc())
    found = ranged.withColumn("_own", F.row_number().over(own) - 1).join(sizes, ["grp", "_range"])
    return found.withColumn("later_members", F.col("_own") + F.col("_behind")).drop("_own", "_behind", "_range")


def pairs_of(members: DataFrame, focus: DataFrame, *, small: int = SMALL) -> DataFrame:
    """Every pair of the members in ``focus``, hub partners included: one row per (focus member, partner).

    Pairs that share one large group only are streamed out of a join, as in ``all_pairs``.
    """
    members = with_defaults(members)
    mine = members.join(focus.select("member").distinct(), "member", "left_semi")
    met = ((F.col("_ord") < F.col("_p_ord")) & F.col("_leads")) | ((F.col("_p_ord") < F.col("_ord")) & F.col("_p_leads"))
    alone, several = _met(members, mine, met, [], small)
    counted = several.groupBy("member", "partner").agg(F.count(F.lit(1)).alias("strength"))
    return alone.select("member", "partner", F.lit(1).cast("bigint").alias("strength")).unionByName(counted)
