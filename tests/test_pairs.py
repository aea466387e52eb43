"""Pair operators against brute force, with hub sizes small enough that every route is taken."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from agorakit.operators import pairs


def _memberships(seed, with_followers):
    rng = random.Random(seed)
    rows = {}
    for member in range(40):
        for group in rng.sample(range(12), rng.choice([1, 1, 2, 3, 5])):
            hot = rng.random() < 0.4
            rows[(f"g{0 if hot else group}", member)] = not with_followers or rng.random() < 0.85
    order = list(range(40))
    rng.shuffle(order)
    return [(g, m, f"n{order[m]:03d}", leads) for (g, m), leads in rows.items()]


def _brute(rows):
    groups = {}
    for g, m, o, leads in rows:
        groups.setdefault(g, []).append((o, m, leads))
    strength = {}
    for found in groups.values():
        for a, b in combinations(sorted(found), 2):
            if a[2]:
                strength[(a[1], b[1])] = strength.get((a[1], b[1]), 0) + 1
    return strength


#: Usual limits; every member with a shared group is wide; every member with two groups is wide.
LIMITS = [{"degree": 64, "most_shared": 6}, {"degree": 64, "most_shared": 1}, {"degree": 1, "most_shared": 1}, {"degree": 3, "most_shared": 2}]


@pytest.mark.parametrize("seed,followers", [(1, False), (2, True)])
@pytest.mark.parametrize("limits", LIMITS)
def test_pairs_match_brute_force(spark, seed, followers, limits):
    rows = _memberships(seed, followers)
    members = spark.createDataFrame(rows, "grp string, member bigint, ord string, leads boolean")
    expected = _brute(rows)
    listed = {(r.first, r.second): r.strength for r in pairs.all_pairs(members).collect()}
    assert listed == expected

    counted = [r for r in pairs.partner_counts(members, **limits).collect() if r.kind is None]
    want_counts, want_sums = {}, {}
    for (a, _), s in expected.items():
        want_counts[a] = want_counts.get(a, 0) + 1
        want_sums[a] = want_sums.get(a, 0) + s
    assert {r.member: r.partners for r in counted} == want_counts and {r.member: r.strength for r in counted} == want_sums

    best = sorted((-s, min(p), max(p)) for p, s in expected.items())
    for k in (1, 50, 5000):
        got = pairs.top_pairs(members, k, **limits).collect()
        assert sorted((-r.strength, r.low, r.high) for r in got) == best[:k]

    focus = spark.createDataFrame([(3,), (17,)], "member bigint")
    got = {(r.member, r.partner): r.strength for r in pairs.pairs_of(members, focus).collect()}
    assert got == {
        (f, b if a == f else a): s for (a, b), s in expected.items() for f in (3, 17) if f in (a, b)
    }


@pytest.mark.parametrize("small,limits", [(0, LIMITS[0]), (8, LIMITS[2])])
def test_pairs_of_small_and_large_groups(spark, monkeypatch, small, limits):
    """Whatever counts as a small group, and in blocks, all operators find the same pairs in groups of 2 to 30 members of two kinds."""
    monkeypatch.setattr(pairs, "BLOCK", 5)
    rows = [(f"{m % 2 if g != 'g0' else 0}/{g}", m, o, leads) for g, m, o, leads in _memberships(4, True)]
    members = spark.createDataFrame(rows, "grp string, member bigint, ord string, leads boolean").withColumn("kind", F.substring("grp", 1, 1)).withColumn("label", F.col("grp"))
    expected = _brute(rows)
    groups = {}
    for g, m, _, leads in rows:
        groups.setdefault(m, {})[g] = leads
    found = pairs.all_pairs(members, own=["ord"], small=small).collect()
    assert len(found) == len(expected) and {(r.first, r.second): r.strength for r in found} == expected
    for r in found:
        assert r.labels == sorted(g for g, leads in groups[r.first].items() if leads and g in groups[r.second])
        assert r.ord == next(o for _, m, o, _ in rows if m == r.first)
    focus = spark.createDataFrame([(3,), (17,)], "member bigint")
    met = pairs.pairs_of(members, focus, small=small).collect()
    want = {(f, b if a == f else a): s for (a, b), s in expected.items() for f in (3, 17) if f in (a, b)}
    assert len(met) == len(want) and {(r.member, r.partner): r.strength for r in met} == want

    by_kind = {k: _brute([r for r in rows if r[0].startswith(k)]) for k in "01"} | {None: expected}
    want = {}
    for kind, strengths in by_kind.items():
        for (a, _), s in strengths.items():
            n, total = want.get((a, kind), (0, 0))
            want[a, kind] = (n + 1, total + s)
    counted = pairs.partner_counts(members, small=small, **limits).collect()
    assert {(r.member, r.kind): (r.partners, r.strength) for r in counted} == want
    strongest = {}
    for kind in "01":
        for p, s in by_kind[kind].items():
            strongest[tuple(sorted(p))] = max(s, strongest.get(tuple(sorted(p)), 0))
    best = sorted((-s, *p) for p, s in strongest.items())
    for k in (5, 5000):
        got = pairs.top_pairs(members, k, small=small, **limits).collect()
        assert sorted((-r.strength, r.low, r.high) for r in got) == best[:k]


def test_a_large_group_meets_without_a_shuffle_of_pairs(spark):
    """2,000 members of one group, a few of which share a second one: all other pairs come from a join with no exchange above it."""
    n = 2_000
    members = spark.range(n).selectExpr("'g' AS grp", "id AS member").union(spark.range(0, n, 500).selectExpr("'h' AS grp", "id AS member"))
    alone, several = pairs._met(members.withColumns({"ord": F.col("member"), "leads": F.lit(True)}), members.withColumns({"ord": F.col("member"), "leads": F.lit(True)}), F.col("_ord") < F.col("_p_ord"), [], 64)
    assert alone.count() == n * (n - 1) // 2 - 6 and several.count() == 12
    assert pairs.all_pairs(members).where("strength = 2").count() == 6


def test_blocks_of_a_group_meet_each_other(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 7)
    rows = _memberships(3, True)
    members = spark.createDataFrame(rows, "grp string, member bigint, ord string, leads boolean")
    assert {(r.first, r.second): r.strength for r in pairs.all_pairs(members).collect()} == _brute(rows)


def test_bitmaps_over_many_stretches(spark, monkeypatch):
    """Members 1, 2 and 70,000 are wide: their groups reach over three stretches of member numbers."""
    rows = [("a", i) for i in range(0, 80_000, 2)] + [("b", i) for i in range(0, 80_000, 3)] + [("c", i) for i in (1, 2, 70_000, 79_999)]
    members = spark.createDataFrame(rows, "grp string, member bigint").withColumn("ord", F.format_string("%06d", F.col("member")))
    held = pairs.later_members(pairs.with_defaults(members))
    wide = spark.createDataFrame([(1,), (2,), (70_000,)], "member bigint")
    got = {r.member: r.partners for r in pairs.bitmap_partners(held, wide).collect() if r.kind is None}
    groups = {g: {m for h, m in rows if h == g} for g in "abc"}
    assert got == {m: len({x for s in groups.values() if m in s for x in s if x > m}) for m in (1, 2, 70_000)}


def test_a_large_group_of_followers_lists_no_pair(spark):
    """20,000 members of one group, half of which may not come first; a few share a second one."""
    n = 20_000
    members = spark.range(n).selectExpr("'g' AS grp", "id AS member", "format_string('%05d', id) AS ord", "id % 2 = 0 AS leads")
    second = spark.range(0, n, 1000).selectExpr("'h' AS grp", "id AS member", "format_string('%05d', id) AS ord", "true AS leads")
    found = pairs.partner_counts(members.union(second))
    counted = {r.member: (r.partners, r.strength) for r in found.where("kind IS NULL").collect()}
    assert counted == {i: (n - 1 - i, n - 1 - i + (19 - i // 1000 if i % 1000 == 0 else 0)) for i in range(0, n - 1, 2)}
    top = pairs.top_pairs(members.union(second), 200)
    rows = sorted((-r.strength, r.low, r.high) for r in top.collect())
    twice = [(-2, a, b) for a in range(0, n, 1000) for b in range(a + 1000, n, 1000)]
    assert rows == (twice + [(-1, 0, b) for b in range(1, n) if b % 1000])[:200]


def test_first_rows_in_a_total_order(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).repartition(6)
    want = sorted((-(i % 7), i) for i in range(5000))
    for k in (1, 700, 1000, 5000, 9999):
        got = sorted((-r.a, r.b) for r in pairs.first_rows(df, [F.desc("a"), F.col("b")], k).collect())
        assert got == want[:k]
    assert pairs.first_rows(df.where("false"), [F.col("b")], 5).count() == 0


def test_rows_after_is_a_reverse_rank(spark):
    df = spark.range(500).select(F.lit("k").alias("key"), F.col("id").alias("ord"))
    got = {r.ord: r.after for r in pairs.rows_after(df, "key", "ord", "after").collect()}
    assert got == {i: 499 - i for i in range(500)}


@pytest.mark.parametrize("limits", LIMITS[:3])
def test_summaries_over_two_relationship_types(spark, limits):
    """Pairs may meet in groups of either kind or of both."""
    from agorakit.operators import networks

    kinds = {"WORKED_TOGETHER": 5, "STUDIED_TOGETHER": 6}
    rng = random.Random(9)
    order = {m: f"n{rng.random():.6f}" for m in range(40)}
    strengths, found = {}, []
    for kind, seed in kinds.items():
        rows = [(f"{kind}/{g}", m, order[m], leads) for g, m, _, leads in _memberships(seed, False)]
        for pair, s in _brute(rows).items():
            strengths[(kind, *pair)] = s
        found += [(kind, *r) for r in rows]
    members = spark.createDataFrame(found, "kind string, grp string, member long, ord string, leads boolean").withColumn("label", F.col("grp"))

    people = spark.range(40).select(
        F.col("id").alias("user_id"), *[F.lit("x").alias(c) for c in ("email", "first_name", "last_name")],
        F.lit(None).cast("timestamp").alias("deleted_at"),
    )
    found = {r.user_id: r for r in networks.top_connected(people, members, **limits).collect()}
    summary = {r.user_id: r for r in networks.connection_summary(members, **limits).collect()}
    for user in range(40):
        mine = {(k, b): s for (k, a, b), s in strengths.items() if a == user}
        assert found[user].connection_count == len({b for _, b in mine})
        if mine:
            assert found[user].avg_connection_strength == pytest.approx(sum(mine.values()) / len(mine))
            assert summary[user].total_connections == len(mine)
            assert summary[user].work_connections == sum(k == "WORKED_TOGETHER" for k, _ in mine)

    best = {}
    for (kind, a, b), s in strengths.items():
        key = (min(a, b), max(a, b))
        top, worked = best.get(key, (0, False))
        best[key] = (max(top, s), worked or kind == "WORKED_TOGETHER")
    want = sorted((-10.0 * s, a, b, worked) for (a, b), (s, worked) in best.items())
    for k in (20, 400):
        got = networks.connection_recommendations(members, k=k, **limits)
        rows = sorted((-r.recommendation_score, r.user_id, r.recommended_user_id, r.recommendation_reason == networks.REASON_WORKED) for r in got.collect())
        assert rows == want[:k]
    named = networks.recommendation_context(got, members).collect()
    groups = {}
    for r in members.collect():
        groups.setdefault(r.member, set()).add(r.grp)
    for r in named:
        both = groups[r.user_id] & groups[r.recommended_user_id]
        assert r.common_companies == sorted(g for g in both if g.startswith("WORKED")) and r.common_schools == sorted(g for g in both if g.startswith("STUDIED"))


def test_large_groups_in_row_form(spark):
    sizes = {"a": 999, "b": 1_000, "c": 1_001, "d": 5_000}
    rows = [(g, f"{i:05d}") for g, n in sizes.items() for i in range(n)]
    members = spark.createDataFrame(rows, "grp string, member string")
    found = pairs.later_members(members).collect()
    assert len(found) == len(rows) and all(r.group_size == sizes[r.grp] and r.later_members == sizes[r.grp] - 1 - int(r.member) for r in found)
