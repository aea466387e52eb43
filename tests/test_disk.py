"""What queries leave on disk while they run: no shuffle files of stored tables, no stored graph, rows of companies and roles dealt out once."""

import random
import time

import pytest
from pyspark.sql import functions as F

from agorakit.operators import graph, networks, pairs
from agorakit.plans import inputs
from agorakit.plans.catalog import queries
from agorakit.session import CLEANUP_KEY, cut


def _recorded(monkeypatch, module):
    stored = []
    monkeypatch.setattr(module, "cut", lambda df, label="stored": stored.append((label, df)) or cut(df, label))
    return stored


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_of_a_stored_table_go(spark):
    before = _shuffle_files(spark)
    kept = cut(spark.range(1000).repartition(3).groupBy((F.col("id") % 100).alias("k")).count())
    for _ in range(40):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.25)
    assert not left and kept.count() == 100
    assert spark.conf.get(CLEANUP_KEY, None) != "true"  # queries outside keep theirs, as they may be read again


def test_networks_store_no_edges_and_kinds_apart(spark, sf_dir, monkeypatch):
    stored, of_graph = _recorded(monkeypatch, inputs), _recorded(monkeypatch, graph)
    i = inputs.Inputs(spark, sf_dir)
    i.company_rows, i.school_members, i.location_members  # noqa: B018
    assert "graph-nodes" not in {label for label, _ in stored}
    i.relationship_members  # noqa: B018
    queries()["n2_listed_pairs"](spark, sf_dir)
    assert "graph-edges" not in {label for label, _ in stored}
    assert [label for label, _ in of_graph].count("relationship-members") == 2


def _people(seed):
    """Users with up to nine companies and five roles, rows that come twice, and missing names and roles."""
    rng = random.Random(seed)
    staff = []
    for user in range(30):
        firms, jobs = rng.sample(range(14), rng.choice([1, 3, 9])), rng.sample(range(8), rng.choice([0, 2, 5]))
        for c in firms:
            for r in jobs or [None]:
                row = (f"c{c}", None if c == 5 else f"C{c % 12}", None if r is None else f"r{r}", None if r in (None, 3) else f"R{r % 7}", user)
                staff += [row] * rng.choice([1, 1, 2])
    return staff, [(f"s{rng.randrange(4)}", "S", rng.choice([None, "d"]), rng.choice([None, "D"]), user, 2000 + user % 3) for user in range(30) for _ in range(2)]


COMPANIES = "company_id string, company_name string, role_id string, role_title string, user_id long"


@pytest.mark.parametrize("by_count", [False, True])
def test_first_names_of_users_give_those_of_groups(spark, monkeypatch, by_count):
    staff, schooled = _people(7)
    companies = spark.createDataFrame(staff, COMPANIES)
    members = spark.createDataFrame(schooled, "school_id string, school_name string, degree_id string, degree_name string, user_id long, graduation_year long").distinct()
    stored, met = _recorded(monkeypatch, networks), []
    leading = networks._leading_names
    monkeypatch.setattr(networks, "_leading_names", lambda rows, *a: met.append(rows) or leading(rows, *a))
    found = networks.alumni_networks(members, companies, 3, by_count=by_count).collect()
    sizes = {}
    for row in set(staff):
        sizes.setdefault(row[:4], set()).add(row[4])
    for r in found:
        users = {s[4] for s in schooled if (s[0], s[2] or "ALL", s[3]) == (r.school_id, r.degree_id, r.degree_name)}
        for column, names in ((1, r.current_companies), (3, r.current_roles)):
            most = {}
            for row in staff:
                if row[4] in users and row[column] is not None:
                    most[row[column]] = max(most.get(row[column], 0), len(sizes[row[:4]]))
            first = sorted(most, key=lambda x: (-most[x], x) if by_count else x)[:3]
            assert (names or []) == sorted(first, key=lambda x: (-most[x], x))
    assert {(r.school_id, r.degree_id, r.degree_name, r.user_id) for r in found} == {(s[0], s[2] or "ALL", s[3], s[4]) for s in schooled}
    # A user brings three names to each of its groups at most, and rows are dealt by (company, role) once for distinct rows and sizes.
    assert all(rows.groupBy("_key", "user_id").count().where("count > 3").isEmpty() for rows in met)
    (dealt,) = [df for label, df in stored if label == "staff"]
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_talent_pools_of_repeated_rows(spark, monkeypatch):
    staff, _ = _people(8)
    stored = _recorded(monkeypatch, networks)
    found = sorted(map(tuple, networks.talent_pools(spark.createDataFrame(staff, COMPANIES)).collect()), key=str)
    want = []
    for firm in {row[:2] for row in staff}:
        mine = [row for row in staff if row[:2] == firm]
        n, ids = len({row[4] for row in mine}), len({row[2] for row in mine} - {None})
        want += [(*firm, n, title, ids) for title in {row[3] for row in mine} - {None} or {None}]
    assert found == sorted(want, key=str)
    assert [label for label, _ in stored] == ["staff-counts", "offered-roles", "role-counts"]  # none of them shuffles beside another


def test_skills_of_repeated_rows(spark, sf_dir, monkeypatch):
    staff, _ = _people(9)
    users = spark.range(30).selectExpr("id AS user_id", "TIMESTAMP '2000-01-01 00:00:00' AS signup_date", "1L AS experience_count", "50L AS profile_completion_score")
    found = networks.skills_matching(spark.createDataFrame(staff, COMPANIES), users, "2001-08-02 12:00:00", 40).collect()
    first = {}
    for c, _, r, title, user in staff:
        if r is not None:
            first[user, r] = min(first.get((user, r), (c, title)), (c, title))
    want = [(u, r, title, c, len({row[4] for row in staff if (row[0], row[2]) == (c, r)})) for (u, r), (c, title) in sorted(first.items())[:40]]
    assert sorted((x.user_id, x.role_id, x.role_title, x.company_id, x.similar_user_count) for x in found) == want
    stored = _recorded(monkeypatch, inputs)
    queries()["l3_skills_matching"](spark, sf_dir)
    assert "company-members" not in {label for label, _ in stored}


def test_blocks_of_a_large_group_are_many_tasks(spark, monkeypatch):
    """Ten blocks of a group of 100: their pairs come out of as many partitions as the session shuffles to, not out of one that fits the rows."""
    monkeypatch.setattr(pairs, "BLOCK", 10)
    members = pairs.with_defaults(spark.createDataFrame([("g", i) for i in range(100)], "grp string, member long"))
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        alone, _ = pairs._met(members, members, F.col("_ord") < F.col("_p_ord"), [], 64)
        tasks = alone.select(F.spark_partition_id().alias("p")).distinct().count()
        assert alone.count() == 100 * 99 // 2 and tasks > 3
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
