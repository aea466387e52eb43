"""Aggregates over relationships and group memberships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorakit.functions.exprs import clock, whole_years
from agorakit.operators import pairs
from agorakit.operators.graph import education_networks
from agorakit.session import cut
from agorakit.operators.lists import listed, null_safe_join

# Reasons, score factor, caps and constants of the published reports.
REASON_WORKED, REASON_STUDIED = "Worked at the same companies", "Studied at the same schools"
REASON_OTHER = "Have connections in common"
SCORE_PER_STRENGTH = 10
EXPERIENCE_YEARS_CAP, PROFICIENCY_CAP = 50, 999
YEARS_PER_ROLE = 2.5
PATH_SEPARATOR = " -> "
SHORT_LIST = 64
TOP_RECOMMENDATIONS, TOP_COMPANY_PAIRS, TOP_SKILLS, TOP_PATHS, TOP_USERS, TOP_NAMES = 100_000, 10_000, 50_000, 1_000, 100, 10


def connection_summary(members: DataFrame, **limits: int) -> DataFrame:
    """Connections per user by kind and their mean strength. A pair counts for its first user.

    ``members`` are the memberships behind all relationships; no pair is listed.
    """

    def of_type(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == name, F.col("partners"))), F.lit(0)).cast("bigint")

    total = F.sum("partners")
    counted = pairs.partner_counts(members, **limits).where(F.col("kind").isNotNull())
    return counted.groupBy(F.col("member").alias("user_id")).agg(
        total.alias("total_connections"),
        of_type("WORKED_TOGETHER").alias("work_connections"),
        of_type("STUDIED_TOGETHER").alias("school_connections"),
        of_type("SAME_LOCATION").alias("location_connections"),
        F.try_divide(F.sum("strength").cast("double"), total.cast("double")).alias("avg_connection_strength"),
    )


def top_connected(users: DataFrame, members: DataFrame, k: int = TOP_USERS, **limits: int) -> DataFrame:
    """Users with the most distinct related users; users without any count 0 and have no mean strength."""
    counted = pairs.partner_counts(members, **limits)
    of_all = F.col("kind").isNull()
    mine = counted.groupBy(F.col("member").alias("user_id")).agg(
        F.max(F.when(of_all, F.col("partners"))).alias("partners"),
        F.sum(F.when(~of_all, F.col("strength"))).alias("_strength"), F.sum(F.when(~of_all, F.col("partners"))).alias("_pairs"),
    )
    return (
        users.where(F.col("deleted_at").isNull())
        .select("user_id", "email", "first_name", "last_name")
        .join(mine, "user_id", "left")
        .select(
            "user_id", "email", "first_name", "last_name",
            F.coalesce("partners", F.lit(0)).cast("bigint").alias("connection_count"),
            F.try_divide(F.col("_strength").cast("double"), F.col("_pairs").cast("double")).alias("avg_connection_strength"),
        )
        .orderBy(F.desc("connection_count"), "user_id")
        .limit(k)
    )


def connection_recommendations(members: DataFrame, k: int = TOP_RECOMMENDATIONS, **limits: int) -> DataFrame:
    """The ``k`` best pairs by ten times their largest strength, with the reason of the leading relationship type.

    The published columns have no shared names; ``recommendation_context`` adds them.
    """
    chosen = cut(pairs.top_pairs(members, k, **limits), "chosen-pairs")
    worked, studied = (F.max(F.col("kind") == kind) for kind in ("WORKED_TOGETHER", "STUDIED_TOGETHER"))
    kinds = pairs.meetings(members, chosen).groupBy("low", "high").agg(worked.alias("worked"), studied.alias("studied"))
    return chosen.join(kinds, ["low", "high"]).select(
        F.col("low").alias("user_id"), F.col("high").alias("recommended_user_id"),
        (F.col("strength") * SCORE_PER_STRENGTH).cast("double").alias("recommendation_score"),
        F.when(F.col("worked"), REASON_WORKED).when(F.col("studied"), REASON_STUDIED).otherwise(REASON_OTHER)
        .alias("recommendation_reason"),
    )


def recommendation_context(recommendations: DataFrame, members: DataFrame) -> DataFrame:
    """Add the names of the companies and schools through which recommended users are related, in alphabetical order."""
    ends = recommendations.select(F.col("user_id").alias("low"), F.col("recommended_user_id").alias("high"))

    def names(kind: str, out: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("label")))).alias(out)

    context = pairs.meetings(members, ends).groupBy(F.col("low").alias("user_id"), F.col("high").alias("recommended_user_id")).agg(
        names("WORKED_TOGETHER", "common_companies"), names("STUDIED_TOGETHER", "common_schools"),
    )
    return recommendations.join(context, ["user_id", "recommended_user_id"], "left")


def _shared_staff(employment: DataFrame, top: DataFrame) -> DataFrame:
    """(low, high, user) rows for the chosen company pairs.

    At most 2k companies are left, so a user's own list of them is bounded. Short lists are paired up in the row and
    checked against the chosen pairs; the few users with long lists are looked up pair by pair instead.
    """
    ends = top.select(F.col("low").alias("company_id")).union(top.select(F.col("high").alias("company_id"))).distinct()
    staff = employment.join(ends, "company_id", "left_semi")
    per_user = staff.groupBy("user_id").agg(F.sort_array(F.collect_list("company_id")).alias("own")).where(F.size("own") > 1)
    short = (
        per_user.where(F.size("own") <= SHORT_LIST)
        .select("user_id", "own", F.explode("own").alias("low"))
        .select("user_id", "low", F.explode(F.filter("own", lambda c: c > F.col("low"))).alias("high"))
        .join(top, ["low", "high"], "left_semi")
    )
    long = per_user.where(F.size("own") > SHORT_LIST).select("user_id", "own", F.explode("own").alias("low"))
    looked_up = long.join(top, "low").where(F.array_contains("own", F.col("high"))).select("user_id", "low", "high")
    return short.unionByName(looked_up)


def company_network_map(members: DataFrame, k: int = TOP_COMPANY_PAIRS, **limits: int) -> DataFrame:
    """Company pairs with the most shared employees, one row for each of these.

    Companies of one employee pair up as users of one company do.
    """
    staffed = cut(members.select("company_id", "company_name", "user_id").distinct())  # once for all that follows; no role of a user is needed
    employment = staffed.select("company_id", "user_id").distinct()
    by_user = employment.select(F.col("user_id").cast("string").alias("grp"), F.col("company_id").alias("member"))
    top = cut(pairs.top_pairs(by_user, k, **limits))
    shared = _shared_staff(employment, top)
    staff = listed(shared, ["low", "high"], "user_id", "shared_employee_count")
    names = staffed.groupBy("company_id").agg(F.min("company_name").alias("name"))
    return (
        staff.join(names.select(F.col("company_id").alias("low"), F.col("name").alias("company_name_1")), "low")
        .join(names.select(F.col("company_id").alias("high"), F.col("name").alias("company_name_2")), "high")
        .select(
            F.col("low").alias("company_id_1"), F.col("high").alias("company_id_2"), "company_name_1", "company_name_2",
            "shared_employee_count", F.col("user_id").alias("employee_id"),
            F.col("shared_employee_count").cast("double").alias("network_strength_score"),
        )
    )


def skills_matching(
    members: DataFrame, users: DataFrame, as_of, k: int = TOP_SKILLS
) -> DataFrame:
    """One row per (user, role), the first ``k`` by ids, with the size of the user group that holds the role at one company.

    The company is the least one. Who is in the group is in ``company_networks`` under the same company and role. Rows of ``members`` may repeat: all that
    is taken of them is the least and the distinct.
    """
    roles = members.where(F.col("role_id").isNotNull())
    held = (
        roles.groupBy("user_id", "role_id")
        .agg(F.min(F.when(F.col("company_id").isNotNull(), F.struct("company_id", "role_title"))).alias("_group"))
        .join(users.select("user_id", "signup_date", "experience_count", "profile_completion_score"), "user_id")
    )
    picked = cut(pairs.first_rows(held, [F.col("user_id"), F.col("role_id")], k), "picked").select("*", "_group.company_id", "_group.role_title")
    wanted = picked.select("company_id", "role_id").distinct()
    # Other companies go first, before roles multiply the rows of theirs.
    held = roles.join(wanted.select("company_id").distinct(), "company_id", "left_semi").join(wanted, ["company_id", "role_id"], "left_semi")
    held = held.select("company_id", "role_id", "user_id").distinct()
    groups = held.groupBy("company_id", "role_id").agg(F.count(F.lit(1)).alias("similar_user_count"))
    years = whole_years(F.col("signup_date"), F.to_date(clock(as_of)).cast("timestamp"))
    proficiency = F.col("experience_count") * 10 + F.expr("profile_completion_score div 10")
    return picked.join(groups, ["company_id", "role_id"], "left").select(
        "user_id", "role_id", "role_title",
        F.least(years, F.lit(EXPERIENCE_YEARS_CAP)).cast("double").alias("experience_years"),
        F.least(proficiency, F.lit(PROFICIENCY_CAP)).cast("double").alias("proficiency_score"),
        "company_id", "similar_user_count",
    )


def career_path_patterns(members: DataFrame, k: int = TOP_PATHS, min_users: int = 2) -> DataFrame:
    """Role sets of the companies with the most users, role titles in alphabetical order, one row for each user.

    Companies are ranked by their counts first; titles are then put together for the ``k`` kept only.
    """
    titled = members.where(F.col("role_title").isNotNull()).select("company_id", "role_title", "user_id")
    top = (
        titled.select("company_id", "user_id").distinct()
        .groupBy("company_id").agg(F.count(F.lit(1)).alias("_users"))
        .where(F.col("_users") >= min_users)
        .orderBy(F.desc("_users"), "company_id")
        .limit(k)
        .drop("_users")
    )
    kept = titled.join(top, "company_id", "left_semi")
    titles = kept.select("company_id", "role_title").distinct().groupBy("company_id").agg(
        F.array_sort(F.collect_list("role_title")).alias("role_sequence")
    )
    people = listed(kept, ["company_id"], "user_id", "user_count")
    vector = F.array_join("role_sequence", PATH_SEPARATOR)
    return people.join(titles, "company_id").select(
        "company_id", vector.alias("path_vector"), F.md5(F.encode(vector, "UTF-8")).alias("path_hash"), "role_sequence",
        "user_count", "user_id", F.lit(YEARS_PER_ROLE).alias("avg_years_per_role"),
    )


def _distinct_count(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    present = rows.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    return present.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(out))


def _first_names(sizes: DataFrame, key: str, name: str, size: str, n: int, by_count: bool) -> DataFrame:
    """The rows of the first ``n`` names of each key, by name or by size."""
    order = [F.desc(size), F.col(name)] if by_count else [F.col(name)]
    return sizes.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_place") <= n).drop("_place")


def _leading_names(met: DataFrame, name: str, out: str, n: int, by_count: bool) -> DataFrame:
    """Names among overlapping groups, largest group first.

    The published rule takes the first ``n`` names in alphabetical order and then sorts those by count;
    ``by_count=True`` picks the ``n`` with the highest counts instead.
    """
    named, most = met.where(F.col(name).isNotNull()), F.max("user_count").alias("_size")
    if by_count:
        kept = _first_names(named.groupBy("_key", name).agg(most), "_key", name, "_size", n, by_count)
    else:  # names come first or not before any is counted, so rows are dealt by key once
        place = F.dense_rank().over(Window.partitionBy("_key").orderBy(name))
        kept = named.withColumn("_place", place).where(F.col("_place") <= n).groupBy("_key", name).agg(most)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("_size")).alias("size"), F.col(name).alias("name"))))
    return kept.groupBy("_key").agg(F.transform(ranked, lambda x: x["name"]).alias(out))


def _named_staff(companies: DataFrame, firm: list[str], job: list[str]) -> list[DataFrame]:
    """Companies and roles of users: (user_id, ``firm``, user_count) and (user_id, ``job``, user_count), stored.

    user_count is the size of the largest (company, role) group that the user is in under that name. Rows of ``companies`` may repeat. They are dealt by group
    once, for distinct rows and sizes alike, and each user's companies and roles are put together apart, so that what one shuffles is gone
    before the other begins.
    """
    group = ["company_id", "company_name", "role_id", "role_title"]
    size = F.count(F.lit(1)).over(Window.partitionBy(*group))
    staff = companies.select(*group, "user_id").repartition(*group).distinct().withColumn("user_count", size)
    own = cut(staff.select("user_id", *firm, *job, "user_count"), "staff")  # read once for companies, once for roles
    return [
        cut(own.select("user_id", *names, "user_count").repartition("user_id").groupBy("user_id", *names).agg(F.max("user_count").alias("user_count")), "named-staff")
        for names in (firm, job)
    ]


def _numbered(members: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Numbered groups (_key, keys) and their members (_key, user_id)."""
    numbered = cut(members.select(*keys).distinct().withColumn("_key", F.monotonically_increasing_id()), "group-numbers")
    return numbered, cut(null_safe_join(members.select(*keys, "user_id").distinct(), numbered, keys).select("_key", "user_id"), "numbered-members")


def _meetings(members: DataFrame, companies: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Numbered groups (_key, keys), and the companies and the roles of their members: (_key, company_id, company_name, user_count) and (_key, role_id, role_title, user_count).

    Memberships meet on the user under the number of the group alone; array overlap would compare every pair of groups. Each user's companies and
    roles meet its groups apart, so that its companies times its roles do not. What takes the most or the distinct of these rows needs no distinct rows.
    """
    numbered, mine = _numbered(members, keys)
    firms, jobs = _named_staff(companies, ["company_id", "company_name"], ["role_id", "role_title"])
    return numbered, mine.join(firms, "user_id").drop("user_id"), mine.join(jobs, "user_id").drop("user_id")


def _with_lists(result: DataFrame, numbered: DataFrame, keys: list[str], lists: list[DataFrame]) -> DataFrame:
    extras = numbered
    for extra in lists:
        extras = extras.join(extra, "_key", "left")
    return null_safe_join(result, extras.drop("_key"), keys, "left")


def location_based_networks(
    members: DataFrame, companies: DataFrame, n: int = TOP_NAMES, *, by_count: bool = False
) -> DataFrame:
    """Users per location with the diversity of their companies and roles and two lists of names."""
    keys = ["location_id", "country"]
    numbered, *found = _meetings(members, companies, keys)
    firms, jobs = (cut(met, "meetings") for met in found)  # read once for each list
    result = _with_lists(listed(members, keys, "user_id", "user_count"), numbered, keys, [
        _distinct_count(firms, ["_key"], "company_id", "company_diversity_score"),
        _distinct_count(jobs, ["_key"], "role_id", "role_diversity_score"),
        _leading_names(firms, "company_name", "top_companies", n, by_count),
        _leading_names(jobs, "role_title", "top_roles", n, by_count),
    ])
    return result.fillna(0.0, ["company_diversity_score", "role_diversity_score"])


def alumni_networks(
    members: DataFrame, companies: DataFrame, n: int = TOP_NAMES, *, by_count: bool = False
) -> DataFrame:
    """Alumni per (school, degree) with their companies and roles; a missing degree reads ``ALL``.

    Only the first ``n`` names of each user meet its groups: a name that is one of the first ``n`` of a group is one of the first ``n`` of the user that
    has it, and by count one of the first ``n`` of the user from whom its count is.
    """
    keys = ["school_id", "school_name", "degree_id", "degree_name"]
    alumni = cut(education_networks(members), "alumni")
    numbered, mine = _numbered(members, keys)
    lists = []
    for found, name, out in zip(_named_staff(companies, ["company_name"], ["role_title"]), ("company_name", "role_title"), ("current_companies", "current_roles"), strict=True):
        own = _first_names(found.where(F.col(name).isNotNull()), "user_id", name, "user_count", n, by_count)
        lists.append(cut(_leading_names(mine.join(own, "user_id"), name, out, n, by_count), "leading-names"))
    result = _with_lists(alumni, numbered, keys, lists)
    return result.withColumn("degree_id", F.coalesce("degree_id", F.lit("ALL"))).withColumnRenamed("user_count", "alumni_count")


def project_graph(projects: DataFrame, companies: DataFrame) -> DataFrame:
    """Project groups with a company name and the group size as strength."""
    names = companies.groupBy("company_id").agg(F.min("company_name").alias("company_name"))
    return projects.join(names, "company_id", "left").select(
        "project_id", "project_name", "company_id", "company_name", "user_id", "user_count", "role_title",
        F.col("user_count").cast("double").alias("collaboration_strength"),
    )


def talent_pools(members: DataFrame) -> DataFrame:
    """Distinct employees and roles per company, one row for each role title (one without a title if there is none).

    Rows of ``members`` may repeat. Counts are stored before titles are put together, so that what one shuffles is gone before the other begins.
    """
    keys = ["company_id", "company_name"]
    company = F.struct(*keys).alias("_company")  # one key in which NULL names are equal: titles are dealt by it once for their distinct rows and the join
    staff = cut(members.select(*keys, "user_id").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("total_employees")), "staff-counts")
    offered = cut(members.select(*keys, "role_id", "role_title").distinct(), "offered-roles")
    role_ids = cut(_distinct_count(offered, keys, "role_id", "role_diversity"), "role-counts")
    titles = offered.where(F.col("role_title").isNotNull()).select(company, F.col("role_title").alias("role_available")).repartition("_company").distinct()
    counts = null_safe_join(staff, role_ids, keys, "left").withColumn("_company", company)
    joined = counts.join(titles, "_company", "left")
    return joined.select(
        *keys, "total_employees", "role_available",
        F.coalesce("role_diversity", F.lit(0)).cast("bigint").alias("role_diversity"),
    )
