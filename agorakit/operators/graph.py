"""People networks from the property graph: memberships, relationships, group tables and career paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorakit.functions.exprs import clock, json_text, loose_timestamp, whole_years
from agorakit.operators import pairs
from agorakit.session import cut
from agorakit.operators.lists import listed, null_safe_join

# Edge types and node labels behind each relationship.
WORKED = {"type": "WORKED_TOGETHER", "target": "Company", "edges": ("EXPERIENCED_IN", "WORKED_AT"),
          "via": ("EXPERIENCED_IN", "WORKED_AT"), "context": ("WORKED_AS", "Role"), "names": ("companies", "roles")}
STUDIED = {"type": "STUDIED_TOGETHER", "target": "School", "edges": ("EDUCATED_IN", "STUDIED_AT"),
           "via": ("EDUCATED_IN", "STUDIED_AT"), "context": ("EARNED", "Degree"), "names": ("schools", "degrees")}
EMPLOYMENT_EDGES = ("WORKS_AT", "WORKED_AT")
PATH_ARROW = "->"


def _named(nodes: DataFrame, label: str, id_col: str, name_col: str) -> DataFrame:
    return nodes.where(F.col("node_type") == label).select(F.col("node_id").alias(id_col), F.col("name").alias(name_col))


def _ends(edges: DataFrame, source: str, target: str, types: tuple[str, ...] | None = None, target_label: str | None = None) -> DataFrame:
    found = edges
    if types:
        found = found.where(F.col("relationship_type").isin(*types))
    if target_label:
        found = found.where(F.col("target_node_type") == target_label)
    return found.select(F.col("source_node_id").alias(source), F.col("target_node_id").alias(target))


def _links(edges: DataFrame, source: str, target: str, types: tuple[str, ...] | None = None, target_label: str | None = None) -> DataFrame:
    return _ends(edges, source, target, types, target_label).distinct()


def person_users(nodes: DataFrame, users: DataFrame) -> DataFrame:
    """Graph person nodes with their user: (node_id, user_id). A person node carries its email as name."""
    emails = users.select("user_id", F.col("email").alias("_email")).where(F.col("_email").isNotNull())
    people = nodes.where(F.col("node_type") == "Person").select("node_id", F.col("name").alias("_email"))
    return people.join(emails, "_email").select("node_id", "user_id")


def target_members(edges: DataFrame, nodes: DataFrame, users: DataFrame, kind: dict, *, hop: str = "two") -> DataFrame:
    """Users per company or school in membership form, with the earliest start of the user's spell there.

    Any edge to the target makes a member; only the kind's own edge types let the member come first in a pair. With
    ``hop="two"`` dates come from the spell nodes between person and target; with ``"direct"`` there are none.
    """
    people = cut(person_users(nodes, users).distinct(), "people")
    keyed = people.join(people.groupBy("user_id").agg(F.min("node_id").alias("ord")), "user_id")
    rows = edges.where(F.col("target_node_type") == kind["target"]).select(
        F.col("source_node_id").alias("node_id"), F.col("target_node_id").alias("grp"),
        F.col("relationship_type").isin(*kind["edges"]).alias("_own_type"), F.lit(True).alias("_edge"),
    )
    none = F.lit(None).cast("timestamp").alias("_start")
    if hop == "direct":
        rows = rows.select("*", none)
    else:
        to_spell, from_spell = kind["via"]
        # Undated spells change no first date. Links are dealt by spell for their distinct rows and for the joins at once.
        starts = nodes.select(F.col("node_id").alias("spell"), loose_timestamp(F.col("name")).alias("_start")).where(F.col("_start").isNotNull())
        links = [
            ends.repartition("spell").distinct()
            for ends in (_ends(edges, "spell", "grp", (from_spell,), kind["target"]), _ends(edges, "node_id", "spell", (to_spell,)))
        ]
        dated = links[0].join(starts.groupBy("spell").agg(F.min("_start").alias("_start")), "spell").join(links[1], "spell")
        unknown = F.lit(None).cast("boolean")
        rows = rows.select("*", none).unionByName(dated.select("node_id", "grp", unknown.alias("_own_type"), unknown.alias("_edge"), "_start"))
    # A user has one sort key; as a key of the group it needs no sorted aggregate.
    members = rows.join(keyed, "node_id").groupBy("grp", F.col("user_id").alias("member"), "ord").agg(
        F.max("_own_type").alias("leads"), F.min("_start").alias("since"), F.max("_edge").alias("_edge"),
    )
    return members.where("_edge").drop("_edge").join(_named(nodes, kind["target"], "grp", "label"), "grp")


def _context_titles(edges: DataFrame, nodes: DataFrame, users: DataFrame, kind: dict) -> DataFrame:
    """Sorted role titles or degree names directly on each user's person node."""
    edge_type, label = kind["context"]
    return (
        _ends(edges, "node_id", "_target", (edge_type,))
        .join(person_users(nodes, users).distinct(), "node_id")
        .join(_named(nodes, label, "_target", "_title").distinct(), "_target")
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_set("_title")).alias("titles"))
    )


def relationship_members(edges: DataFrame, nodes: DataFrame, users: DataFrame, *, hop: str = "two") -> DataFrame:
    """Memberships behind both kinds of relationship in one frame; groups are told apart by kind.

    Each kind is stored by itself, so that what one shuffles is gone before the other begins.
    """
    found = [
        cut(
            target_members(edges, nodes, users, kind, hop=hop).withColumn("kind", F.lit(kind["type"])).withColumn("grp", F.concat("kind", F.lit("/"), "grp")),
            "relationship-members",
        )
        for kind in (WORKED, STUDIED)
    ]
    return found[0].unionByName(found[1])


def shared_target_pairs(edges: DataFrame, nodes: DataFrame, users: DataFrame, kind: dict, *, hop: str = "two") -> DataFrame:
    """Every pair of users that share a company (``WORKED``) or a school (``STUDIED``), with strength, context and first date.

    The result is quadratic in the size of a company or school. ``relationship_groups`` holds the same relation in linear form, and
    ``relationships_of`` lists it for chosen users.
    """
    titles = _context_titles(edges, nodes, users, kind).withColumnRenamed("user_id", "member")
    targets, extras = kind["names"]

    def context(names: Column) -> Column:
        return json_text(F.struct(names.alias(targets), F.col("titles").alias(extras)))

    # The first member brings its titles, and the context of a pair that shares this target only.
    members = target_members(edges, nodes, users, kind, hop=hop).join(titles, "member", "left")
    members = cut(members.withColumn("titles", F.coalesce("titles", F.array().cast("array<string>"))).withColumn("_alone", context(F.array_compact(F.array("label")))), "members")
    return pairs.all_pairs(members, own=["titles", "_alone"]).select(
        F.col("first").alias("user_id"),
        F.col("second").alias("related_user_id"),
        F.lit(kind["type"]).alias("relationship_type"),
        F.col("strength").alias("relationship_strength"),
        F.when(F.col("strength") == 1, F.col("_alone")).otherwise(context(F.col("labels"))).alias("connection_context"),
        F.col("since").alias("first_connected_at"),
    )


def relationship_groups(edges: DataFrame, nodes: DataFrame, users: DataFrame, kind: dict, *, hop: str = "two") -> DataFrame:
    """The whole relation of one kind, whatever the size of its groups: one row per (group, member), no pair.

    Two members of a group are related through it if the one that is first by ``member_key`` has ``leads``. ``later_members`` is the number of
    members after this one in the group, so a leading member is first in that many pairs of the group. ``relationships_of`` lists the
    pairs of chosen users with their strength.
    """
    titles = _context_titles(edges, nodes, users, kind).withColumnRenamed("user_id", "member")
    members = pairs.later_members(target_members(edges, nodes, users, kind, hop=hop))
    return members.join(titles, "member", "left").select(
        F.lit(kind["type"]).alias("relationship_type"), F.col("grp").alias("group_id"), F.col("label").alias("group_name"), F.col("member").alias("user_id"),
        F.col("ord").alias("member_key"), "leads", F.col("since").alias("first_connected_at"), F.array_join("titles", ",").alias("titles"),
        "group_size", "later_members",
    )


def relationships_of(edges: DataFrame, nodes: DataFrame, users: DataFrame, kind: dict, focus: DataFrame) -> DataFrame:
    """Every relationship of the users in ``focus`` (column user_id), partners in large targets included."""
    members = target_members(edges, nodes, users, kind, hop="direct")
    found = pairs.pairs_of(members, focus.select(F.col("user_id").alias("member")))
    return found.select(
        F.col("member").alias("user_id"), F.col("partner").alias("related_user_id"),
        F.lit(kind["type"]).alias("relationship_type"), F.col("strength").alias("relationship_strength"),
    )


def company_rows(edges: DataFrame, nodes: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of ``company_members``, of which those of a user with several person nodes may repeat.

    Edges from other nodes than persons go in the first join. Who is employed where is stored, narrow, before roles multiply its rows.
    """
    employed = _ends(edges, "node_id", "company_id", EMPLOYMENT_EDGES, "Company").join(person_users(nodes, users), "node_id").distinct()
    employed = cut(employed.join(_named(nodes, "Company", "company_id", "company_name"), "company_id"), "employed")
    roles = _ends(edges, "node_id", "_role", ("WORKED_AS",)).repartition("node_id").distinct().join(
        _named(nodes, "Role", "role_id", "role_title"), F.col("_role") == F.col("role_id"), "left"
    )
    return employed.join(roles.drop("_role"), "node_id", "left").select("company_id", "company_name", "role_id", "role_title", "user_id")


def company_members(edges: DataFrame, nodes: DataFrame, users: DataFrame) -> DataFrame:
    """One row per (company, role, user). The role is any role on the user's person node, NULL without one."""
    return company_rows(edges, nodes, users).distinct()


def company_networks(members: DataFrame) -> DataFrame:
    """Users per (company, role), one row each, with the size of the group."""
    keys = ["company_id", "company_name", "role_id", "role_title"]
    return listed(members, keys, "user_id", "user_count")


def school_members(edges: DataFrame, nodes: DataFrame, users: DataFrame) -> DataFrame:
    """One row per (school, degree, user, graduation year), over person - education - school paths."""
    ends = nodes.where(F.col("node_type") == "Education").select(
        F.col("node_id").alias("education_id"), F.year(loose_timestamp(F.col("name"))).cast("bigint").alias("graduation_year")
    )
    degrees = _links(edges, "education_id", "_degree", ("EARNED",)).join(
        _named(nodes, "Degree", "degree_id", "degree_name"), F.col("_degree") == F.col("degree_id"), "left"
    )
    return (
        _links(edges, "education_id", "school_id", ("STUDIED_AT",), "School")
        .join(_named(nodes, "School", "school_id", "school_name"), "school_id")
        .join(ends, "education_id")
        .join(_links(edges, "node_id", "education_id", ("EDUCATED_IN",)), "education_id")
        .join(person_users(nodes, users), "node_id")
        .join(degrees.drop("_degree"), "education_id", "left")
        .select("school_id", "school_name", "degree_id", "degree_name", "user_id", "graduation_year")
        .distinct()
    )


def education_networks(members: DataFrame) -> DataFrame:
    keys = ["school_id", "school_name", "degree_id", "degree_name"]
    years = members.groupBy(*keys).agg(
        F.min("graduation_year").alias("graduation_year_min"), F.max("graduation_year").alias("graduation_year_max")
    )
    people = listed(members, keys, "user_id", "user_count")
    return null_safe_join(people, years, keys)


def location_members(edges: DataFrame, nodes: DataFrame, users: DataFrame) -> DataFrame:
    return (
        _links(edges, "node_id", "location_id", ("LIVES_AT",), "Location")
        .join(_named(nodes, "Location", "location_id", "country"), "location_id")
        .join(person_users(nodes, users), "node_id")
        .select("location_id", "country", "user_id")
        .distinct()
    )


def location_networks(members: DataFrame) -> DataFrame:
    keys = ["location_id", "country"]
    return listed(members, keys, "user_id", "user_count")


def project_members(edges: DataFrame, nodes: DataFrame, users: DataFrame) -> DataFrame:
    """One row per (project, company, user, role title), over person - experience - project paths."""
    companies = _links(edges, "experience_id", "_company", ("WORKED_AT",)).join(
        _named(nodes, "Company", "company_id", "_name"), F.col("_company") == F.col("company_id"), "left"
    )
    roles = _links(edges, "experience_id", "_role", ("WORKED_AS",)).join(
        _named(nodes, "Role", "_role_id", "role_title"), F.col("_role") == F.col("_role_id"), "left"
    )
    experiences = nodes.where(F.col("node_type") == "Experience").select(F.col("node_id").alias("experience_id"))
    return (
        _links(edges, "experience_id", "project_id", ("WORKED_ON",), "Project")
        .join(_named(nodes, "Project", "project_id", "project_name"), "project_id")
        .join(experiences, "experience_id", "left_semi")
        .join(_links(edges, "node_id", "experience_id", ("EXPERIENCED_IN",)), "experience_id")
        .join(person_users(nodes, users), "node_id")
        .join(companies.select("experience_id", "company_id"), "experience_id", "left")
        .join(roles.select("experience_id", "role_title"), "experience_id", "left")
        .select("project_id", "project_name", "company_id", "user_id", "role_title")
        .distinct()
    )


def project_collaborations(members: DataFrame) -> DataFrame:
    """Users and role titles per (project, company): a row for each user and one for each title, with the number of users."""
    keys = ["project_id", "project_name", "company_id"]
    people = listed(members, keys, "user_id", "user_count")
    titles = listed(members, keys, "role_title", "_titles").drop("_titles")
    titles = null_safe_join(titles, people.select(*keys, "user_count").distinct(), keys)
    return people.unionByName(titles, allowMissingColumns=True).select(*keys, "user_count", "user_id", "role_title")


def career_paths(edges: DataFrame, nodes: DataFrame, users: DataFrame, as_of) -> DataFrame:
    """Each user's distinct role titles in order of first start, with totals and a hash for grouping equal paths.

    Spells collapse to one row per (user, role) before the path is put together, so a path is bounded by the number of
    distinct titles, not by the number of spells. Undated roles come last.
    """
    spells = nodes.where(F.col("node_type") == "Experience").select(
        F.col("node_id").alias("spell"), loose_timestamp(F.col("name")).alias("start")
    )
    mine = (
        _links(edges, "node_id", "spell", ("EXPERIENCED_IN",))
        .join(person_users(nodes, users), "node_id")
        .join(spells, "spell")
        .select("user_id", "spell", "start")
    )
    steps = (
        mine.join(_links(edges, "spell", "_role", ("WORKED_AS",), "Role"), "spell")
        .join(_named(nodes, "Role", "_role", "title"), "_role")
        .groupBy("user_id", "title")
        .agg(F.min("start").alias("start"))
    )
    order = F.struct(F.col("start").isNull().alias("undated"), "start", "title")
    paths = steps.groupBy("user_id").agg(
        F.array_sort(F.collect_list(order)).alias("_steps"), F.min("start").alias("_first"),
        F.count(F.lit(1)).alias("number_of_roles"),
    )
    companies = (
        mine.join(_links(edges, "spell", "company_id", ("WORKED_AT",), "Company"), "spell")
        .select("user_id", "company_id")
        .distinct()
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("_companies"))
    )
    vector = F.array_join(F.transform("_steps", lambda s: s["title"]), PATH_ARROW)
    return (
        paths.join(companies, "user_id", "left")
        .withColumn("path_vector", vector)
        .select(
            "user_id", "path_vector", "number_of_roles",
            F.coalesce("_companies", F.lit(0).cast("bigint")).alias("number_of_companies"),
            whole_years(F.col("_first"), clock(as_of)).alias("total_years_experience"),
            F.md5(F.encode("path_vector", "UTF-8")).alias("path_hash"),
        )
    )
