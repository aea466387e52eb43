"""Every operator as a named query over one data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorakit.functions.exprs import hex_key, standard_population
from agorakit.operators import cohorts, events, graph, graphprofile, kpis, messaging, networks, segments, users, usersets
from agorakit.operators.graph import STUDIED, WORKED
from agorakit.plans.inputs import AS_OF, Inputs
from agorakit.plans.pipeline import STAGES, STAGING_STAGES, Warehouse, run
from agorakit.session import scratch_path
from agorakit.sources import scans, sinks
from agorakit.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
SNAPSHOT_AS_OF = "2001-08-01 12:00:00"
#: Limits so low that most members take the way of wide ones.
FEW = {"degree": 6, "most_shared": 1}
PATH_ENDS = ("P1", "P2")
SEARCHES = (("user-1", "user-1"), ("ASSIST", "user-2"), ("no3", "user-3"), ("@chat", "system-4"), ("x", "user-5"))
READERS = ("user-1", "assistant-1")

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def _query(name: str):
    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        _QUERIES[name] = build
        return build

    return register


def _joined(df: DataFrame, *names: str) -> DataFrame:
    """Array columns as text, so that results compare by value."""
    return df.withColumns({n: F.array_join(n, ",") for n in names})


# Sources and sinks


@_query("a1_active_scan")
def _(i: Inputs) -> DataFrame:
    return scans.scan_active(i["fx_persons"], ["id", "email", "first_name", "last_name", "created_at"])


@_query("a2_orphan_filter")
def _(i: Inputs) -> DataFrame:
    owners = scans.scan_active(i["fx_persons"], ["id"])
    return scans.keep_owned(i["fx_work"], owners, "person_id", "id").select("id", "person_id", "company_id", "start_date")


@_query("a2_orphan_filter_all")
def _(i: Inputs) -> DataFrame:
    persons = scans.scan_active(i["fx_persons"], ["id"])
    social = i["fx_engagement_persons"].select("id")
    children = {
        "work": ("person_id", persons), "study": ("person_id", persons), "votes": ("voter_id", persons),
        "collections": ("person_id", persons), "views": ("person_id", persons), "posts": ("person_id", social),
        "comments": ("person_id", social), "group_members": ("person_id", social), "mentions": ("mentioned_person_id", social),
        "groups": ("created_by", social),
    }
    counts = [
        scans.keep_owned(i[f"fx_{name}"], owners, key, "id").agg(F.count(F.lit(1)).alias("kept"))
        .select(F.lit(name).alias("child"), "kept")
        for name, (key, owners) in children.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@_query("a3_full_refresh")
def _(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "full-refresh")
    frame = scans.scan_active(i["fx_work"], ["id", "person_id", "company_id", "created_at"])
    sinks.write_full(frame, path)
    return sinks.read_full(i.spark, path, frame.schema)


@_query("a4_upsert")
def _(i: Inputs) -> DataFrame:
    current = i["customer"].select(
        F.col("c_custkey").alias("id"), F.lit(None).cast("bigint").alias("version"), F.col("c_acctbal").alias("amount")
    )
    # Open orders come under keys that the table does not have yet.
    incoming = i["orders"].select(
        F.when(F.col("o_orderstatus") == "O", -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("id"), F.col("o_orderkey").alias("version"), F.col("o_totalprice").alias("amount")
    )
    return sinks.upsert_table(scratch_path(i.spark, "upsert"), current, incoming, ["id"], order="version")


@_query("a5_json_text")
def _(i: Inputs) -> DataFrame:
    profile = F.struct("headline_description", "linked_in_url", "location_id")
    return scans.json_column(i["fx_persons"].select("id", profile.alias("profile")), "profile")


@_query("a6_glossary_scan")
def _(i: Inputs) -> DataFrame:
    return scans.scan_glossary(i["fx_glossary"])


def _raw_nodes(i: Inputs) -> DataFrame:
    """Node table with one column per property, as a labelled-node export has it."""
    names = {
        "Person": ("person_id", "email"), "Company": ("company_id", "company_name"), "Role": ("role_id", "title"),
        "School": ("school_id", "school_name"), "Degree": ("degree_id", "degree_name"), "Location": ("location_id", "country"),
        "Project": ("project_id", "project_name"), "Language": ("language_id", "language_name"),
        "Experience": ("experience_id", "start_date"), "Education": ("education_id", "end_date"),
    }
    columns = [F.col("node_type").alias("label")]
    for label, (key, value) in names.items():
        mine = F.col("node_type") == label
        columns += [F.when(mine, F.col("node_id")).alias(key), F.when(mine, F.col("name")).alias(value)]
    return i.nodes.select(*columns)


@_query("a7_nodes")
def _(i: Inputs) -> DataFrame:
    raw = _raw_nodes(i)
    parts = []
    for label, columns in scans.NODE_COLUMNS.items():
        value = "end_date" if label == "Education" else columns[1]
        parts.append(scans.nodes(raw, label).select(F.lit(label).alias("label"), F.col(columns[0]).alias("node_id"), F.col(value).alias("value")))
    return reduce(DataFrame.unionByName, parts)


@_query("a8_dedupe_first")
def _(i: Inputs) -> DataFrame:
    return scans.dedupe_first(i["fx_experiences"].select("role_id", "id", "company_id"), "role_id", "id")


@_query("a9_edge_list")
def _(i: Inputs) -> DataFrame:
    rels = i.rels

    def end(side: str) -> Column:
        properties = [c for c in rels.columns if c.startswith(f"{side}_") and c.endswith("_id")]
        fields = [F.col(c).alias(c[2:]) for c in properties]
        return F.struct(*fields, F.array(f"{side}_label").alias("labels"), F.col(f"{side}_internal").alias("internal_id")).alias(side)

    return scans.edge_list(rels.select(end("a"), end("b"), "type"))


@_query("a10_extraction_log")
def _(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "extraction-log")
    stamp = datetime.fromisoformat(AS_OF)
    for kind in ("full", "incremental"):
        written = [sinks.write_full(frame, scratch_path(i.spark, name), keep_old_if_empty=False) for name, frame in (("nodes", i.nodes), ("edges", i.edges))]
        sinks.log_run(i.spark, path, kind=kind, nodes=written[0], relationships=written[1], started=stamp, completed=stamp, status="success")
    return i.spark.read.schema(sinks.RUN_LOG_SCHEMA).parquet(path).select(
        "extraction_type", "nodes_extracted", "relationships_extracted", "status"
    )


@_query("a11_refresh")
def _(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "engagement-levels")
    sinks.refresh(lambda: i.levels, path)
    return sinks.read_full(i.spark, path, i.levels.schema).groupBy("engagement_level").agg(F.count(F.lit(1)).alias("users"))


@_query("a12_export_activation")
def _(i: Inputs) -> DataFrame:
    training = segments.activation_training(i.lazy_users, AS_OF)
    path = sinks.export_activation(training, AS_OF, scratch_path(i.spark, "export"))
    schema = segments.activation_export_frame(training, AS_OF).schema
    return i.spark.read.schema(schema).option("header", True).csv(path)


@_query("a13_export_engagement")
def _(i: Inputs) -> DataFrame:
    training = segments.engagement_training(i.users, i.events, segments.engagement_levels(i.users, AS_OF), AS_OF)
    path = sinks.export_engagement(training, AS_OF, scratch_path(i.spark, "export"))
    schema = segments.engagement_export_frame(training, AS_OF).schema
    return i.spark.read.schema(schema).option("header", True).csv(path)


def warehouse(i: Inputs, root: str) -> Warehouse:
    names = {
        "persons": "fx_persons", "social_persons": "fx_engagement_persons", "experiences": "fx_work", "education": "fx_study",
        "posts": "fx_posts", "comments": "fx_comments", "query_votes": "fx_votes", "collections": "fx_collections",
        "mentions": "fx_mentions", "group_members": "fx_group_members", "view_access": "fx_views", "glossary": "fx_glossary",
        "graph_edges": "fx_edges", "graph_nodes": "fx_nodes",
    }
    return Warehouse(i.spark, root, {k: i[v] for k, v in names.items()}, AS_OF, i.test_emails)


@_query("a15_stage_runner")
def _(i: Inputs) -> DataFrame:
    wanted = ["unified_users", "glossary_terms", "activity_events", "daily_metrics", "user_engagement_levels"]
    held = warehouse(i, scratch_path(i.spark, "warehouse"))
    staging = [s for s in STAGING_STAGES if s.needs[0] in held.sources]
    metrics, _ = run(held, [*staging, *STAGES], only=[*[s.name for s in staging], *wanted], together=4)
    return metrics.select("stage", "status", "rows")


@_query("a16_active_count")
def _(i: Inputs) -> DataFrame:
    return scans.active_count(i["fx_persons"])


# Users

_USER_QUERIES = {
    "u2_user_type": ["has_finder", "user_type"],
    "u3_activity_counts": list(users.COUNT_COLUMNS.values()),
    "u4_completion_score": ["profile_completion_score"],
    "u5_last_activity": ["last_activity_date"],
    "u6_first_dates": ["first_post_date", "first_vote_date"],
    "u7_days_since_signup": ["days_since_signup"],
    "u8_days_to_first": ["days_to_first_activity"],
    "u9_lifecycle_stage": ["user_lifecycle_stage"],
    "u10_activation_status": ["activation_status"],
    "u11_activated_at": ["activated_at"],
}


@_query("u1_merge_identity")
def _(i: Inputs) -> DataFrame:
    merged = users.merge_identity(i["fx_persons"], i["fx_engagement_persons"])
    return merged.select("user_id", "engagement_person_id", "email", "first_name", "last_name")


for _name, _columns in _USER_QUERIES.items():
    _QUERIES[_name] = lambda i, columns=_columns: i.lazy_users.select("user_id", *columns)


@_query("u12_unified_users")
def _(i: Inputs) -> DataFrame:
    return i.lazy_users


@_query("g1_glossary")
def _(i: Inputs) -> DataFrame:
    return users.publish_glossary(i["fx_glossary"]).drop("created_at", "updated_at")


# Events and cohorts

for _name, _build, _source in (
    ("e1_post_events", events.post_events, "fx_posts"),
    ("e2_comment_events", events.comment_events, "fx_comments"),
    ("e3_vote_events", events.vote_events, "fx_votes"),
    ("e4_collection_events", events.collection_events, "fx_collections"),
    ("e5_view_events", events.view_events, "fx_views"),
):
    _QUERIES[_name] = lambda i, build=_build, source=_source: events.metadata_json(build(i[source], i.lazy_users))


@_query("e6_activity_events")
def _(i: Inputs) -> DataFrame:
    return events.metadata_json(i.events)


@_query("e7_first_of_type")
def _(i: Inputs) -> DataFrame:
    flagged = events.flag_first(i["fx_posts"], "person_id", "created_at")
    return flagged.select("id", "person_id", "is_first_activity_of_type")


@_query("e8_hex_id")
def _(i: Inputs) -> DataFrame:
    return i["fx_comments"].select("id", hex_key(F.col("id")).alias("source_id"))


@_query("e9_event_day")
def _(i: Inputs) -> DataFrame:
    return i.events.select("user_id", "activity_type", "source_id", "days_since_signup")


@_query("c1_user_cohorts")
def _(i: Inputs) -> DataFrame:
    return cohorts.user_cohorts(i.lazy_users)


# KPIs


@_query("d1_daily_signups")
def _(i: Inputs) -> DataFrame:
    return kpis.daily_signups(i.lazy_users)


@_query("d2_daily_activity")
def _(i: Inputs) -> DataFrame:
    return kpis.daily_activity(i.events)


@_query("d3_daily_active_by_type")
def _(i: Inputs) -> DataFrame:
    return kpis.daily_active_by_type(i.events, i.lazy_users)


@_query("d4_date_series")
def _(i: Inputs) -> DataFrame:
    return kpis.date_series(i.lazy_users, AS_OF)


@_query("n5_cumulative_users")
def _(i: Inputs) -> DataFrame:
    return kpis.cumulative_users(i.lazy_users, AS_OF)


@_query("d5_daily_metrics")
def _(i: Inputs) -> DataFrame:
    return i.daily


@_query("m1_monthly_rollup")
def _(i: Inputs) -> DataFrame:
    return kpis.monthly_rollup(i.daily).withColumn("avg_dau", F.round("avg_dau", 4))


@_query("m2_monthly_active")
def _(i: Inputs) -> DataFrame:
    return kpis.monthly_active(i.events, i.lazy_users)


@_query("m3_monthly_activation")
def _(i: Inputs) -> DataFrame:
    return kpis.monthly_activation(i.lazy_users)


@_query("m4_retained_from_previous")
def _(i: Inputs) -> DataFrame:
    return kpis.retained_from_previous(i.events, SNAPSHOT_AS_OF)


def _user_sets(i: Inputs) -> usersets.UserSets:
    """Sets of all events from two loads; days 16 to 20 of each month come in both."""
    store, day = usersets.UserSets(scratch_path(i.spark, "user-sets"), i.stored_events.schema["user_id"].dataType), F.dayofmonth("activity_date")
    store.load(i.stored_events.where(day > 15), 0)
    store.load(i.stored_events.where(day <= 20), 1)
    return store


@_query("m2_active_from_sets")
def _(i: Inputs) -> DataFrame:
    store = _user_sets(i)
    months = usersets.within(usersets.by_month(store.read(i.spark)), store.population(standard_population(i.lazy_users)))
    return usersets.sizes(months, "metric_month", "mau")


@_query("m4_retained_by_month")
def _(i: Inputs) -> DataFrame:
    return usersets.retained_by_month(usersets.by_month(_user_sets(i).read(i.spark)))


@_query("m5_monthly_metrics")
def _(i: Inputs) -> DataFrame:
    daily = kpis.daily_metrics(i.lazy_users, i.stored_events, AS_OF)
    return kpis.monthly_metrics(daily, i.stored_events, i.lazy_users, AS_OF)


@_query("r1_cohort_weeks")
def _(i: Inputs) -> DataFrame:
    return cohorts.cohort_weeks(i.lazy_users, AS_OF)


@_query("r2_cohort_activity")
def _(i: Inputs) -> DataFrame:
    return cohorts.cohort_activity(i.lazy_users, i.events, AS_OF)


@_query("r3_cohort_retention")
def _(i: Inputs) -> DataFrame:
    return cohorts.cohort_retention(i.lazy_users, i.events, AS_OF)


@_query("r4_week_bucket")
def _(i: Inputs) -> DataFrame:
    # Shifted by hours so that buckets near the edges and before signup are exercised.
    shifted = F.col("activity_date") - F.expr("INTERVAL '5' HOUR")
    week = cohorts.week_bucket(shifted, F.col("signup_date"))
    return (
        i.events.join(i.lazy_users.select("user_id", "signup_date"), "user_id")
        .select(week.alias("week"))
        .groupBy("week").agg(F.count(F.lit(1)).alias("events"))
    )


@_query("k1_post_metrics")
def _(i: Inputs) -> DataFrame:
    return kpis.post_metrics(i.events)


@_query("k2_finder_metrics")
def _(i: Inputs) -> DataFrame:
    return kpis.finder_metrics(i.events)


@_query("k3_collection_metrics")
def _(i: Inputs) -> DataFrame:
    return kpis.collection_metrics(i.events)


@_query("k4_profile_metrics")
def _(i: Inputs) -> DataFrame:
    people = i.users_as_of(SNAPSHOT_AS_OF)
    return kpis.profile_metrics(people, i["fx_persons"], i["fx_work"], i["fx_study"], SNAPSHOT_AS_OF)


@_query("k5_funnel_metrics")
def _(i: Inputs) -> DataFrame:
    return kpis.funnel_metrics(i.lazy_users, AS_OF)


# Segments and features


@_query("v1_engagement_levels")
def _(i: Inputs) -> DataFrame:
    return i.levels


@_query("f1_activation_training")
def _(i: Inputs) -> DataFrame:
    return segments.activation_training(i.lazy_users, AS_OF)


@_query("f2_engagement_training")
def _(i: Inputs) -> DataFrame:
    return segments.engagement_training(i.users, i.events, segments.engagement_levels(i.users, AS_OF), AS_OF)


# Graph


def _listed(i: Inputs, kind: dict, **options) -> DataFrame:
    return graph.shared_target_pairs(*i.planned_graph, kind, **options)


@_query("n1_worked_together")
def _(i: Inputs) -> DataFrame:
    return graph.relationship_groups(*i.planned_graph, WORKED)


@_query("n1_relationships_of")
def _(i: Inputs) -> DataFrame:
    return graph.relationships_of(*i.graph, WORKED, i.lazy_users.where("user_id % 20 = 0"))


@_query("n1_listed_pairs")
def _(i: Inputs) -> DataFrame:
    return _listed(i, WORKED)


@_query("n1_worked_together_direct")
def _(i: Inputs) -> DataFrame:
    return _listed(i, WORKED, hop="direct")


@_query("n2_studied_together")
def _(i: Inputs) -> DataFrame:
    return graph.relationship_groups(*i.planned_graph, STUDIED)


@_query("n2_relationships_of")
def _(i: Inputs) -> DataFrame:
    return graph.relationships_of(*i.graph, STUDIED, i.lazy_users.where("user_id % 20 = 0"))


@_query("n2_listed_pairs")
def _(i: Inputs) -> DataFrame:
    return _listed(i, STUDIED)


@_query("n3_company_networks")
def _(i: Inputs) -> DataFrame:
    return graph.company_networks(i.lazy_company_members)


@_query("n4_education_networks")
def _(i: Inputs) -> DataFrame:
    return graph.education_networks(i.school_members)


@_query("n6_location_networks")
def _(i: Inputs) -> DataFrame:
    return graph.location_networks(i.location_members)


@_query("n7_project_collaborations")
def _(i: Inputs) -> DataFrame:
    return graph.project_collaborations(i.project_members)


@_query("n8_career_paths")
def _(i: Inputs) -> DataFrame:
    return graph.career_paths(*i.graph, AS_OF)


@_query("l1_connection_recommendations")
def _(i: Inputs) -> DataFrame:
    return networks.connection_recommendations(i.relationship_members)


@_query("l1_recommendations_small_hubs")
def _(i: Inputs) -> DataFrame:
    return networks.connection_recommendations(i.relationship_members, **FEW)


@_query("l1_shared_names")
def _(i: Inputs) -> DataFrame:
    found = networks.recommendation_context(networks.connection_recommendations(i.relationship_members), i.relationship_members)
    return _joined(found.select("user_id", "recommended_user_id", "common_companies", "common_schools"), "common_companies", "common_schools")


@_query("l2_company_network_map")
def _(i: Inputs) -> DataFrame:
    return networks.company_network_map(i.lazy_company_members)


@_query("l3_skills_matching")
def _(i: Inputs) -> DataFrame:
    return networks.skills_matching(i.company_rows, i.lazy_users, AS_OF)


@_query("l4_career_path_patterns")
def _(i: Inputs) -> DataFrame:
    return _joined(networks.career_path_patterns(i.company_members), "role_sequence")


@_query("l5_location_based_networks")
def _(i: Inputs) -> DataFrame:
    found = networks.location_based_networks(i.location_members, i.company_rows)
    return _joined(found, "top_companies", "top_roles")


@_query("l5_location_networks_by_count")
def _(i: Inputs) -> DataFrame:
    found = networks.location_based_networks(i.location_members, i.company_rows, by_count=True)
    return _joined(found, "top_companies", "top_roles")


@_query("l6_alumni_networks")
def _(i: Inputs) -> DataFrame:
    found = networks.alumni_networks(i.school_members, i.company_rows)
    return _joined(found, "current_companies", "current_roles")


@_query("l7_project_graph")
def _(i: Inputs) -> DataFrame:
    projects = graph.project_collaborations(i.project_members)
    return networks.project_graph(projects, i.lazy_company_members)


@_query("v2_connection_summary")
def _(i: Inputs) -> DataFrame:
    summary = networks.connection_summary(i.relationship_members)
    return summary.withColumn("avg_connection_strength", F.round("avg_connection_strength", 4))


@_query("v2_summary_small_hubs")
def _(i: Inputs) -> DataFrame:
    summary = networks.connection_summary(i.relationship_members, **FEW)
    return summary.withColumn("avg_connection_strength", F.round("avg_connection_strength", 4))


@_query("v3_top_connected")
def _(i: Inputs) -> DataFrame:
    top = networks.top_connected(i.lazy_users, i.relationship_members)
    return top.withColumn("avg_connection_strength", F.round("avg_connection_strength", 4))


@_query("v3_top_connected_small_hubs")
def _(i: Inputs) -> DataFrame:
    top = networks.top_connected(i.lazy_users, i.relationship_members, **FEW)
    return top.withColumn("avg_connection_strength", F.round("avg_connection_strength", 4))


@_query("v4_talent_pools")
def _(i: Inputs) -> DataFrame:
    return networks.talent_pools(i.company_rows)


# Messaging


@_query("h1_inbox")
def _(i: Inputs) -> DataFrame:
    return messaging.inbox(*i.chat("conversations", "members", "messages", "message_reads", "chat_people"))


@_query("h2_thread")
def _(i: Inputs) -> DataFrame:
    frames = i.chat("messages", "chat_people", "message_reads", "reactions", "attachments")
    shown = F.transform("reactions", lambda r: F.concat(r["reaction"], F.lit(":"), r["n"].cast("string")))
    return messaging.thread(*frames, READERS[0]).withColumn("reactions", F.array_join(shown, ","))


@_query("h2_reactions")
def _(i: Inputs) -> DataFrame:
    return i["fx_reactions"].select("message_id", "person_id", "reaction_type")


@_query("h3_read_matrix")
def _(i: Inputs) -> DataFrame:
    return messaging.read_matrix(*i.chat("messages", "message_reads", "chat_people"), READERS)


@_query("h4_unread_total")
def _(i: Inputs) -> DataFrame:
    return messaging.unread_total(*i.chat("members", "messages", "message_reads"))


@_query("h5_unread_by_conversation")
def _(i: Inputs) -> DataFrame:
    return messaging.unread_by_conversation(*i.chat("conversations", "members", "messages", "message_reads", "chat_people"))


@_query("h6_folder_badges")
def _(i: Inputs) -> DataFrame:
    return messaging.folder_badges(messaging.inbox(*i.chat("conversations", "members", "messages", "message_reads", "chat_people")))


@_query("h7_folder_distribution")
def _(i: Inputs) -> DataFrame:
    return messaging.folder_distribution(i["fx_members"])


@_query("h8_notification_settings")
def _(i: Inputs) -> DataFrame:
    return messaging.notification_settings(*i.chat("members", "chat_people"))


@_query("h9_user_search")
def _(i: Inputs) -> DataFrame:
    return messaging.search_users(i["fx_chat_people"], SEARCHES)


@_query("h9_user_search_table")
def _(i: Inputs) -> DataFrame:
    searches = i["fx_persons"].where("id % 20 = 0").selectExpr("concat('l', CAST(id AS string)) AS query", "CAST(id AS string) AS searcher_id")
    return messaging.search_user_table(i["fx_persons"], searches)


@_query("h9_user_search_parts")
def _(i: Inputs) -> DataFrame:
    searches = i["fx_persons"].where("id % 20 = 0").selectExpr("right(CAST(id AS string), 2) AS query", "CAST(id AS string) AS searcher_id")
    return messaging.search_user_table(i["fx_persons"], searches)


@_query("h10_direct_conversations")
def _(i: Inputs) -> DataFrame:
    return messaging.direct_conversations(*i.chat("conversations", "members"))


@_query("h11_reaction_state")
def _(i: Inputs) -> DataFrame:
    return messaging.reaction_state(i["fx_reaction_log"])


@_query("h12_read_state")
def _(i: Inputs) -> DataFrame:
    return messaging.read_state(i["fx_read_log"])


@_query("h12_last_read")
def _(i: Inputs) -> DataFrame:
    return messaging.last_read(i["fx_read_log"])


@_query("h13_folder_state")
def _(i: Inputs) -> DataFrame:
    return messaging.folder_state(i["fx_folder_log"])


@_query("h14_membership_state")
def _(i: Inputs) -> DataFrame:
    return messaging.membership_state(i["fx_membership_log"])


@_query("h14_membership_messages")
def _(i: Inputs) -> DataFrame:
    return messaging.membership_messages(*i.chat("membership_log", "chat_people"))


@_query("h15_message_type")
def _(i: Inputs) -> DataFrame:
    files = i["fx_attachments"].select(F.col("message_id").alias("id"), "mime_type")
    return i["fx_messages"].select("id").join(files, "id", "left").select(
        "id", messaging.message_type(F.col("mime_type")).alias("message_type")
    )


# Graph profile


@_query("q1_label_counts")
def _(i: Inputs) -> DataFrame:
    return graphprofile.label_counts(i["fx_nodes"])


@_query("q2_relationship_counts")
def _(i: Inputs) -> DataFrame:
    return graphprofile.relationship_counts(i["fx_edges"])


@_query("q3_patterns")
def _(i: Inputs) -> DataFrame:
    return graphprofile.patterns(i["fx_edges"])


@_query("q4_property_profile")
def _(i: Inputs) -> DataFrame:
    raw = _raw_nodes(i)
    return graphprofile.property_profile(raw, "label", [c for c in raw.columns if c != "label"])


@_query("q4_relationship_properties")
def _(i: Inputs) -> DataFrame:
    rels = i.rels
    return graphprofile.property_profile(rels, "type", [c for c in rels.columns if c.endswith("_id")])


@_query("q5_orphans")
def _(i: Inputs) -> DataFrame:
    return graphprofile.orphans(i.nodes, i.edges)


@_query("q6_hubs")
def _(i: Inputs) -> DataFrame:
    return graphprofile.hubs(i.nodes, i.edges)


@_query("q7_samples")
def _(i: Inputs) -> DataFrame:
    return graphprofile.samples(i["fx_nodes"])


@_query("q8_missing_and_ranges")
def _(i: Inputs) -> DataFrame:
    date = F.try_to_timestamp(F.when(F.col("name").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("name")), F.lit("yyyy-MM-dd"))
    return graphprofile.missing_and_ranges(i["fx_nodes"], date)


@_query("q9_both_patterns")
def _(i: Inputs) -> DataFrame:
    return graphprofile.both_patterns(i["fx_edges"], "EXPERIENCED_IN", "EDUCATED_IN")


@_query("q10_neighbourhood")
def _(i: Inputs) -> DataFrame:
    return graphprofile.neighbourhood(i["fx_edges"], "L1")


@_query("q11_shortest_path")
def _(i: Inputs) -> DataFrame:
    return graphprofile.shortest_path_length(i.edges, *PATH_ENDS)


# Streaming


@_query("x1_stream_daily_activity")
def _(i: Inputs) -> DataFrame:
    counts = streams.stream_daily_activity(streams.event_stream(i.spark, i.folder))
    return streams.run_to_table(
        counts, scratch_path(i.spark, "daily-activity"), ["metric_date", "event_type"],
        checkpoint=scratch_path(i.spark, "daily-activity-state"), mode="update",
    )


@_query("x1_stream_daily_users")
def _(i: Inputs) -> DataFrame:
    return streams.stream_daily_users(
        streams.event_stream(i.spark, i.folder), scratch_path(i.spark, "daily-users"), checkpoint=scratch_path(i.spark, "daily-users-state"),
    )


@_query("x2_stream_upsert")
def _(i: Inputs) -> DataFrame:
    rows = streams.event_stream(i.spark, i.folder).select("user_id", "event_id", "event_type", "value")
    return streams.run_to_table(
        rows, scratch_path(i.spark, "last-event"), ["user_id"], checkpoint=scratch_path(i.spark, "last-event-state"),
        order="event_id",
    )


def queries() -> dict[str, Query]:
    """All queries; each takes a session and a data folder."""
    return {name: (lambda spark, folder, build=build: build(Inputs(spark, folder))) for name, build in _QUERIES.items()}
