"""Declared schemas. Tables are read with these; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import StructType

# The star-schema test tables. Zone-less timestamps are read as timestamps in the session zone, UTC.
TEST_TABLES: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Raw copies of the source systems. Profile service first, then social platform, graph and messaging.
STAGING: dict[str, str] = {
    "persons": "id bigint, person_id string, name string, profile string, first_name string, middle_name string, "
    "last_name string, email string, secondary_email string, mobile_number string, mobile_number_country_code string, "
    "headline_description string, linked_in_url string, career_goals string, business_experience_summary string, "
    "profile_picture string, location_id bigint, company_id bigint, role_id bigint, has_finder boolean, "
    "created_at timestamp, updated_at timestamp, deleted_at timestamp",
    "experiences": "id bigint, person_id bigint, company_id bigint, role_id bigint, project_id bigint, location_id bigint, "
    "description string, start_date string, end_date string, type string, created_at timestamp, updated_at timestamp, "
    "deleted_at timestamp",
    "education": "id bigint, person_id bigint, school_id bigint, degree_id bigint, field_of_study string, "
    "description string, start_date string, end_date string, created_at timestamp, updated_at timestamp, deleted_at timestamp",
    "collections": "id bigint, person_id bigint, name string, description string, privacy string, created_at timestamp, "
    "updated_at timestamp, deleted_at timestamp",
    "query_votes": "id bigint, type string, profile_id bigint, voter_id bigint, score int, search_key string, "
    "actual_query string, remarks string, created_at timestamp, updated_at timestamp, deleted_at timestamp",
    "view_access": "id bigint, person_id bigint, type string, viewed_person_id bigint, expiry timestamp, metadata string, "
    "created_at timestamp, updated_at timestamp, deleted_at timestamp",
    "glossary": "id bigint, term string, meaning string, category string, description string, created_at timestamp, "
    "updated_at timestamp",
    "social_persons": "id string, external_id string, iam_id string, email string, first_name string, last_name string, "
    "company_name string, role_title string, employment_status string, created_at timestamp, updated_at timestamp, "
    "deleted_at timestamp",
    "posts": "id string, person_id string, type string, content string, link_url string, media_keys array<string>, "
    "status string, group_id string, created_at timestamp, updated_at timestamp, deleted_at timestamp",
    "comments": "id string, post_id string, person_id string, content string, parent_comment_id string, "
    "created_at timestamp, updated_at timestamp, deleted_at timestamp",
    "groups": "id string, name string, description string, created_by string, created_at timestamp, updated_at timestamp, "
    "deleted_at timestamp",
    "group_members": "id string, group_id string, person_id string, role string, confirmed_at timestamp, "
    "created_at timestamp, updated_at timestamp, deleted_at timestamp",
    "mentions": "id string, mentioned_person_id string, post_id string, comment_id string, created_at timestamp, "
    "deleted_at timestamp",
    "graph_edges": "source_node_id string, source_node_type string, relationship_type string, target_node_id string, "
    "target_node_type string",
    "graph_nodes": "node_id string, node_type string, name string",
    "conversations": "id string, conversation_type string, created_by string, created_at timestamp, updated_at timestamp",
    "conversation_participants": "conversation_id string, person_id string, folder string, notification_level string, "
    "last_read_at timestamp, left_at timestamp, created_at timestamp, updated_at timestamp",
    "messages": "id string, conversation_id string, sender_id string, message_type string, body string, status string, "
    "created_at timestamp, updated_at timestamp",
    "message_reads": "message_id string, person_id string, read_at timestamp, created_at timestamp",
    "message_attachments": "id string, message_id string, storage_key string, mime_type string, file_size_bytes bigint, "
    "metadata string, created_at timestamp",
    "message_reactions": "message_id string, person_id string, reaction_type string, created_at timestamp",
}

# Parent table and key columns of the tables whose rows need a known owner: child -> (child key, parent, parent key).
OWNERS: dict[str, tuple[str, str, str]] = {
    "experiences": ("person_id", "persons", "id"),
    "education": ("person_id", "persons", "id"),
    "collections": ("person_id", "persons", "id"),
    "query_votes": ("voter_id", "persons", "id"),
    "view_access": ("person_id", "persons", "id"),
    "posts": ("person_id", "social_persons", "id"),
    "comments": ("person_id", "social_persons", "id"),
    "groups": ("created_by", "social_persons", "id"),
    "group_members": ("person_id", "social_persons", "id"),
    "mentions": ("mentioned_person_id", "social_persons", "id"),
}


def schema(name: str) -> StructType:
    """Schema of a staging table."""
    return StructType.fromDDL(STAGING[name])


def fixture_schema(name: str) -> StructType:
    return StructType.fromDDL(TEST_TABLES[name])
