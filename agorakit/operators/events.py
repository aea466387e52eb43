"""The activity event stream: posts, comments, votes, collections and views as one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorakit.functions.exprs import hex_key, json_text, key_type, optional, whole_days

# Metadata fields of each activity type, with their types.
METADATA_FIELDS = {
    "post": {"type": "string", "status": "string", "has_link": "boolean", "has_media": "boolean"},
    "comment": {"post_id": "string", "is_reply": "boolean"},
    "vote": {"type": "string", "score": "bigint", "profile_id": "bigint"},
    "collection": {"name": "string", "privacy": "string"},
    "view": {"type": "string", "expiry": "timestamp"},
}
ALL_FIELDS = {name: kind for fields in METADATA_FIELDS.values() for name, kind in fields.items()}
SOURCE_TABLES = {
    "post": "posts", "comment": "comments", "vote": "query_votes", "collection": "collections", "view": "view_access",
}
EXPIRY_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def flag_first(df: DataFrame, owner: str, ts: str, flag: str = "is_first_activity_of_type") -> DataFrame:
    """Mark rows at the owner's earliest timestamp, soft-deleted rows included in the search for it.

    A map-side-combined minimum joined back, not a window: one owner may hold most of the rows, and
    the join lets adaptive execution split that owner over many tasks.
    """
    firsts = df.groupBy(F.col(owner).alias("_owner")).agg(F.min(ts).alias("_first_at"))
    return (
        df.join(firsts, F.col(owner) == F.col("_owner"))
        .withColumn(flag, F.col(ts) == F.col("_first_at"))
        .drop("_owner", "_first_at")
    )


def event_day(df: DataFrame) -> DataFrame:
    """Whole days between signup and the event; negative before signup."""
    return df.withColumn("days_since_signup", whole_days(F.col("activity_date"), F.col("signup_date")))


def _metadata(kind: str, values: dict[str, Column]) -> Column:
    fields = [
        (values[name] if name in values else F.lit(None)).cast(dtype).alias(name) for name, dtype in ALL_FIELDS.items()
    ]
    return F.struct(*fields).alias("metadata")


def _rows(kind: str, source: DataFrame, owner: str, database: str, source_id: Column, values: dict[str, Column]) -> DataFrame:
    return source.select(
        F.col(owner).alias("_owner_key"),
        F.lit(kind).alias("activity_type"),
        F.col("created_at").alias("activity_date"),
        F.lit(database).alias("source_database"),
        F.lit(SOURCE_TABLES[kind]).alias("source_table"),
        source_id.cast("bigint").alias("source_id"),
        _metadata(kind, values),
        "deleted_at",
    )


def _attach(rows: DataFrame, users: DataFrame, user_key: str) -> DataFrame:
    """Join live rows to their users.

    One small row per owner and type carries both the signup and the owner's first activity, so the
    event rows are joined once and never windowed; a hot owner is left to adaptive skew splitting.
    """
    dtype = key_type((rows, "_owner_key"), (users, user_key))
    rows = rows.withColumn("_owner_key", F.col("_owner_key").cast(dtype))
    owners = users.select(F.col(user_key).cast(dtype).alias("_owner_key"), "user_id", "signup_date")
    firsts = (
        rows.where(F.col("_owner_key").isNotNull())
        .groupBy("_owner_key", "activity_type")
        .agg(F.min("activity_date").alias("_first_at"))
        .join(owners, "_owner_key")
    )
    joined = rows.where(F.col("deleted_at").isNull()).join(firsts, ["_owner_key", "activity_type"])
    return event_day(joined).select(
        "user_id", "activity_type", "activity_date", "source_database", "source_table", "source_id", "metadata",
        "days_since_signup", (F.col("activity_date") == F.col("_first_at")).alias("is_first_activity_of_type"),
    )


def _post_rows(posts: DataFrame, database: str) -> DataFrame:
    values = {
        "type": F.col("type"), "status": F.col("status"),
        "has_link": F.col("link_url").isNotNull(), "has_media": F.col("media_keys").isNotNull(),
    }
    return _rows("post", posts, "person_id", database, hex_key(F.col("id")), values)


def _comment_rows(comments: DataFrame, database: str) -> DataFrame:
    values = {"post_id": F.col("post_id"), "is_reply": F.col("parent_comment_id").isNotNull()}
    return _rows("comment", comments, "person_id", database, hex_key(F.col("id")), values)


def _vote_rows(votes: DataFrame, database: str) -> DataFrame:
    values = {name: F.col(name) for name in METADATA_FIELDS["vote"]}
    return _rows("vote", votes, "voter_id", database, F.col("id"), values)


def _collection_rows(collections: DataFrame, database: str) -> DataFrame:
    values = {name: F.col(name) for name in METADATA_FIELDS["collection"]}
    return _rows("collection", collections, "person_id", database, F.col("id"), values)


def _view_rows(views: DataFrame, database: str) -> DataFrame:
    values = {"type": F.col("type"), "expiry": optional(views, "expiry", "timestamp")}
    return _rows("view", views, "person_id", database, F.col("id"), values)


def post_events(posts: DataFrame, users: DataFrame, database: str = "social") -> DataFrame:
    return _attach(_post_rows(posts, database), users, "engagement_person_id")


def comment_events(comments: DataFrame, users: DataFrame, database: str = "social") -> DataFrame:
    return _attach(_comment_rows(comments, database), users, "engagement_person_id")


def vote_events(votes: DataFrame, users: DataFrame, database: str = "profile") -> DataFrame:
    return _attach(_vote_rows(votes, database), users, "user_id")


def collection_events(collections: DataFrame, users: DataFrame, database: str = "profile") -> DataFrame:
    return _attach(_collection_rows(collections, database), users, "user_id")


def view_events(views: DataFrame, users: DataFrame, database: str = "profile") -> DataFrame:
    return _attach(_view_rows(views, database), users, "user_id")


def activity_events(
    posts: DataFrame, comments: DataFrame, votes: DataFrame, collections: DataFrame, views: DataFrame, users: DataFrame,
    *, databases: tuple[str, str] = ("social", "profile"),
) -> DataFrame:
    """All events of known users. ``metadata`` is one struct with every type's fields; see ``metadata_json``.

    Sources that share an owner key are joined to users together: two joins for five sources.
    """
    social, profile = databases
    by_social = _post_rows(posts, social).unionByName(_comment_rows(comments, social))
    by_profile = reduce(
        DataFrame.unionByName,
        [_vote_rows(votes, profile), _collection_rows(collections, profile), _view_rows(views, profile)],
    )
    return _attach(by_social, users, "engagement_person_id").unionByName(_attach(by_profile, users, "user_id"))


def metadata_json(events: DataFrame) -> DataFrame:
    """Render ``metadata`` as JSON text holding only the fields of the row's activity type."""

    def field(name: str) -> Column:
        value = F.col(f"metadata.{name}")
        return (F.date_format(value, EXPIRY_FORMAT) if name == "expiry" else value).alias(name)

    text = F.lit(None).cast("string")
    for kind, fields in METADATA_FIELDS.items():
        text = F.when(F.col("activity_type") == kind, json_text(F.struct(*[field(n) for n in fields]))).otherwise(text)
    return events.withColumn("metadata", text)
