"""User unification: one row per live profile, with counts, dates, lifecycle stage and activation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorakit.functions.exprs import blank_to_null, clock, key_type, optional, whole_days
from agorakit.sources.scans import dedupe_first

# Lifecycle thresholds in days and completion weights in points.
CHURNED_AFTER, DORMANT_AFTER, NEW_UNTIL = 90, 30, 7
COMPLETION_POINTS = {
    "first_name": 10, "last_name": 10, "email": 10, "headline": 15,
    "linked_in": 10, "experience": 20, "education": 15, "location": 10,
}
HEADLINE_MIN_CHARS = 10

# Kind of source row -> output count column.
COUNT_COLUMNS = {
    "experience": "experience_count", "education": "education_count", "post": "posts_created",
    "comment": "comments_made", "vote": "votes_cast", "collection": "collections_created",
    "mention": "mentions_received", "member": "groups_joined", "view": "views_given",
}
NULL_SPREAD = 1_024
DATED_KINDS = ("post", "comment", "vote", "collection")
OUTPUT_COLUMNS = (
    "user_id engagement_person_id person_id email first_name last_name has_finder user_type experience_count education_count "
    "profile_completion_score posts_created comments_made votes_cast collections_created mentions_received groups_joined "
    "views_given signup_date last_activity_date first_post_date first_vote_date days_since_signup days_to_first_activity "
    "user_lifecycle_stage activation_status activated_at is_test_account created_at updated_at deleted_at"
).split()


def merge_identity(persons: DataFrame, social: DataFrame, link: tuple[str, str] = ("id", "external_id")) -> DataFrame:
    """Live profiles left-joined with their social person; profile values win over social values."""
    ours, theirs = link
    link_type = key_type((persons, ours), (social, theirs))
    matched = dedupe_first(
        social.select(
            F.col(theirs).cast(link_type).alias("_link"),
            F.col("id").alias("engagement_person_id"),
            optional(social, "email").alias("_email"),
            optional(social, "first_name").alias("_first"),
            optional(social, "last_name").alias("_last"),
        ),
        "_link",
        "engagement_person_id",
    )
    return (
        persons.where(F.col("deleted_at").isNull())
        .withColumn("_link", F.col(ours).cast(link_type))
        .join(matched, "_link", "left")
        .withColumn("user_id", F.col("id"))
        .withColumn("person_id", optional(persons, "person_id"))
        .withColumn("email", F.coalesce("email", "_email"))
        .withColumn("first_name", F.coalesce("first_name", "_first"))
        .withColumn("last_name", F.coalesce("last_name", "_last"))
        .withColumn("signup_date", F.col("created_at"))
        .drop("_link", "_email", "_first", "_last")
    )


def user_type(df: DataFrame) -> DataFrame:
    known = F.coalesce("has_finder", F.lit(False))
    return df.withColumn("has_finder", known).withColumn(
        "user_type", F.when(F.col("has_finder"), "FINDER").otherwise("STANDARD")
    )


def _tagged(kind: str, df: DataFrame, key: str, dtype: str) -> DataFrame:
    return df.select(
        F.col(key).cast(dtype).alias("_key"),
        F.lit(kind).alias("_kind"),
        optional(df, "created_at", "timestamp").cast("timestamp").alias("_at"),
        F.col("deleted_at").isNull().alias("_live"),
    )


def _rollup(sources: dict[str, tuple[DataFrame, str]], users: DataFrame, user_key: str) -> DataFrame:
    """Counts and dates of several sources per owner, keyed by ``user_key``."""
    dtype = key_type((users, user_key), *sources.values())
    tagged = [_tagged(kind, df, key, dtype) for kind, (df, key) in sources.items()]
    rows = reduce(DataFrame.unionByName, tagged).where(F.col("_key").isNotNull())
    of_kind = {kind: F.col("_kind") == kind for kind in sources}
    aggregates = [F.count_if(of_kind[k] & F.col("_live")).alias(COUNT_COLUMNS[k]) for k in sources]
    for kind in (k for k in sources if k in DATED_KINDS):
        aggregates.append(F.min(F.when(of_kind[kind], F.col("_at"))).alias(f"first_{kind}_at"))
        aggregates.append(F.max(F.when(of_kind[kind], F.col("_at"))).alias(f"last_{kind}_at"))
    totals = rows.groupBy("_key").agg(*aggregates).withColumn("_spread", F.lit(0))
    # Users without this key match nothing; dealt by a second key they do not meet in one task.
    spread = F.when(F.col(user_key).isNull(), F.pmod(F.xxhash64("user_id"), F.lit(NULL_SPREAD)).cast("int") + 1).otherwise(0)
    found = users.withColumn("_spread_of", spread)
    match = (F.col(user_key).cast(dtype) == F.col("_key")) & (F.col("_spread_of") == F.col("_spread"))
    return found.join(totals, match, "left").drop("_key", "_spread", "_spread_of")


def activity_counts(
    identities: DataFrame, experiences: DataFrame, education: DataFrame, posts: DataFrame, comments: DataFrame,
    votes: DataFrame, collections: DataFrame, mentions: DataFrame, members: DataFrame, views: DataFrame,
) -> DataFrame:
    """Nine live-row counts plus first/last dates (deleted rows included) per user.

    The sources that share a key are unioned and aggregated once, so nine lookups cost two
    map-side-combined shuffles and two joins, whatever one key's share of the rows.
    """
    of_profile = {
        "experience": (experiences, "person_id"), "education": (education, "person_id"), "vote": (votes, "voter_id"),
        "collection": (collections, "person_id"), "view": (views, "person_id"),
    }
    of_social = {
        "post": (posts, "person_id"), "comment": (comments, "person_id"),
        "mention": (mentions, "mentioned_person_id"), "member": (members, "person_id"),
    }
    joined = _rollup(of_social, _rollup(of_profile, identities, "user_id"), "engagement_person_id")
    return joined.fillna(0, list(COUNT_COLUMNS.values()))


def _own(df: DataFrame, name: str) -> Column:
    """The profile's own value, before any fallback to the social person."""
    return F.col(f"profile_{name}") if f"profile_{name}" in df.columns else F.col(name)


def completion_score(df: DataFrame) -> DataFrame:
    """Completion points from 0 to 100, judged on the profile's own values."""
    filled = {
        "first_name": F.length(_own(df, "first_name")) > 0,
        "last_name": F.length(_own(df, "last_name")) > 0,
        "email": _own(df, "email").isNotNull(),
        "headline": F.length("headline_description") > HEADLINE_MIN_CHARS,
        "linked_in": F.col("linked_in_url").isNotNull(),
        "experience": F.col("experience_count") > 0,
        "education": F.col("education_count") > 0,
        "location": F.col("location_id").isNotNull(),
    }
    points = [F.when(test, COMPLETION_POINTS[name]).otherwise(0) for name, test in filled.items()]
    return df.withColumn("profile_completion_score", reduce(Column.__add__, points).cast("bigint"))


def last_activity(df: DataFrame) -> DataFrame:
    """Latest of profile update and any post, comment, vote or collection, deleted ones included."""
    since = [F.coalesce(f"last_{kind}_at", "signup_date") for kind in DATED_KINDS]
    return df.withColumn("last_activity_date", F.greatest("updated_at", *since))


def first_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("first_post_date", F.col("first_post_at")).withColumn("first_vote_date", F.col("first_vote_at"))


def days_since(df: DataFrame, as_of) -> DataFrame:
    return df.withColumn("days_since_signup", whole_days(clock(as_of), F.col("signup_date")))


def activated_at(df: DataFrame) -> DataFrame:
    """Earliest post, comment, vote or collection; NULL for users with none."""
    return df.withColumn("activated_at", F.least(*[f"first_{kind}_at" for kind in DATED_KINDS]))


def days_to_first(df: DataFrame) -> DataFrame:
    return activated_at(df).withColumn(
        "days_to_first_activity", whole_days(F.col("activated_at"), F.col("signup_date"))
    )


def activation_status(df: DataFrame) -> DataFrame:
    """True once a post, vote or collection exists, deleted or not. Comments do not activate."""
    seen = [F.col(f"first_{kind}_at").isNotNull() for kind in ("post", "vote", "collection")]
    return df.withColumn("activation_status", reduce(Column.__or__, seen))


def lifecycle_stage(df: DataFrame, as_of) -> DataFrame:
    now = clock(as_of)
    latest = F.greatest(
        "updated_at", F.coalesce("last_post_at", "signup_date"), F.coalesce("last_vote_at", "signup_date")
    )
    quiet_days = whole_days(now, latest)
    stage = (
        F.when(quiet_days > CHURNED_AFTER, "CHURNED")
        .when(quiet_days > DORMANT_AFTER, "DORMANT")
        .when(F.col("activation_status"), "ENGAGED")
        .when(whole_days(now, F.col("signup_date")) <= NEW_UNTIL, "NEW")
        .otherwise("ACTIVATED")
    )
    return df.withColumn("user_lifecycle_stage", stage)


def flag_test_accounts(df: DataFrame, test_emails: Sequence[str] | DataFrame) -> DataFrame:
    """Mark users whose profile email is on the list. The list may be a frame with an ``email`` column."""
    email = _own(df, "email")
    if isinstance(test_emails, DataFrame):
        listed = test_emails.select(F.col("email").alias("_test_email")).where(F.col("_test_email").isNotNull()).distinct()
        return (
            df.join(listed, email == F.col("_test_email"), "left")
            .withColumn("is_test_account", F.col("_test_email").isNotNull())
            .drop("_test_email")
        )
    return df.withColumn("is_test_account", F.coalesce(email.isin(list(test_emails)), F.lit(False)))


def unified_users(
    persons: DataFrame, social: DataFrame, experiences: DataFrame, education: DataFrame, posts: DataFrame,
    comments: DataFrame, votes: DataFrame, collections: DataFrame, mentions: DataFrame, members: DataFrame,
    views: DataFrame, *, as_of, test_emails: Sequence[str] | DataFrame = (), link: tuple[str, str] = ("id", "external_id"),
) -> DataFrame:
    """The unified user table."""
    # The score and the test flag look at the profile's own values, so keep those next to the merged ones.
    own = persons.select("*", *[F.col(c).alias(f"profile_{c}") for c in ("email", "first_name", "last_name")])
    users = user_type(merge_identity(own, social, link))
    users = activity_counts(
        users, experiences, education, posts, comments, votes, collections, mentions, members, views
    )
    users = days_to_first(first_dates(last_activity(completion_score(users))))
    users = lifecycle_stage(activation_status(days_since(users, as_of)), as_of)
    return flag_test_accounts(users, test_emails).select(*OUTPUT_COLUMNS)


def publish_glossary(glossary: DataFrame) -> DataFrame:
    """Glossary terms with a description; blanks become NULL and the first non-blank field is the display value."""
    cleaned = {name: blank_to_null(F.col(name)) for name in ("term", "meaning", "category")}
    return glossary.where(blank_to_null(F.col("description")).isNotNull()).select(
        F.col("id").alias("glossary_id"),
        *[column.alias(name) for name, column in cleaned.items()],
        "description",
        F.coalesce(*cleaned.values()).alias("display_value"),
        optional(glossary, "created_at", "timestamp").alias("created_at"),
        optional(glossary, "updated_at", "timestamp").alias("updated_at"),
    )
