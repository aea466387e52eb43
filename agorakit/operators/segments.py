"""Engagement segments and the two feature tables built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorakit.functions.exprs import (
    ACTIVE_SCORE, POWER_USER_SCORE, clock, engagement_score, month_of, standard_population, whole_days,
)

ACTION_COLUMNS = ("posts_created", "comments_made", "votes_cast", "collections_created")

# Feature windows and thresholds.
TRAINING_MONTHS, EXPORT_MONTHS = 12, 6
EARLY_DAYS, EARLY_HOURS_DAYS, SIGNAL_DAYS, OUTCOME_DAYS = 7, 1, 30, 90
ENGAGED_ACTIONS, COMPLETE_PROFILE = 3, 50

ACTIVATION_EXPORT = (
    "user_id has_finder experience_count education_count profile_completion_score signup_day_of_week signup_hour "
    "signup_month days_to_first_activity_7d activated_within_24h activated activated_social activated_finder became_engaged"
).split()
ENGAGEMENT_EXPORT = (
    "user_id has_finder profile_completion_score experience_count education_count days_since_signup first_30d_activities "
    "first_30d_activity_types completed_profile added_experience added_education became_power_user engagement_score_90d "
    "retained_90d churned final_engagement_level"
).split()


def _total_actions() -> Column:
    posts, comments, votes, collections = (F.col(c) for c in ACTION_COLUMNS)
    return posts + comments + votes + collections


def engagement_levels(users: DataFrame, as_of) -> DataFrame:
    score = engagement_score(*[F.col(c) for c in ACTION_COLUMNS])
    level = (
        F.when(score >= POWER_USER_SCORE, "POWER_USER")
        .when(score >= ACTIVE_SCORE, "ACTIVE")
        .when(_total_actions() > 0, "CASUAL")
        .when(F.col("last_activity_date").isNotNull(), "LURKER")
        .otherwise("INACTIVE")
    )
    return standard_population(users).select(
        "user_id", "email", "first_name", "last_name", "has_finder",
        score.alias("engagement_score"),
        level.alias("engagement_level"),
        *ACTION_COLUMNS,
        _total_actions().alias("total_activities"),
        "last_activity_date",
        whole_days(clock(as_of), F.col("last_activity_date")).alias("days_since_last_activity"),
        "signup_date", "days_since_signup", "user_lifecycle_stage",
        clock(as_of).alias("updated_at"),
    )


def training_start(as_of, months: int = TRAINING_MONTHS) -> Column:
    """First day of the month that many months before the clock."""
    return F.trunc(F.add_months(clock(as_of), -months), "month")


def _training_users(users: DataFrame, as_of) -> DataFrame:
    return standard_population(users).where(F.col("signup_date") >= training_start(as_of).cast("timestamp"))


def activation_training(users: DataFrame, as_of) -> DataFrame:
    days = F.col("days_to_first_activity")
    return _training_users(users, as_of).select(
        "user_id", "has_finder", "experience_count", "education_count", "profile_completion_score",
        (F.dayofweek("signup_date") - 1).cast("bigint").alias("signup_day_of_week"),
        F.hour("signup_date").cast("bigint").alias("signup_hour"),
        F.month("signup_date").cast("bigint").alias("signup_month"),
        F.when(days <= EARLY_DAYS, days).alias("days_to_first_activity_7d"),
        F.coalesce(days <= EARLY_HOURS_DAYS, F.lit(False)).alias("activated_within_24h"),
        F.col("activation_status").alias("activated"),
        ((F.col("posts_created") > 0) | (F.col("comments_made") > 0)).alias("activated_social"),
        ((F.col("votes_cast") > 0) | (F.col("collections_created") > 0)).alias("activated_finder"),
        (_total_actions() >= ENGAGED_ACTIONS).alias("became_engaged"),
        "days_to_first_activity",
        month_of(F.col("signup_date")).alias("cohort_month"),
        "signup_date", "created_at",
        clock(as_of).alias("generated_at"),
    )


def engagement_training(users: DataFrame, events: DataFrame, levels: DataFrame, as_of) -> DataFrame:
    """Features and labels of users followed for at least 90 days. Events before signup count as early signals."""
    early = (
        events.where(F.col("days_since_signup") <= SIGNAL_DAYS)
        .groupBy("user_id", "activity_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("user_id")
        .agg(F.sum("n").alias("first_30d_activities"), F.count(F.lit(1)).alias("first_30d_activity_types"))
    )
    outcome = levels.select("user_id", "engagement_score", "engagement_level")
    followed = F.col("signup_date") + F.make_dt_interval(F.lit(OUTCOME_DAYS))
    zero = F.lit(0).cast("bigint")
    return (
        _training_users(users, as_of)
        .where(F.col("days_since_signup") >= OUTCOME_DAYS)
        .join(early, "user_id", "left")
        .join(outcome, "user_id", "left")
        .select(
            "user_id", "has_finder", "profile_completion_score", "experience_count", "education_count", "days_since_signup",
            F.coalesce("first_30d_activities", zero).alias("first_30d_activities"),
            F.coalesce("first_30d_activity_types", zero).alias("first_30d_activity_types"),
            (F.col("profile_completion_score") >= COMPLETE_PROFILE).alias("completed_profile"),
            (F.col("experience_count") > 0).alias("added_experience"),
            (F.col("education_count") > 0).alias("added_education"),
            F.coalesce(F.col("engagement_level").isin("POWER_USER", "ACTIVE"), F.lit(False)).alias("became_power_user"),
            F.coalesce("engagement_score", zero).alias("engagement_score_90d"),
            F.coalesce(F.col("last_activity_date") >= followed, F.lit(False)).alias("retained_90d"),
            (F.col("user_lifecycle_stage") == "CHURNED").alias("churned"),
            F.coalesce("engagement_level", F.lit("INACTIVE")).alias("final_engagement_level"),
            month_of(F.col("signup_date")).alias("cohort_month"),
            "signup_date", "last_activity_date",
            clock(as_of).alias("generated_at"),
        )
    )


def _export_frame(training: DataFrame, columns: list[str], as_of) -> DataFrame:
    recent = training.where(F.col("cohort_month") >= training_start(as_of, EXPORT_MONTHS))
    flags = {f.name for f in training.schema.fields if f.dataType.simpleString() == "boolean"}
    return recent.select(*[F.col(c).cast("int").alias(c) if c in flags else F.col(c) for c in columns])


def activation_export_frame(training: DataFrame, as_of) -> DataFrame:
    """Recent cohorts of the activation features with flags as 0/1."""
    return _export_frame(training, ACTIVATION_EXPORT, as_of)


def engagement_export_frame(training: DataFrame, as_of) -> DataFrame:
    return _export_frame(training, ENGAGEMENT_EXPORT, as_of)
