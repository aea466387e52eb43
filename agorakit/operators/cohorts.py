"""Signup cohorts and weekly retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorakit.functions.exprs import clock, month_of, pct, standard_population, whole_days

# Retention horizons in days, longest followed week, slowest activation that counts in the average.
RETENTION_DAYS = (30, 60, 90)
LAST_WEEK = 52
ACTIVATION_DAY_LIMIT = 10_000


def user_cohorts(users: DataFrame) -> DataFrame:
    """One row per signup month: size, profile averages, activation and 30/60/90-day retention."""
    total = F.count(F.lit(1))
    activated = F.count_if("activation_status")

    def average(name: str) -> Column:
        return F.round(F.avg(name), 2)

    def retained(days: int) -> Column:
        return F.count_if(F.col("last_activity_date") >= F.col("signup_date") + F.make_dt_interval(F.lit(days)))

    in_time = F.when(F.col("days_to_first_activity") < ACTIVATION_DAY_LIMIT, F.col("days_to_first_activity"))
    return (
        standard_population(users)
        .groupBy(month_of(F.col("signup_date")).alias("cohort_month"))
        .agg(
            total.alias("total_users"),
            F.count_if("has_finder").alias("finder_users"),
            F.count_if(~F.col("has_finder")).alias("standard_users"),
            average("profile_completion_score").alias("avg_profile_completion"),
            average("experience_count").alias("avg_experience_count"),
            average("education_count").alias("avg_education_count"),
            activated.alias("activated_users"),
            pct(activated, total).alias("activation_rate"),
            F.round(F.avg(in_time), 2).alias("avg_days_to_activation"),
            *[retained(d).alias(f"retained_{d}d") for d in RETENTION_DAYS],
            *[pct(retained(d), total).alias(f"retention_rate_{d}d") for d in RETENTION_DAYS],
        )
    )


def week_bucket(ts: Column, signup: Column) -> Column:
    """Week since signup that holds ``ts``, from 0; NULL before signup or beyond the last followed week.

    Day differences truncate toward zero, so a timestamp hours before signup would land in week 0
    without the explicit comparison.
    """
    week = F.floor(whole_days(ts, signup) / 7)
    return F.when((ts >= signup) & (week <= LAST_WEEK), week)


def _cohort_users(users: DataFrame, as_of) -> DataFrame:
    """Each user's cohort and the last week that has started by the clock's date."""
    today = F.date_trunc("day", clock(as_of))
    last = F.least(F.lit(LAST_WEEK).cast("bigint"), F.floor(whole_days(today, F.col("signup_date")) / 7))
    return (
        standard_population(users)
        .where(F.col("signup_date") <= today)
        .select(month_of(F.col("signup_date")).alias("cohort_month"), "user_id", "signup_date", last.alias("last_week"))
    )


def cohort_weeks(users: DataFrame, as_of) -> DataFrame:
    """Users by every week since signup that has started: a per-row expansion, no join."""
    weeks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last_week")))
    return _cohort_users(users, as_of).select(
        "cohort_month", weeks.alias("weeks_since_signup"), "user_id", "signup_date"
    )


def _active_weeks(users: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """Activity counts of the (user, week) pairs that have any: an equi-join on the user and a computed week."""
    week = week_bucket(F.col("activity_date"), F.col("signup_date"))
    return (
        events.select("user_id", "activity_date")
        .join(_cohort_users(users, as_of), "user_id")
        .withColumn("weeks_since_signup", week)
        .where(F.col("weeks_since_signup") <= F.col("last_week"))
        .groupBy("cohort_month", "weeks_since_signup", "user_id")
        .agg(F.count(F.lit(1)).alias("activities"))
    )


def cohort_activity(users: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """Activities per user and started week, zero where there were none."""
    keys = ["cohort_month", "weeks_since_signup", "user_id"]
    return (
        cohort_weeks(users, as_of)
        .join(_active_weeks(users, events, as_of), keys, "left")
        .select(*keys, F.coalesce("activities", F.lit(0).cast("bigint")).alias("activities"))
    )


def cohort_retention(users: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """Retention curve per cohort.

    Cohort sizes per week come from counting users by their last started week and summing from the
    far end, so users are never multiplied by weeks.
    """
    by_last = _cohort_users(users, as_of).groupBy("cohort_month", "last_week").agg(F.count(F.lit(1)).alias("users"))
    sizes = (
        by_last.select(
            "cohort_month", "users",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last_week"))).alias("weeks_since_signup"),
        )
        .groupBy("cohort_month", "weeks_since_signup")
        .agg(F.sum("users").alias("total_users"))
    )
    active = (
        _active_weeks(users, events, as_of)
        .groupBy("cohort_month", "weeks_since_signup")
        .agg(F.count(F.lit(1)).alias("retained_users"), F.sum("activities").alias("total_activities"))
    )
    base = F.first("total_users").over(Window.partitionBy("cohort_month").orderBy("weeks_since_signup"))
    return (
        sizes.join(active, ["cohort_month", "weeks_since_signup"], "left")
        .fillna(0, ["retained_users", "total_activities"])
        .withColumn("_base", base)
        .select(
            "cohort_month", "weeks_since_signup", "total_users", "retained_users",
            pct(F.col("retained_users"), F.col("total_users")).alias("retention_rate"),
            pct(F.col("retained_users"), F.col("_base")).alias("cumulative_retention"),
            F.round(F.try_divide(F.col("total_activities").cast("double"), F.col("retained_users").cast("double")), 2)
            .alias("avg_activities_per_user"),
            "total_activities",
        )
    )
