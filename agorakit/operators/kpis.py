"""Daily, monthly and snapshot KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorakit.functions.exprs import (
    clock, engagement_score, month_of, pct, ratio, standard_population, zero_if_null, zero_unless,
)

# Activity type -> (daily count column, distinct actor column).
TYPE_COLUMNS = {
    "post": ("posts_created", "active_posters"),
    "comment": ("comments_created", "active_commenters"),
    "vote": ("votes_cast", "active_voters"),
    "collection": ("collections_created", "active_collectors"),
    "view": ("views_given", None),
}
# Fixed value: completion score from which a profile counts as completed.
COMPLETED_SCORE = 70


def _is(kind: str) -> Column:
    return F.col("activity_type") == kind


def _user_days(events: DataFrame) -> DataFrame:
    """Counts by type per (date, user). Distinct users per date are then plain row counts: no Expand."""
    return events.groupBy(F.to_date("activity_date").alias("activity_date"), "user_id").agg(
        *[F.count_if(_is(kind)).alias(count) for kind, (count, _) in TYPE_COLUMNS.items()]
    )


def _day_measures() -> list[Column]:
    measures = [F.count(F.lit(1)).alias("dau")]
    for count, actors in TYPE_COLUMNS.values():
        measures.append(F.sum(count).alias(count))
        if actors:
            measures.append(F.count_if(F.col(count) > 0).alias(actors))
    return measures


def _finder_flags(users: DataFrame) -> DataFrame:
    return standard_population(users).select("user_id", "has_finder")


def _active_by_type() -> list[Column]:
    return [
        F.count_if(F.col("has_finder")).alias("finder_active"),
        F.count_if(~F.col("has_finder")).alias("standard_active"),
    ]


def daily_signups(users: DataFrame) -> DataFrame:
    return (
        standard_population(users)
        .groupBy(F.to_date("signup_date").alias("signup_date"))
        .agg(
            F.count(F.lit(1)).alias("new_users"),
            F.count_if("has_finder").alias("new_finders"),
            F.count_if(~F.col("has_finder")).alias("new_standards"),
        )
    )


def daily_activity(events: DataFrame) -> DataFrame:
    """Active users, counts by type and distinct actors per date. Test accounts are counted."""
    return _user_days(events).groupBy("activity_date").agg(*_day_measures())


def daily_active_by_type(events: DataFrame, users: DataFrame) -> DataFrame:
    user_days = events.select(F.to_date("activity_date").alias("activity_date"), "user_id").distinct()
    return user_days.join(_finder_flags(users), "user_id").groupBy("activity_date").agg(*_active_by_type())


def date_series(users: DataFrame, as_of) -> DataFrame:
    """Every date from the first signup of any user to the clock's date; none if the clock is before it."""
    today = F.to_date(clock(as_of))
    span = users.agg(F.min(F.to_date("signup_date")).alias("first_date")).where(F.col("first_date") <= today)
    return span.select(F.explode(F.sequence("first_date", today)).alias("metric_date"))


def _signups_on_series(users: DataFrame, as_of) -> DataFrame:
    signups = daily_signups(users).withColumnRenamed("signup_date", "metric_date")
    # The running window is one partition of dates, whose number does not grow with the data.
    running = Window.orderBy("metric_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        date_series(users, as_of)
        .join(signups, "metric_date", "left")
        .fillna(0, ["new_users", "new_finders", "new_standards"])
        .withColumn("total_users_cumulative", F.sum("new_users").over(running))
    )


def cumulative_users(users: DataFrame, as_of) -> DataFrame:
    return _signups_on_series(users, as_of).select("metric_date", "total_users_cumulative")


def daily_metrics(users: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """The daily KPI table. Events are read and shuffled once for all activity columns."""
    activity = (
        _user_days(events)
        .join(_finder_flags(users), "user_id", "left")
        .groupBy(F.col("activity_date").alias("metric_date"))
        .agg(*_day_measures(), *_active_by_type())
    )
    total, active = F.col("total_users_cumulative"), F.col("dau")
    social = F.col("active_posters") + F.col("active_commenters")
    counts = [c for c, _ in TYPE_COLUMNS.values()] + [a for _, a in TYPE_COLUMNS.values() if a]
    return (
        _signups_on_series(users, as_of)
        .join(activity, "metric_date", "left")
        .select(
            "metric_date",
            F.col("new_users").alias("new_signups"),
            F.col("new_users").alias("total_users"),
            "total_users_cumulative",
            zero_if_null("dau"),
            *[zero_if_null(name) for name in counts],
            zero_if_null("finder_active"),
            zero_if_null("standard_active"),
            F.col("new_finders").alias("new_finder_signups"),
            F.col("new_standards").alias("new_standard_signups"),
            # NULL, not 0, on days without activity once there are users.
            zero_unless(total > 0, pct(active, total)).alias("engagement_rate"),
            zero_unless(active > 0, pct(social, active)).alias("social_engagement_rate"),
        )
    )


def monthly_rollup(daily: DataFrame) -> DataFrame:
    return daily.groupBy(month_of(F.col("metric_date")).alias("metric_month")).agg(
        F.sum("new_signups").alias("new_signups"),
        F.max("total_users_cumulative").alias("total_users_end_of_month"),
        F.count_if(F.col("dau") > 0).alias("active_days"),
        F.count(F.lit(1)).alias("total_days"),
        F.avg("dau").alias("avg_dau"),
        F.sum("posts_created").alias("total_posts"),
        F.sum("comments_created").alias("total_comments"),
        F.sum("votes_cast").alias("total_votes"),
        F.sum("collections_created").alias("total_collections"),
        F.max("finder_active").alias("finder_mau"),
        F.max("standard_active").alias("standard_mau"),
    )


def monthly_active(events: DataFrame, users: DataFrame) -> DataFrame:
    per_user = events.groupBy(month_of(F.col("activity_date")).alias("metric_month"), "user_id").agg(
        F.count(F.lit(1)).alias("activities")
    )
    return (
        per_user.join(standard_population(users).select("user_id"), "user_id", "left_semi")
        .groupBy("metric_month")
        .agg(F.count(F.lit(1)).alias("mau"), F.sum("activities").alias("total_activities"))
    )


def monthly_activation(users: DataFrame) -> DataFrame:
    return (
        standard_population(users)
        .groupBy(month_of(F.col("signup_date")).alias("metric_month"))
        .agg(F.count(F.lit(1)).alias("cohort_users"), F.count_if("activation_status").alias("activated_users"))
    )


def retained_from_previous(events: DataFrame, as_of) -> DataFrame:
    """Users active in the clock's month and in the one before: one grouped pass over two months, no self join."""
    this_month = month_of(clock(as_of))
    last_month = F.add_months(this_month, -1)
    at = F.col("activity_date")
    both = (
        events.where((at >= last_month.cast("timestamp")) & (at < F.add_months(this_month, 1).cast("timestamp")))
        .groupBy("user_id")
        .agg(F.max(at).alias("_latest"), F.min(at).alias("_earliest"))
        .where((F.col("_latest") >= this_month.cast("timestamp")) & (F.col("_earliest") < this_month.cast("timestamp")))
    )
    return both.agg(F.count(F.lit(1)).alias("retained_from_prev")).select(
        this_month.alias("metric_month"), "retained_from_prev"
    )


def monthly_metrics(daily: DataFrame, events: DataFrame, users: DataFrame, as_of) -> DataFrame:
    joined = (
        monthly_rollup(daily)
        .join(monthly_active(events, users), "metric_month", "left")
        .join(monthly_activation(users), "metric_month", "left")
    )
    # Only the clock's month has a retained count, so it is one value, not a join.
    retained_now = retained_from_previous(events, as_of).select("retained_from_prev").scalar()
    retained = F.when(F.col("metric_month") == month_of(clock(as_of)), retained_now)
    # One partition of months, whose number does not grow with the data.
    by_month = Window.orderBy("metric_month")
    previous_total = F.lag("total_users_end_of_month").over(by_month)
    previous_mau = F.lag("mau").over(by_month)
    total, mau = F.col("total_users_end_of_month"), F.col("mau")
    score = engagement_score(*[F.col(f"total_{name}") for name in ("posts", "comments", "votes", "collections")])
    return joined.select(
        "metric_month", "new_signups", "total_users_end_of_month",
        zero_unless(previous_total > 0, pct(total - previous_total, previous_total)).alias("growth_rate_pct"),
        zero_if_null("mau"),
        F.round("avg_dau", 2).alias("avg_dau"),
        "total_posts", "total_comments", "total_votes", "total_collections",
        zero_unless(F.col("cohort_users") > 0, pct(F.col("activated_users"), F.col("cohort_users"))).alias("activation_rate"),
        zero_unless(mau > 0, ratio(F.col("total_activities"), mau)).alias("avg_activities_per_user"),
        zero_unless(mau > 0, ratio(score, mau)).alias("avg_engagement_score"),
        zero_if_null("finder_mau"), zero_if_null("standard_mau"),
        zero_unless(total > 0, pct(F.col("finder_mau"), total)).alias("finder_adoption_pct"),
        F.coalesce(retained, F.lit(0).cast("bigint")).alias("retained_from_prev_month"),
        zero_unless(previous_mau > 0, pct(retained, previous_mau)).alias("retention_rate"),
    )


def post_metrics(events: DataFrame) -> DataFrame:
    """Post, comment and vote measures per date. Ratios are NULL on dates without posts."""
    linked, with_media = F.col("metadata.has_link"), F.col("metadata.has_media")
    per_user = (
        events.where(F.col("activity_type").isin("post", "comment", "vote"))
        .groupBy(F.to_date("activity_date").alias("metric_date"), "user_id")
        .agg(
            F.count_if(_is("post")).alias("posts"),
            F.count_if(_is("comment")).alias("comments"),
            F.count_if(_is("vote")).alias("votes"),
            F.count_if(_is("post") & ~linked & ~with_media).alias("text_posts"),
            F.count_if(_is("post") & linked).alias("link_posts"),
            F.count_if(_is("post") & with_media).alias("media_posts"),
        )
    )
    daily = per_user.groupBy("metric_date").agg(
        F.sum("posts").alias("posts_created"),
        F.sum("comments").alias("comments_created"),
        F.sum("votes").alias("total_votes"),
        F.count_if(F.col("posts") > 0).alias("unique_posters"),
        F.count_if(F.col("comments") > 0).alias("unique_commenters"),
        *[F.sum(name).alias(name) for name in ("text_posts", "link_posts", "media_posts")],
    )
    posts, comments, votes = F.col("posts_created"), F.col("comments_created"), F.col("total_votes")
    return daily.select(
        "metric_date", "posts_created", "comments_created", "unique_posters", "unique_commenters",
        ratio(posts, F.col("unique_posters")).alias("avg_posts_per_poster"),
        ratio(comments, posts).alias("avg_comments_per_post"),
        ratio(votes, posts).alias("avg_votes_per_post"),
        pct(comments, posts).alias("engagement_rate_comments_pct"),
        pct(votes, posts).alias("engagement_rate_votes_pct"),
        "total_votes", "text_posts", "link_posts", "media_posts",
    )


def finder_metrics(events: DataFrame) -> DataFrame:
    per_user = (
        events.where(F.col("activity_type").isin("vote", "view"))
        .groupBy(F.to_date("activity_date").alias("metric_date"), "user_id")
        .agg(F.count_if(_is("vote")).alias("votes"), F.count_if(_is("view")).alias("views"))
    )
    return per_user.groupBy("metric_date").agg(
        F.sum("votes").alias("total_votes"),
        F.count_if(F.col("votes") > 0).alias("unique_voters"),
        F.sum("views").alias("profiles_viewed"),
        F.count_if(F.col("views") > 0).alias("unique_profile_viewers"),
    )


def collection_metrics(events: DataFrame) -> DataFrame:
    privacy = F.col("metadata.privacy")
    per_user = (
        events.where(_is("collection"))
        .groupBy(F.to_date("activity_date").alias("metric_date"), "user_id")
        .agg(
            F.count(F.lit(1)).alias("made"),
            F.count_if(privacy == "PUBLIC").alias("public"),
            F.count_if(privacy == "PRIVATE").alias("private"),
        )
    )
    return per_user.groupBy("metric_date").agg(
        F.sum("made").alias("total_collections_created"),
        F.sum("public").alias("public_collections"),
        F.sum("private").alias("private_collections"),
        F.count(F.lit(1)).alias("unique_collectors"),
    )


def profile_metrics(
    users: DataFrame, persons: DataFrame, experiences: DataFrame, education: DataFrame, as_of
) -> DataFrame:
    """One-row profile snapshot. Each count is an uncorrelated scalar subquery over its own table."""
    today = F.to_date(clock(as_of))

    def count_on_day(df: DataFrame, ts: str, *extra: Column) -> Column:
        found = df.where(F.col("deleted_at").isNull() & (F.to_date(ts) == today))
        for test in extra:
            found = found.where(test)
        return found.agg(F.count(F.lit(1)).alias("n")).scalar()

    details = persons.select(F.col("id").alias("user_id"), "headline_description", "linked_in_url", "location_id")
    summary = (
        standard_population(users)
        .select("user_id", "profile_completion_score", "experience_count", "education_count")
        .join(details, "user_id")
        .agg(
            F.round(F.avg("profile_completion_score"), 2).alias("avg_profile_completion_score"),
            F.count("headline_description").alias("profiles_with_headline"),
            F.count("linked_in_url").alias("profiles_with_linkedin"),
            F.count("location_id").alias("profiles_with_location"),
            F.count_if(F.col("experience_count") > 0).alias("profiles_with_experience"),
            F.count_if(F.col("education_count") > 0).alias("profiles_with_education"),
        )
    )
    changed = F.col("updated_at") != F.col("created_at")
    return summary.select(
        today.alias("metric_date"),
        count_on_day(persons, "updated_at", changed).alias("profiles_updated"),
        count_on_day(experiences, "created_at").alias("experiences_added"),
        count_on_day(education, "created_at").alias("education_added"),
        *summary.columns,
    )


def funnel_metrics(users: DataFrame, as_of) -> DataFrame:
    """One-row signup funnel. The basic-info count asks for an email, its rate does not."""
    total = F.count(F.lit(1))
    named = F.col("first_name").isNotNull() & F.col("last_name").isNotNull()
    steps = {
        "experience": F.count_if(F.col("experience_count") > 0),
        "education": F.count_if(F.col("education_count") > 0),
        "completion": F.count_if(F.col("profile_completion_score") >= COMPLETED_SCORE),
        "activation": F.count_if("activation_status"),
    }
    counts = standard_population(users).agg(
        total.alias("total_signups"),
        F.count_if(named & F.col("email").isNotNull()).alias("profiles_with_basic_info"),
        steps["experience"].alias("profiles_with_experience"),
        steps["education"].alias("profiles_with_education"),
        steps["completion"].alias("profiles_completed"),
        steps["activation"].alias("profiles_activated"),
        pct(F.count_if(named), total).alias("basic_info_rate"),
        *[pct(step, total).alias(f"{name}_rate") for name, step in steps.items()],
    )
    return counts.select(F.to_date(clock(as_of)).alias("metric_date"), *counts.columns)
