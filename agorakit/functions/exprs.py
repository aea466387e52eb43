"""Column expressions shared by the operators. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Date formats and hash-key width that results depend on.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
MONTH_YEAR = r"^\d{1,2}-\d{4}$"
HEX_KEY_DIGITS = 15

# Engagement score weights and thresholds.
POST_WEIGHT, COMMENT_WEIGHT, VOTE_WEIGHT, COLLECTION_WEIGHT = 3, 2, 1, 5
POWER_USER_SCORE, ACTIVE_SCORE = 50, 20


def clock(as_of: datetime | str | Column) -> Column:
    """The caller's clock as a timestamp column. Operators never read the wall clock."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps, truncated toward zero. Unlike datediff, ignores midnights."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def whole_years(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("YEAR", earlier, later).cast("bigint")


def month_of(ts: Column) -> Column:
    return F.trunc(ts, "month")


def pct(part: Column, whole: Column) -> Column:
    """Percentage rounded to two places; NULL when the whole is 0 or NULL."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), 2)


def ratio(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), 2)


def zero_unless(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.lit(0.0))


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def hex_key(uuid_text: Column) -> Column:
    """First hex digits of a UUID as a non-negative bigint."""
    digits = F.substring(F.regexp_replace(uuid_text, "-", ""), 1, HEX_KEY_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def loose_timestamp(text: Column) -> Column:
    """Parse ``2011-04-30`` or ``4-2011``; anything else is NULL."""
    return F.when(text.rlike(ISO_DATE), F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))).when(
        text.rlike(MONTH_YEAR), F.try_to_timestamp(text, F.lit("M-yyyy"))
    )


def json_text(value: Column) -> Column:
    """JSON text that keeps null fields."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def contains_ignoring_case(text: Column, part: Column | str) -> Column:
    part = F.lit(part) if isinstance(part, str) else part
    return F.lower(text).contains(F.lower(part))


def engagement_score(posts: Column, comments: Column, votes: Column, collections: Column) -> Column:
    return posts * POST_WEIGHT + comments * COMMENT_WEIGHT + votes * VOTE_WEIGHT + collections * COLLECTION_WEIGHT


def standard_population(users: DataFrame) -> DataFrame:
    """Live users that are not test accounts: the population behind most KPIs."""
    return users.where(F.col("deleted_at").isNull() & ~F.col("is_test_account"))


def optional(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column if the frame has it, else a typed NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def key_type(*keys: tuple[DataFrame, str]) -> str:
    """Type in which the given (frame, column) keys can be compared: their own if they agree, else string.

    Keeping numeric keys numeric makes joins cheaper and lets a partitioning on the id be used again.
    """
    found = {df.schema[name].dataType.simpleString() for df, name in keys}
    if found <= {"int", "bigint"}:
        return "bigint"
    return found.pop() if len(found) == 1 else "string"
