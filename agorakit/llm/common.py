"""Helpers that several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of df has (column names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def dense_rank_in(df: DataFrame, group: list[str], bucket: Column, order: list[Column], out: str) -> DataFrame:
    """A gapless number from 0 within each group, without a task that holds a whole group.

    Rows are numbered by (bucket, order). Each bucket of a group is numbered by itself and starts where the buckets before it
    end, so a group with a third of all rows is worked on by as many tasks as there are buckets. The starts are one row
    per group and bucket.
    """
    part, start, size = fresh(df, "_bucket", "_start", "_size")
    dealt = df.withColumn(part, bucket)
    sizes = dealt.groupBy(*group, part).agg(F.count(F.lit(1)).alias(size))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(g).alias(f"{start}{i}") for i, g in enumerate(group)], F.col(part).alias(f"{part}b"),
                          F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start))
    own = Window.partitionBy(*group, part).orderBy(*order)
    numbered = dealt.withColumn(size, F.row_number().over(own) - 1)
    match = F.col(part) == F.col(f"{part}b")
    for i, g in enumerate(group):
        match = match & F.col(g).eqNullSafe(F.col(f"{start}{i}"))
    return numbered.join(starts, match).select(*df.columns, (F.col(start) + F.col(size)).cast("long").alias(out))
