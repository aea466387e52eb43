"""Table scans: active rows, orphan filter, graph nodes and edges, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorakit.functions.exprs import json_text, key_type

# Id properties of graph nodes in the order they are tried.
NODE_ID_PROPERTIES = (
    "person_id", "company_id", "role_id", "school_id", "degree_id",
    "location_id", "project_id", "language_id", "experience_id", "education_id",
)

# Output columns of each node label; the marked ones are dates kept as text.
NODE_COLUMNS = {
    "Person": ("person_id", "email", "secondary_email", "first_name", "last_name", "mobile_number", "mobile_number_country_code"),
    "Company": ("company_id", "company_name"),
    "Role": ("role_id", "title"),
    "School": ("school_id", "school_name"),
    "Degree": ("degree_id", "degree_name"),
    "Location": ("location_id", "country"),
    "Project": ("project_id", "project_name"),
    "Language": ("language_id", "language_name"),
    "Experience": ("experience_id", "start_date", "end_date", "type"),
    "Education": ("education_id", "start_date", "end_date", "field_of_study"),
}
TEXT_DATES = ("start_date", "end_date")


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet", **options: str) -> DataFrame:
    """Read a file table with a declared schema where one is given; nothing is inferred from data."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, split_column: str | None = None, bounds: tuple[int, int] | None = None,
    partitions: int = 32, fetch_size: int = 10_000, **options: str,
) -> DataFrame:
    """Read a database table, split into parallel range queries when a numeric key and its bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if split_column and bounds:
        reader = (
            reader.option("partitionColumn", split_column).option("lowerBound", bounds[0])
            .option("upperBound", bounds[1]).option("numPartitions", partitions)
        )
    return reader.options(**options).load()


def scan_active(df: DataFrame, cols: Sequence[str], deleted_col: str = "deleted_at") -> DataFrame:
    """Project the wanted columns of rows that are not soft-deleted."""
    return df.where(F.col(deleted_col).isNull()).select(*cols)


def keep_owned(child: DataFrame, owners: DataFrame, child_key: str, owner_key: str) -> DataFrame:
    """Keep child rows whose owner exists among ``owners``."""
    dtype = key_type((child, child_key), (owners, owner_key))
    known = owners.select(F.col(owner_key).cast(dtype).alias("_owner")).distinct()
    return child.join(known, F.col(child_key).cast(dtype) == F.col("_owner"), "left_semi")


def json_column(df: DataFrame, col: str) -> DataFrame:
    """Replace a nested column by its JSON text."""
    return df.withColumn(col, json_text(F.col(col)))


def scan_glossary(df: DataFrame) -> DataFrame:
    """All glossary rows; NULL descriptions are kept at this stage."""
    wanted = ("id", "term", "meaning", "category", "description", "created_at", "updated_at")
    return df.select(*[c for c in wanted if c in df.columns])


def nodes(df: DataFrame, label: str) -> DataFrame:
    """Rows of one node label with that label's columns. Dates are cast to text; absent properties are NULL."""
    if label not in NODE_COLUMNS:
        raise ValueError(f"unknown node label {label!r}; expected one of {sorted(NODE_COLUMNS)}")

    def column(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast("string").alias(name)
        return (F.col(name).cast("string") if name in TEXT_DATES else F.col(name)).alias(name)

    return df.where(F.col("label") == label).select(*[column(name) for name in NODE_COLUMNS[label]])


def dedupe_first(df: DataFrame, key: str, order: str | Sequence[str]) -> DataFrame:
    """One row per non-null key, the least in ``order``.

    ``min_by`` combines on the map side, so a key holding most of the rows never lands whole in one task.
    """
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    chosen = df.where(F.col(key).isNotNull()).groupBy(key).agg(best)
    return chosen.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def edge_list(rels: DataFrame) -> DataFrame:
    """Edge list from raw relationships.

    ``rels`` has structs ``a`` and ``b`` (``labels`` array, ``internal_id`` and any of the id properties) and ``type``.
    """

    def end(side: str, prefix: str) -> list[Column]:
        present = rels.schema[side].dataType.fieldNames()
        ids = [F.col(f"{side}.{name}").cast("string") for name in NODE_ID_PROPERTIES if name in present]
        return [
            F.coalesce(*ids, F.col(f"{side}.internal_id").cast("string")).alias(f"{prefix}_node_id"),
            F.try_element_at(F.col(f"{side}.labels"), F.lit(1)).alias(f"{prefix}_node_type"),
        ]

    return rels.select(*end("a", "source"), F.col("type").alias("relationship_type"), *end("b", "target"))


def active_count(df: DataFrame, deleted_col: str = "deleted_at") -> DataFrame:
    return df.where(F.col(deleted_col).isNull()).agg(F.count(F.lit(1)).alias("active_users"))
