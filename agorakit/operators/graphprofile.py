"""Profile of a property graph held as node and edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorakit.session import cut

HUBS, SAMPLES, SAMPLE_LABELS, PATTERN_ROWS = 20, 3, 5, 10


def label_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy(F.coalesce("node_type", F.lit("Unknown")).alias("node_type")).agg(F.count(F.lit(1)).alias("node_count"))


def relationship_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relationship_type").agg(F.count(F.lit(1)).alias("edge_count"))


def patterns(edges: DataFrame) -> DataFrame:
    return edges.groupBy(
        F.col("source_node_type").alias("from_node"), F.col("relationship_type").alias("relationship"),
        F.col("target_node_type").alias("to_node"),
    ).agg(F.count(F.lit(1)).alias("edge_count"))


def property_profile(df: DataFrame, label: str, properties: Sequence[str]) -> DataFrame:
    """Per label and property: declared type, rows that have it, and whether all do.

    One grouped pass over all rows; properties no row of a label has are left out.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(p).alias(f"_n_{p}") for p in properties]
    )
    entries = [
        F.struct(F.lit(p).alias("property"), F.lit(types[p]).alias("property_type"), F.col(f"_n_{p}").alias("present"))
        for p in properties
    ]
    return (
        counts.select("label", "_rows", F.explode(F.array(*entries)).alias("_p"))
        .where(F.col("_p.present") > 0)
        .select("label", "_p.property", "_p.property_type", "_p.present", (F.col("_p.present") == F.col("_rows")).alias("mandatory"))
    )


def _ends(edges: DataFrame) -> DataFrame:
    """Both ends of every edge as node ids."""
    return edges.select(F.explode(F.array("source_node_id", "target_node_id")).alias("node_id"))


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without any edge, counted per label.

    A left join and not an anti join, which Spark would make for each part of a union of nodes by itself, with all ends each time.
    """
    linked = _ends(edges).distinct().withColumn("_linked", F.lit(True))
    alone = nodes.select("node_id", "node_type").join(linked, "node_id", "left").where(F.col("_linked").isNull())
    return label_counts(alone).withColumnRenamed("node_count", "orphan_count")


def hubs(nodes: DataFrame, edges: DataFrame, k: int = HUBS) -> DataFrame:
    """The ``k`` nodes with the most edge ends. Degrees combine before the shuffle, so a huge hub costs one row a task."""
    degrees = _ends(edges).groupBy("node_id").agg(F.count(F.lit(1)).alias("connection_count"))
    return (
        nodes.join(degrees, "node_id")
        .select("node_type", "node_id", F.coalesce("name", F.lit("N/A")).alias("name"), "connection_count")
        .orderBy(F.desc("connection_count"), "node_id")
        .limit(k)
    )


def samples(nodes: DataFrame, n: int = SAMPLES, labels: int = SAMPLE_LABELS) -> DataFrame:
    """The first ``n`` nodes by id of each of the first labels in alphabetical order."""
    last_label = nodes.select("node_type").distinct().orderBy("node_type").limit(labels).agg(F.max("node_type")).scalar()
    place = F.row_number().over(Window.partitionBy("node_type").orderBy("node_id"))
    return (
        nodes.where(F.col("node_type") <= last_label)
        .withColumn("_place", place)
        .where(F.col("_place") <= n)
        .select("node_type", "node_id", "name")
    )


def missing_and_ranges(nodes: DataFrame, date: Column, required: str = "name") -> DataFrame:
    """Per label: rows, rows whose required property is missing or blank, and the range of a date."""
    dated = nodes.withColumn("_date", date)
    return dated.groupBy("node_type").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(required).isNull() | (F.col(required) == "")).alias("missing"),
        F.min("_date").alias("oldest_record"),
        F.max("_date").alias("newest_record"),
    )


def both_patterns(edges: DataFrame, rel_a: str, rel_b: str, k: int = PATTERN_ROWS) -> DataFrame:
    """Nodes with edges of both types and the distinct targets of each, by total: one pass, no join of the two sets."""
    found = edges.where(F.col("relationship_type").isin(rel_a, rel_b)).select(
        F.col("source_node_id").alias("node_id"), "relationship_type", "target_node_id"
    ).distinct()
    counts = found.groupBy("node_id").agg(
        F.count_if(F.col("relationship_type") == rel_a).alias("count_a"),
        F.count_if(F.col("relationship_type") == rel_b).alias("count_b"),
    )
    return (
        counts.where((F.col("count_a") > 0) & (F.col("count_b") > 0))
        .orderBy(F.desc(F.col("count_a") + F.col("count_b")), "node_id")
        .limit(k)
    )


def neighbourhood(edges: DataFrame, node_id: str) -> DataFrame:
    """Edges at one node in either direction, seen from it."""
    outgoing = edges.where(F.col("source_node_id") == node_id).select(
        F.lit("OUT").alias("direction"), "relationship_type", F.col("target_node_id").alias("node_id"),
        F.col("target_node_type").alias("node_type"),
    )
    incoming = edges.where(F.col("target_node_id") == node_id).select(
        F.lit("IN").alias("direction"), "relationship_type", F.col("source_node_id").alias("node_id"),
        F.col("source_node_type").alias("node_type"),
    )
    return outgoing.unionByName(incoming)


def _undirected(edges: DataFrame) -> DataFrame:
    """Different links, both ways. Each pair of ends is shuffled once and turned round after that."""
    apart = edges.where(F.col("source_node_id") != F.col("target_node_id"))
    pairs = apart.select(F.least("source_node_id", "target_node_id").alias("_x"), F.greatest("source_node_id", "target_node_id").alias("_y")).distinct()
    ways = F.array(F.struct(F.col("_x").alias("a"), F.col("_y").alias("b")), F.struct(F.col("_y").alias("a"), F.col("_x").alias("b")))
    return pairs.select(F.inline(ways))


def shortest_path_length(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Length of the shortest undirected path, NULL if there is none. No number of hops is set.

    Breadth-first search from both ends: the side with the smaller frontier takes the next step, until a step reaches what the other side
    has seen or finds nothing new. Links, frontiers and seen nodes are stored tables; counts alone reach the driver.
    """
    spark = edges.sparkSession
    links = cut(_undirected(edges), "links")
    fronts = [spark.createDataFrame([(end,)], "node string") for end in (src, dst)]
    seen, sizes, length = list(fronts), [1, 1], 0 if src == dst else None
    steps = 0
    while length is None and all(sizes):
        k = int(sizes[1] < sizes[0])
        step = links.join(fronts[k], links["a"] == fronts[k]["node"], "left_semi").select(F.col("b").alias("node")).distinct()
        fronts[k] = cut(step.join(seen[k], "node", "left_anti"), "front")
        steps += 1
        sizes[k] = fronts[k].count()
        if not fronts[k].join(seen[1 - k], "node", "left_semi").isEmpty():
            length = steps
        seen[k] = cut(seen[k].unionByName(fronts[k]), "seen") if steps % 8 == 0 else seen[k].unionByName(fronts[k])
    return spark.createDataFrame([(src, dst, length)], "source_node_id string, target_node_id string, path_length bigint")
