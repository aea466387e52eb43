"""Scans stay narrow. That no query joins without an equality is checked with its results in test_oracles."""

from agorakit.operators import graphprofile
from agorakit.plans.inputs import Inputs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from agorakit.operators import kpis

    path = str(tmp_path / "events")
    spark.sql(
        "SELECT 1L AS user_id, 'post' AS activity_type, TIMESTAMP '2001-08-01 00:00:00' AS activity_date, 'unused' AS source_table"
    ).write.parquet(path)
    events = spark.read.parquet(path)
    plan = _plan(kpis.retained_from_previous(events, "2001-08-02 12:00:00"))
    assert "GreaterThanOrEqual(activity_date,2001-07-01 00:00:00.0)" in plan
    assert "ReadSchema: struct<user_id:bigint,activity_date:timestamp>" in plan


def test_unused_counts_are_not_computed(spark, sf_dir):
    from agorakit.plans.inputs import Inputs

    plan = _plan(Inputs(spark, sf_dir).lazy_users.select("user_id", "email"))
    assert plan.count("FileScan") == 2


def test_edges_and_nodes_read_stored_spells(spark, sf_dir):
    """Lines are read to store the spells, not again by each union branch; both forms of the tables have the same rows."""
    i = Inputs(spark, sf_dir)
    for bound, name in ((i.edges, "fx_edges"), (i.nodes, "fx_nodes"), (i.rels, "fx_rels")):
        assert "lineitem" not in "".join(bound.inputFiles()) and "lineitem" in "".join(i[name].inputFiles())
        assert bound.schema == i[name].schema and bound.exceptAll(i[name]).isEmpty() and i[name].exceptAll(bound).isEmpty()


def test_orphans_join_all_nodes_at_once(spark):
    """Nodes come from a union; null ids and repeated nodes without an edge are orphans of their label."""
    parts = [spark.createDataFrame(rows, "node_id string, node_type string, name string") for rows in (
        [("a", "A", "x"), (None, "A", "x"), ("b", "A", None)], [("c", "C", "x"), ("c", "C", "x"), ("a", "C", "x"), ("d", None, "x")])]
    nodes = parts[0].unionByName(parts[1])
    edges = spark.createDataFrame([("a", "z"), ("a", "b"), (None, "a")], "source_node_id string, target_node_id string")
    found = graphprofile.orphans(nodes, edges)
    assert sorted(map(tuple, found.collect())) == [("A", 1), ("C", 2), ("Unknown", 1)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_links_are_shuffled_one_way(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "b"), ("c", "c"), (None, "a"), ("a", None), ("b", "c")], "source_node_id string, target_node_id string")
    links = graphprofile._undirected(edges)
    assert sorted(map(tuple, links.collect())) == [("a", "b"), ("b", "a"), ("b", "c"), ("c", "b")]
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")
