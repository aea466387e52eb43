"""Memberships behind relationships: no edge table is stored for them, and repeated and undated rows change nothing."""

from datetime import datetime

from agorakit.operators import graph
from agorakit.operators.graph import WORKED
from agorakit.plans.catalog import queries


def test_worked_together_stores_no_edges(spark, sf_dir, monkeypatch):
    from agorakit.plans import inputs

    stored, cut = [], inputs.cut
    monkeypatch.setattr(inputs, "cut", lambda df, label="stored": stored.append(label) or cut(df, label))
    queries()["n1_worked_together"](spark, sf_dir)
    assert "graph-nodes" in stored and "graph-edges" not in stored


def test_memberships_of_repeated_and_undated_rows(spark):
    node = "node_id string, node_type string, name string"
    nodes = [("P1", "Person", "a"), ("P2", "Person", "a"), ("P3", "Person", "b"), ("P4", "Person", None), ("C", "Company", "Firm"), ("X1", "Experience", "2001-02-03"),
             ("X2", "Experience", "2000-01-01"), ("X3", "Experience", "n/a"), ("X3", "Experience", "n/a")]
    edges = [("P1", "Person", "WORKED_AT", "C", "Company"), ("P2", "Person", "KNOWS", "C", "Company"), ("P3", "Person", "VISITED", "C", "Company"),
             ("P1", "Person", "WORKED_AT", "D", "Company"), ("P4", "Person", "WORKED_AT", "C", "Company"), ("P3", "Person", None, "C", "Company"),
             *[(p, "Person", "EXPERIENCED_IN", x, "Experience") for p, x in (("P1", "X1"), ("P2", "X2"), ("P3", "X3"))],
             *[(x, "Experience", "WORKED_AT", "C", "Company") for x in ("X1", "X2", "X3")]]
    nodes = spark.createDataFrame(nodes, node)
    edges = spark.createDataFrame(edges * 3, "source_node_id string, source_node_type string, relationship_type string, target_node_id string, target_node_type string")
    users = spark.createDataFrame([(1, "a"), (2, "b"), (None, "a"), (3, None)], "user_id bigint, email string")
    found = graph.target_members(edges, nodes, users, WORKED).select("grp", "member", "ord", "leads", "since", "label")
    want = [("C", 1, "P1", True, datetime(2000, 1, 1), "Firm"), ("C", 2, "P3", False, None, "Firm")]
    assert sorted(map(tuple, found.collect())) == want
    direct = graph.target_members(edges, nodes, users, WORKED, hop="direct").select("grp", "member", "ord", "leads", "since", "label")
    assert sorted(map(tuple, direct.collect())) == [(*r[:4], None, r[5]) for r in want]
    # Two joins by spell, one by person node for edges and dates together, one for the sort key of users, one for the name.
    plan = graph.target_members(edges, nodes, users, WORKED)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 5
