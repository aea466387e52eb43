"""Lazy access to the bound inputs and the two shared derived tables for one data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from agorakit.operators import events as ev
from agorakit.operators import graph as gr
from agorakit.operators import kpis, segments
from agorakit.operators import users as us
from agorakit.session import cut
from agorakit.sources.bindings import VIEWS, placeholders
from agorakit.sources.schemas import fixture_schema

AS_OF = "2001-08-02 12:00:00"


_PLANS: dict[tuple[str, str], dict[str, DataFrame]] = {}


class Inputs:
    """Input frames by view name. Everything stays lazy and no session-wide view is registered."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        # Plans of the bound inputs are shared by all queries of a session; nothing computed is.
        self._frames = _PLANS.setdefault((spark.sparkContext.applicationId, self.folder), {})

    def frame(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in VIEWS:
                self._frames[name] = self._bound(name, {})
            else:
                path = f"{self.folder}/{name}.parquet"
                self._frames[name] = self.spark.read.schema(fixture_schema(name)).parquet(path)
        return self._frames[name]

    __getitem__ = frame

    def _bound(self, name: str, given: dict[str, DataFrame]) -> DataFrame:
        sql, used = placeholders(VIEWS[name])
        return self.spark.sql(sql, **{table: given[table] if table in given else self.frame(table) for table in used})

    @cached_property
    def test_emails(self) -> DataFrame:
        return self["fx_persons"].where("id % 50 = 0").select("email")

    def users_as_of(self, as_of: str) -> DataFrame:
        names = "persons engagement_persons work study posts comments votes collections mentions group_members views".split()
        return us.unified_users(*[self[f"fx_{n}"] for n in names], as_of=as_of, test_emails=self.test_emails)

    @cached_property
    def lazy_users(self) -> DataFrame:
        """The unified user table as a plan: queries that read few of its columns compute only those."""
        return self.users_as_of(AS_OF)

    @cached_property
    def users(self) -> DataFrame:
        """The unified user table, stored once, for queries that read its counts more than once."""
        return cut(self.lazy_users, "unified-users")

    @cached_property
    def events(self) -> DataFrame:
        names = "posts comments votes collections views".split()
        return ev.activity_events(*[self[f"fx_{n}"] for n in names], self.lazy_users)

    @cached_property
    def stored_events(self) -> DataFrame:
        return cut(self.events, "activity-events")

    @cached_property
    def levels(self) -> DataFrame:
        return segments.engagement_levels(self.lazy_users, AS_OF)

    @cached_property
    def daily(self) -> DataFrame:
        return kpis.daily_metrics(self.lazy_users, self.events, AS_OF)

    @cached_property
    def spells(self) -> dict[str, DataFrame]:
        """Experiences and education, stored once: they feed most union branches of edges and nodes."""
        return {name: cut(self[name], name) for name in ("fx_experiences", "fx_education")}

    @cached_property
    def edges(self) -> DataFrame:
        """Edges as a plan over the stored spells."""
        return self._bound("fx_edges", self.spells)

    @cached_property
    def nodes(self) -> DataFrame:
        """Nodes as a plan over the stored spells."""
        return self._bound("fx_nodes", self.spells)

    @cached_property
    def rels(self) -> DataFrame:
        """Relationships with their ends' properties as a plan over the stored spells."""
        return self._bound("fx_rels", {"fx_edges": self.edges})

    @cached_property
    def graph(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Edge and node tables as extraction stores them, and the users they map to."""
        people = self.lazy_users.select("user_id", "email")
        return cut(self.edges, "graph-edges"), cut(self.nodes, "graph-nodes"), people

    @cached_property
    def planned_graph(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The graph with edges as a plan over the stored spells: a query that reads few types of edges makes no others."""
        return self.edges, cut(self.nodes, "graph-nodes"), self.lazy_users.select("user_id", "email")

    @cached_property
    def lazy_graph(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The graph as plans over the stored spells, for queries that store what they read of it: no edge or node is stored."""
        return self.edges, self.nodes, self.lazy_users.select("user_id", "email")

    @cached_property
    def lazy_company_members(self) -> DataFrame:
        """Members of companies as a plan: what reads no role of a user does not put its companies and roles together."""
        return self.company_rows.distinct()

    @cached_property
    def company_rows(self) -> DataFrame:
        """Members of companies as a plan whose rows may repeat, for queries that tell them apart themselves."""
        return gr.company_rows(*self.lazy_graph)

    @cached_property
    def company_members(self) -> DataFrame:
        return cut(self.lazy_company_members, "company-members")

    @cached_property
    def school_members(self) -> DataFrame:
        return cut(gr.school_members(*self.lazy_graph), "school-members")

    @cached_property
    def location_members(self) -> DataFrame:
        return cut(gr.location_members(*self.lazy_graph), "location-members")

    @cached_property
    def project_members(self) -> DataFrame:
        return cut(gr.project_members(*self.graph), "project-members")

    @cached_property
    def relationship_members(self) -> DataFrame:
        return gr.relationship_members(*self.planned_graph)

    def chat(self, *names: str) -> list[DataFrame]:
        return [self[f"fx_{name}"] for name in names]
