"""The batch refresh: named stages that write tables, each reading only what earlier stages wrote."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from agorakit.operators import cohorts, events, graph, kpis, networks, segments, users
from agorakit.operators.graph import STUDIED, WORKED
from agorakit.sources.schemas import OWNERS
from agorakit.sources.published import is_published
from agorakit.sources.scans import keep_owned, scan_active
from agorakit.sources.sinks import missing_tables, read_full, write_full

METRICS_SCHEMA = "step bigint, stage string, status string, rows bigint, seconds double, error string"


@dataclass
class Warehouse:
    """Source frames by name, the folder written tables live in, and the clock."""

    spark: SparkSession
    root: str
    sources: dict[str, DataFrame]
    as_of: str
    test_emails: Sequence[str] | DataFrame = ()
    written: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.written:
            return self.written[name]
        if name in self.sources:
            source = self.sources[name]
            if name in OWNERS and "deleted_at" in source.columns:
                key, parent, parent_key = OWNERS[name]
                return keep_owned(source, self[parent], key, parent_key)
            return source
        return read_full(self.spark, self.path(name))

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def store(self, name: str, df: DataFrame) -> int:
        rows = write_full(df, self.path(name), keep_old_if_empty=False)
        self.written[name] = read_full(self.spark, self.path(name), df.schema)
        return rows


@dataclass(frozen=True)
class Stage:
    name: str
    build: Callable[[Warehouse], DataFrame]
    needs: tuple[str, ...] = ()


def _users(w: Warehouse) -> DataFrame:
    names = "persons social_persons experiences education posts comments query_votes collections mentions group_members view_access"
    return users.unified_users(*[w[n] for n in names.split()], as_of=w.as_of, test_emails=w.test_emails)


def _relationships(w: Warehouse) -> DataFrame:
    """Both kinds in linear form, a row for each group and member."""
    worked, studied = (graph.relationship_groups(w["graph_edges"], w["graph_nodes"], w["unified_users"], kind) for kind in (WORKED, STUDIED))
    return worked.unionByName(studied)


def _graph_stage(build: Callable[..., DataFrame]) -> Callable[[Warehouse], DataFrame]:
    return lambda w: build(w["graph_edges"], w["graph_nodes"], w["unified_users"])


_GRAPH = ("unified_users", "graph_edges", "graph_nodes")

STAGES: tuple[Stage, ...] = (
    Stage("unified_users", _users),
    Stage("glossary_terms", lambda w: users.publish_glossary(w["glossary"])),
    Stage(
        "activity_events",
        lambda w: events.activity_events(*[w[n] for n in "posts comments query_votes collections view_access".split()], w["unified_users"]),
        ("unified_users",),
    ),
    Stage("user_cohorts", lambda w: cohorts.user_cohorts(w["unified_users"]), ("unified_users",)),
    Stage("relationship_members", _graph_stage(graph.relationship_members), _GRAPH),
    Stage("user_relationships", _relationships, _GRAPH),
    Stage("company_members", _graph_stage(graph.company_members), _GRAPH),
    Stage("company_networks", lambda w: graph.company_networks(w["company_members"]), ("company_members",)),
    Stage("school_members", _graph_stage(graph.school_members), _GRAPH),
    Stage("education_networks", lambda w: graph.education_networks(w["school_members"]), ("school_members",)),
    Stage("location_members", _graph_stage(graph.location_members), _GRAPH),
    Stage("location_networks", lambda w: graph.location_networks(w["location_members"]), ("location_members",)),
    Stage("project_members", _graph_stage(graph.project_members), _GRAPH),
    Stage("project_collaborations", lambda w: graph.project_collaborations(w["project_members"]), ("project_members",)),
    Stage(
        "career_paths",
        lambda w: graph.career_paths(w["graph_edges"], w["graph_nodes"], w["unified_users"], w.as_of),
        _GRAPH,
    ),
    Stage(
        "daily_metrics",
        lambda w: kpis.daily_metrics(w["unified_users"], w["activity_events"], w.as_of),
        ("unified_users", "activity_events"),
    ),
    Stage(
        "monthly_metrics",
        lambda w: kpis.monthly_metrics(w["daily_metrics"], w["activity_events"], w["unified_users"], w.as_of),
        ("daily_metrics", "activity_events", "unified_users"),
    ),
    Stage(
        "cohort_retention",
        lambda w: cohorts.cohort_retention(w["unified_users"], w["activity_events"], w.as_of),
        ("unified_users", "activity_events"),
    ),
    Stage("post_metrics", lambda w: kpis.post_metrics(w["activity_events"]), ("activity_events",)),
    Stage("finder_metrics", lambda w: kpis.finder_metrics(w["activity_events"]), ("activity_events",)),
    Stage("collection_metrics", lambda w: kpis.collection_metrics(w["activity_events"]), ("activity_events",)),
    Stage(
        "profile_metrics",
        lambda w: kpis.profile_metrics(w["unified_users"], w["persons"], w["experiences"], w["education"], w.as_of),
        ("unified_users",),
    ),
    Stage("funnel_metrics", lambda w: kpis.funnel_metrics(w["unified_users"], w.as_of), ("unified_users",)),
    Stage(
        "connection_recommendations",
        lambda w: networks.connection_recommendations(w["relationship_members"]),
        ("relationship_members",),
    ),
    Stage("company_network_map", lambda w: networks.company_network_map(w["company_members"]), ("company_members",)),
    Stage(
        "skills_matching",
        lambda w: networks.skills_matching(w["company_members"], w["unified_users"], w.as_of),
        ("company_members", "unified_users"),
    ),
    Stage("career_path_patterns", lambda w: networks.career_path_patterns(w["company_members"]), ("company_members",)),
    Stage(
        "location_based_networks",
        lambda w: networks.location_based_networks(w["location_members"], w["company_members"]),
        ("location_members", "company_members"),
    ),
    Stage(
        "alumni_networks",
        lambda w: networks.alumni_networks(w["school_members"], w["company_members"]),
        ("school_members", "company_members"),
    ),
    Stage(
        "project_collaboration_graph",
        lambda w: networks.project_graph(w["project_collaborations"], w["company_members"]),
        ("project_collaborations", "company_members"),
    ),
    Stage(
        "connection_summary",
        lambda w: networks.connection_summary(w["relationship_members"]),
        ("relationship_members",),
    ),
    Stage(
        "top_connected_users",
        lambda w: networks.top_connected(w["unified_users"], w["relationship_members"]),
        ("unified_users", "relationship_members"),
    ),
    Stage("company_talent_pools", lambda w: networks.talent_pools(w["company_members"]), ("company_members",)),
    Stage("user_engagement_levels", lambda w: segments.engagement_levels(w["unified_users"], w.as_of), ("unified_users",)),
    Stage("activation_training", lambda w: segments.activation_training(w["unified_users"], w.as_of), ("unified_users",)),
    Stage(
        "engagement_training",
        lambda w: segments.engagement_training(w["unified_users"], w["activity_events"], w["user_engagement_levels"], w.as_of),
        ("unified_users", "activity_events", "user_engagement_levels"),
    ),
)


STAGED = tuple(f"staging_{name}" for name in ("persons", "social_persons", *OWNERS, "glossary", "graph_nodes", "graph_edges"))


def _stage_source(name: str) -> Callable[[Warehouse], DataFrame]:
    """A source as it is kept: rows that are not deleted, and of child tables those with a kept owner."""

    def build(w: Warehouse) -> DataFrame:
        source = w.sources[name]
        if "deleted_at" not in source.columns:
            return source
        rows = scan_active(source, source.columns)
        if name not in OWNERS:
            return rows
        key, parent, parent_key = OWNERS[name]
        return keep_owned(rows, w[f"staging_{parent}"], key, parent_key)

    return build


#: One stage for each source; child tables come after their parents.
STAGING_STAGES: tuple[Stage, ...] = tuple(
    Stage(s, _stage_source(name), (name, *([f"staging_{OWNERS[name][1]}"] if name in OWNERS else [])))
    for s in STAGED for name in [s.removeprefix("staging_")]
)


def ordered(stages: Sequence[Stage]) -> list[list[Stage]]:
    """Stages in waves: each wave needs only what earlier waves write, so its stages are independent. A cycle raises an error."""
    waiting, names, done, waves = list(stages), {s.name for s in stages}, set(), []
    while waiting:
        wave = [s for s in waiting if not (set(s.needs) & names) - done]
        if not wave:
            raise ValueError(f"stages need each other: {', '.join(s.name for s in waiting)}")
        waves.append(wave)
        done |= {s.name for s in wave}
        waiting = [s for s in waiting if s not in wave]
    return waves


def run(
    warehouse: Warehouse, stages: Sequence[Stage] = STAGES, only: Sequence[str] | None = None, *, resume: bool = False, together: int = 1
) -> tuple[DataFrame, int]:
    """Run stages by their needs and return their metrics and an exit status (0 if all went well).

    A failed stage does not stop the run, but stages that need its table are skipped, as are stages whose source tables
    are absent. ``only`` picks stages by name; what these need is read from the warehouse folder. Up to ``together`` stages that do not
    need each other run at once. The run log is kept in the warehouse; with ``resume`` a stage that the last log has as ok, and that needs
    nothing that runs again, keeps its table and is logged as "kept".
    """
    known = {stage.name for stage in stages}
    chosen = [s for s in stages if only is None or s.name in only]
    log = warehouse.path("run_log")
    before = {r.stage: r for r in read_full(warehouse.spark, log).collect()} if resume and is_published(warehouse.spark, log) else {}
    failed: set[str] = set()
    again: set[str] = set()
    rows: dict[str, tuple] = {}

    def one(stage: Stage) -> tuple:
        started = time.monotonic()
        last = before.get(stage.name)
        if last is not None and last.status in ("ok", "kept") and not again.intersection(stage.needs):
            return "kept", last.rows, 0.0, None
        absent = [n for n in stage.needs if n not in known and n not in warehouse.sources]
        absent = missing_tables(warehouse.spark, absent)
        broken = [n for n in stage.needs if n in failed]
        if absent or broken:
            return "skipped", 0, 0.0, f"missing: {', '.join(absent + broken)}"
        try:
            count = warehouse.store(stage.name, stage.build(warehouse))
            return "ok", count, time.monotonic() - started, None
        except Exception as error:  # a stage may fail for any reason; the run goes on and reports it
            return "failed", 0, time.monotonic() - started, str(error)[:500]

    with ThreadPoolExecutor(max(together, 1)) as pool:
        for wave in ordered(chosen):
            for stage, found in zip(wave, pool.map(one, wave)):
                rows[stage.name] = found
                if found[0] != "kept":
                    again.add(stage.name)
                if found[0] in ("failed", "skipped"):
                    failed.add(stage.name)
    metrics = warehouse.spark.createDataFrame([(step, s.name, *rows[s.name]) for step, s in enumerate(chosen)], METRICS_SCHEMA)
    write_full(metrics, log, keep_old_if_empty=False)
    return metrics, int(bool(failed))
