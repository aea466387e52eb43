"""Sinks, checks, the stage runner and streaming merges."""

from pyspark.sql import functions as F

from agorakit.plans.catalog import warehouse
from agorakit.plans.inputs import Inputs
from agorakit.plans.pipeline import STAGES, STAGING_STAGES, Stage, ordered, run
from agorakit.sources import published, scans, sinks
from agorakit.streaming import streams


def test_full_refresh_keeps_old_rows_when_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_full(spark.range(3), path) == 3
    assert sinks.write_full(spark.range(0), path) == 0
    assert sinks.read_full(spark, path).count() == 3
    assert sinks.write_full(spark.range(2), path) == 2
    assert sinks.write_full(spark.range(0), path, keep_old_if_empty=False) == 0
    assert sinks.read_full(spark, path, "id long").count() == 0


def test_upsert_last_row_wins_and_prune(spark):
    now = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "id long, v long, x string")
    new = spark.createDataFrame([(2, 1, "c"), (2, 2, "d"), (3, 1, "e")], "id long, v long, x string")
    merged = sinks.upsert(now, new, ["id"], order="v")
    assert sorted(tuple(r) for r in merged.collect()) == [(1, 0, "a"), (2, 2, "d"), (3, 1, "e")]
    assert [r.id for r in sinks.prune(merged, new, ["id"]).orderBy("id").collect()] == [2, 3]


def test_missing_tables_keep_order(spark):
    spark.range(1).createOrReplaceTempView("there")
    assert sinks.missing_tables(spark, ["nope", "there", "neither"]) == ["nope", "neither"]


def test_dedupe_first_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 0, "z")], "k string, o long, v string")
    assert [tuple(r) for r in scans.dedupe_first(df, "k", "o").collect()] == [("a", 1, "y")]


def test_runner_goes_on_after_a_failure_and_skips_dependants(spark, sf_dir, tmp_path):
    def broken(_):
        raise RuntimeError("no")

    stages = (
        Stage("bad", broken), Stage("child", lambda w: w["bad"], ("bad",)), Stage("fine", lambda w: spark.range(4)),
        Stage("needs_absent", lambda w: w["absent"], ("absent_table",)),
    )
    metrics, status = run(warehouse(Inputs(spark, sf_dir), str(tmp_path)), stages)
    got = {r.stage: (r.status, r.rows) for r in metrics.collect()}
    assert status == 1
    assert got == {"bad": ("failed", 0), "child": ("skipped", 0), "fine": ("ok", 4), "needs_absent": ("skipped", 0)}


def test_a_failed_run_resumes(spark, sf_dir, tmp_path):
    import pytest

    built, fails = [], [True]

    def stage(name, *needs):
        def build(w):
            built.append(name)
            if name == "b" and fails[0]:
                raise RuntimeError("no")
            return spark.range(len(name) + len(needs))

        return Stage(name, build, needs)

    stages = (stage("late", "b", "a"), stage("a"), stage("b", "a"), stage("other"))  # in any order
    assert [sorted(s.name for s in wave) for wave in ordered(stages)] == [["a", "other"], ["b"], ["late"]]
    with pytest.raises(ValueError):
        ordered([stage("x", "y"), stage("y", "x")])
    statuses = lambda found: {r.stage: r.status for r in found.collect()}
    metrics, status = run(warehouse(Inputs(spark, sf_dir), str(tmp_path)), stages, together=4)
    assert status == 1 and statuses(metrics) == {"a": "ok", "b": "failed", "late": "skipped", "other": "ok"}
    fails[0], built[:] = False, []
    metrics, status = run(warehouse(Inputs(spark, sf_dir), str(tmp_path)), stages, resume=True)
    assert status == 0 and built == ["b", "late"] and statuses(metrics) == {"a": "kept", "b": "ok", "late": "ok", "other": "kept"}
    built.clear()
    metrics, _ = run(warehouse(Inputs(spark, sf_dir), str(tmp_path)), stages, resume=True)
    assert built == [] and {r.stage: r.rows for r in metrics.collect()} == {"a": 1, "b": 2, "late": 6, "other": 5}
    run(warehouse(Inputs(spark, sf_dir), str(tmp_path)), stages)
    assert sorted(built) == ["a", "b", "late", "other"]


def test_staging_stages_come_after_their_owners():
    waves = [{s.name for s in wave} for wave in ordered(STAGING_STAGES)]
    assert {"staging_persons", "staging_social_persons", "staging_glossary"} <= waves[0] and {"staging_posts", "staging_experiences"} <= waves[1]


def test_whole_refresh(spark, sf_dir, tmp_path):
    metrics, status = run(warehouse(Inputs(spark, sf_dir), str(tmp_path)))
    got = {r.stage: r for r in metrics.collect()}
    assert status == 0, [(r.stage, r.error) for r in got.values() if r.error]
    assert set(got) == {s.name for s in STAGES}
    read = lambda name: sinks.read_full(spark, str(tmp_path / name))
    daily, monthly, people = read("daily_metrics"), read("monthly_metrics"), read("unified_users")
    assert daily.agg(F.sum("posts_created")).first() == monthly.agg(F.sum("total_posts")).first()
    assert people.groupBy("user_lifecycle_stage").count().agg(F.sum("count")).first()[0] == people.count()
    steps = daily.orderBy("metric_date").select("total_users_cumulative").collect()
    assert all(a[0] <= b[0] for a, b in zip(steps, steps[1:]))
    retention = read("cohort_retention")
    assert retention.where("retained_users > total_users OR retention_rate NOT BETWEEN 0 AND 100").count() == 0
    assert read("connection_recommendations").where("user_id >= recommended_user_id").count() == 0


def test_streaming_upsert_over_several_batches(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "id long, v long"
    for batch, rows in enumerate([[(1, 1), (2, 1)], [(2, 2), (3, 2)], [(1, 3)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{source}/b={batch}")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).select("id", "v")
    got = streams.run_to_table(rows, str(tmp_path / "out"), ["id"], checkpoint=str(tmp_path / "state"), order="v")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 3), (2, 2), (3, 2)]


def _events(spark, folder, *files):
    """Event files in the order given, whatever their times."""
    import os

    for k, rows in enumerate(files):
        out = f"{folder}/in-{k}"
        spark.createDataFrame(rows, "user_id bigint, event_id bigint, ts string").selectExpr(
            "event_id", "user_id", "'view' AS event_type", "CAST(ts AS timestamp) AS ts", "CAST(event_id AS double) AS value",
        ).coalesce(1).write.parquet(out)
        (part,) = [f for f in os.listdir(out) if f.startswith("part-")]
        os.makedirs(f"{folder}/events", exist_ok=True)
        os.replace(f"{out}/{part}", f"{folder}/events/events-{k}.parquet")
        os.utime(f"{folder}/events/events-{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema("event_id bigint, user_id bigint, event_type string, ts timestamp, value double").option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")


OUT_OF_ORDER = (
    [(1, 5, "2024-01-20 10:00:00"), (2, 1, "2024-01-20 11:00:00")], [(1, 3, "2024-01-01 10:00:00"), (None, 9, "2024-01-01 10:00:00")],
    [(1, 4, "2024-01-20 12:00:00"), (2, 7, "2024-01-01 09:00:00"), (1, 3, "2024-01-01 10:00:00")],
)


def test_streams_do_not_depend_on_the_order_of_files(spark, tmp_path):
    stream = _events(spark, str(tmp_path), *OUT_OF_ORDER)
    for _ in range(2):  # the second run has no new input
        users = streams.stream_daily_users(stream, str(tmp_path / "users"), checkpoint=str(tmp_path / "users-state"))
        assert {(str(r.metric_date), r.dau) for r in users.collect()} == {("2024-01-20", 2), ("2024-01-01", 2)}
        last = streams.run_to_table(
            stream.select("user_id", "event_id"), str(tmp_path / "last"), ["user_id"], checkpoint=str(tmp_path / "last-state"), order="event_id")
        assert {tuple(r) for r in last.collect()} == {(1, 5), (2, 7), (None, 9)}
        days = streams.run_to_table(
            streams.stream_daily_activity(stream), str(tmp_path / "days"), ["metric_date", "event_type"], checkpoint=str(tmp_path / "days-state"), mode="update")
        assert {(str(r.metric_date), r.events) for r in days.collect()} == {("2024-01-20", 3), ("2024-01-01", 4)}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    schema = "id int, v int"
    table = published.KeyedTable(str(tmp_path / "t"), ["id"], spark.createDataFrame([], schema).schema, "v")
    first, second = spark.createDataFrame([(1, 5)], schema), spark.createDataFrame([(1, 3), (2, 2)], schema)
    assert table.read(spark).count() == 0
    for batch, batch_id in ((first, 0), (second, 1), (second, 1)):
        table.merge(batch, batch_id)
    assert {tuple(r) for r in table.read(spark).collect()} == {(1, 5), (2, 2)}


def test_a_failed_full_refresh_keeps_the_old_table(spark, tmp_path):
    import pytest

    path = str(tmp_path / "full")
    assert sinks.write_full(spark.range(3), path) == 3
    with pytest.raises(Exception):
        sinks.write_full(spark.range(3).selectExpr("CAST(assert_true(id < 2) IS NULL AS bigint) AS id"), path)
    assert sinks.read_full(spark, path).count() == 3
    assert sinks.write_full(spark.range(0), path) == 0 and sinks.read_full(spark, path).count() == 3
    assert sinks.write_full(spark.range(0), path, keep_old_if_empty=False) == 0 and sinks.read_full(spark, path).count() == 0


def test_a_writer_that_dies_between_steps_leaves_a_whole_table(spark, tmp_path, monkeypatch):
    import pytest

    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read_full(spark, path)
    for n in (3, 4, 5):
        assert sinks.write_full(spark.range(n), path) == n
    reader = sinks.read_full(spark, path)
    names = lambda: sorted(p.name for p in (tmp_path / "t" / "versions").iterdir())
    assert len(names()) == published.KEPT
    real = published.Pointers.set

    def dies(self, number, said):
        raise RuntimeError("killed")

    monkeypatch.setattr(published.Pointers, "set", dies)  # after the data, before the pointer
    with pytest.raises(RuntimeError):
        sinks.write_full(spark.range(6), path)
    assert sinks.read_full(spark, path).count() == reader.count() == 5

    def dies_within(self, number, said):
        at = self._path(f"{self.folder}/{number:012d}.json")
        out = self.files.create(at, False)
        out.write(bytearray(b'{"versi'))
        out.close()
        raise RuntimeError("killed")

    monkeypatch.setattr(published.Pointers, "set", dies_within)  # within the pointer
    with pytest.raises(RuntimeError):
        sinks.write_full(spark.range(7), path)
    assert sinks.read_full(spark, path).count() == 5
    monkeypatch.setattr(published.Pointers, "set", real)
    assert sinks.write_full(spark.range(8), path) == 8 and sinks.read_full(spark, path).count() == 8


def test_one_key_changes_one_bucket(spark, tmp_path):
    schema = "id long, v long"
    table = published.KeyedTable(str(tmp_path / "t"), ["id"], spark.createDataFrame([], schema).schema, "v", buckets=8)
    files = lambda: {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "t" / "versions").rglob("*.parquet")}
    assert len(table.merge(spark.range(1000).selectExpr("id", "0L AS v"), 0)) == 8
    before = files()
    (bucket,) = table.merge(spark.createDataFrame([(17, 5)], schema), 1)
    added = {f: t for f, t in files().items() if f not in before}
    assert added and all(f"batch=1/_bucket={bucket}/" in f for f in added) and before.items() <= files().items()
    want = [(i, 5 if i == 17 else 0) for i in range(1000)]
    for _ in range(2):  # a replay changes nothing
        assert table.merge(spark.createDataFrame([(17, 9)], schema), 1) == []
        assert sorted(tuple(r) for r in table.read(spark).collect()) == want
    for k in range(2, 6):
        table.merge(spark.createDataFrame([(17, k + 10), (None, k)], schema), k)
    assert sorted((tuple(r) for r in table.read(spark).collect()), key=str) == sorted([(i, 15 if i == 17 else 0) for i in range(1000)] + [(None, 5)], key=str)
    assert sum(f"_bucket={bucket}/" in f for f in files()) <= published.KEPT * 8  # what no pointer names is gone


def test_a_batch_that_died_before_its_pointer_runs_again(spark, tmp_path, monkeypatch):
    import pytest

    schema = "id long, v long"
    table = published.KeyedTable(str(tmp_path / "t"), ["id"], spark.createDataFrame([], schema).schema, "v", buckets=4)
    table.merge(spark.createDataFrame([(1, 1), (2, 1)], schema), 0)
    real = published.Pointers.set
    monkeypatch.setattr(published.Pointers, "set", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        table.merge(spark.createDataFrame([(1, 2), (3, 2)], schema), 1)
    assert sorted(tuple(r) for r in table.read(spark).collect()) == [(1, 1), (2, 1)]
    monkeypatch.setattr(published.Pointers, "set", real)
    table.merge(spark.createDataFrame([(1, 2), (3, 2)], schema), 1)
    assert sorted(tuple(r) for r in table.read(spark).collect()) == [(1, 2), (2, 1), (3, 2)]


def test_a_batch_reads_its_own_days_only(spark, tmp_path):
    schema = spark.createDataFrame([], "user_id long, day date").schema
    log = published.DayLog(str(tmp_path / "log"), schema, "day", most=3)
    rows = lambda *found: spark.createDataFrame(found, "user_id long, day string").selectExpr("user_id", "CAST(day AS date) AS day")
    assert log.merge(rows((1, "2024-01-01"), (2, "2024-01-02"), (2, "2024-01-02")), 0) == []
    assert log.merge(rows((9, "2024-01-03"), (None, "2024-01-03"), (5, None)), 1) == []
    assert log.merge(rows((2, "2024-01-02"), (3, "2024-01-02")), 2) == ["batch=0/_part=2024-01-02"]  # late rows
    assert log.merge(rows((3, "2024-01-02"), (4, "2024-01-02"), (None, "2024-01-03"), (5, None)), 3) and log.merge(rows((7, "2024-01-02")), 3) == []
    want = [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02"), (4, "2024-01-02"), (5, None), (9, "2024-01-03"), (None, "2024-01-03")]
    found = lambda: sorted(((r.user_id, r.day and str(r.day)) for r in log.read(spark).collect()), key=str)
    assert found() == sorted(want, key=str)
    assert len(log.merge(rows((8, "2024-01-02")), 4)) == 3  # three parts: written anew
    said = published.Pointers(spark, str(tmp_path / "log")).current()[1]["days"]
    assert said["2024-01-02"] == {"batches": [4], "rows": 4} and said["2024-01-03"] == {"batches": [1], "rows": 2}
    assert found() == sorted([*want, (8, "2024-01-02")], key=str)


def test_a_cluster_must_name_a_shared_folder():
    import pytest

    from agorakit import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError):
        session.scratch_root(Session)


def test_no_dates_before_the_first_signup(spark):
    from agorakit.operators import kpis

    users = spark.sql("SELECT TIMESTAMP '2024-01-05 10:00:00' AS signup_date")
    assert kpis.date_series(users, "2024-01-03 12:00:00").count() == 0
    assert [str(r.metric_date) for r in kpis.date_series(users, "2024-01-06 12:00:00").orderBy("metric_date").collect()] == ["2024-01-05", "2024-01-06"]
