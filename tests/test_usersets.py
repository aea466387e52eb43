"""Stored user sets against plain distinct counts."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from agorakit.operators import usersets
from agorakit.operators.usersets import UserSets

SCHEMA = "user_id string, activity_date timestamp"


def event(user, month, day):
    return user, dt.datetime(2024, month, day, 13)


def counts(store, spark):
    return {r.metric_month: r.n for r in usersets.sizes(usersets.by_month(store.read(spark)), "metric_month", "n").collect()}


def test_sets_equal_distinct_counts(spark, tmp_path):
    draw = random.Random(5)
    rows = [event(f"u{draw.randint(1, 60)}", draw.choice([1, 2, 4]), draw.randint(1, 6)) for _ in range(400)]
    store = UserSets(str(tmp_path / "s"), most=2)
    for load, at in enumerate(range(0, 400, 80)):  # days come in parts, and in more than the most parts
        store.load(spark.createDataFrame(rows[at : at + 80] + rows[:10], SCHEMA), load)
    months, days = defaultdict(set), defaultdict(set)
    for user, at in rows:
        months[at.date().replace(day=1)].add(user)
        days[at.date()].add(user)
    assert counts(store, spark) == {m: len(x) for m, x in months.items()}
    assert {r.day: r.n for r in usersets.sizes(store.read(spark), "day", "n").collect()} == {d: len(x) for d, x in days.items()}
    numbers = [r.number for r in store.numbers(spark).collect()]
    assert sorted(numbers) == list(range(1, len({u for u, _ in rows}) + 1))

    some = {f"u{n}" for n in range(1, 30)} | {"never seen"}
    population = store.population(spark.createDataFrame([(u,) for u in sorted(some)] * 2, "user_id string"))
    inside = usersets.within(usersets.by_month(store.read(spark)), population)
    assert {r.metric_month: r.n for r in usersets.sizes(inside, "metric_month", "n").collect()} == {m: len(x & some) for m, x in months.items()}
    jan, feb, apr = (dt.date(2024, m, 1) for m in (1, 2, 4))
    kept = {r.metric_month: r.retained_from_prev for r in usersets.retained_by_month(usersets.by_month(store.read(spark))).collect()}
    assert kept == {jan: 0, feb: len(months[jan] & months[feb]), apr: 0}
    assert {r.day.month for r in store.read(spark, "2024-02-01", "2024-03-31").collect()} == {2}


def test_a_new_day_reads_that_day_only(spark, tmp_path, monkeypatch):
    store = UserSets(str(tmp_path / "s"))
    assert store.load(spark.createDataFrame([event("a", 1, 1), event("b", 1, 1), event("a", 1, 2)], SCHEMA), 0) == ["2024-01-01", "2024-01-02"]

    def unread(*_):
        raise AssertionError("a load reads no stored set")

    with monkeypatch.context() as m:
        m.setattr(UserSets, "_sets", unread)
        assert store.load(spark.createDataFrame([event("a", 1, 3), event("c", 1, 3)], SCHEMA), 1) == ["2024-01-03"]
    assert counts(store, spark) == {dt.date(2024, 1, 1): 3}
    store.load(spark.createDataFrame([event("a", 2, 1)], SCHEMA), 2)
    assert [r.day for r in store.read(spark, "2024-01-03", "2024-01-31").collect()] == [dt.date(2024, 1, 3)]
    read = store.read(spark, "2024-02-01").inputFiles()
    assert read and all("/_month=2024-02/" in x for x in read)


def test_loads_again_dead_writers_and_nulls(spark, tmp_path, monkeypatch):
    store = UserSets(str(tmp_path / "s"))
    first = spark.createDataFrame([event("a", 1, 1), event(None, 1, 1), ("z", None)], SCHEMA)
    store.load(first, 0)
    assert store.load(first, 0) == [] and counts(store, spark) == {dt.date(2024, 1, 1): 1}
    second = spark.createDataFrame([event("b", 1, 1), event("c", 2, 1)], SCHEMA)

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(usersets.Pointers, "set", die)
        with pytest.raises(OSError):
            store.load(second, 1)
    assert counts(store, spark) == {dt.date(2024, 1, 1): 1}
    store.load(second, 1)
    assert counts(store, spark) == {dt.date(2024, 1, 1): 2, dt.date(2024, 2, 1): 1}
    assert sorted(r.number for r in store.numbers(spark).collect()) == [1, 2, 3]
    store.load(first.where("false"), 2)
    assert counts(store, spark) == {dt.date(2024, 1, 1): 2, dt.date(2024, 2, 1): 1}


def test_users_beyond_one_stretch(spark, tmp_path):
    store = UserSets(str(tmp_path / "s"))
    users = spark.range(40_000).select(F.concat(F.lit("u"), "id").alias("user_id"), F.lit(dt.datetime(2024, 1, 1)).alias("activity_date"))
    store.load(users, 0)
    assert counts(store, spark) == {dt.date(2024, 1, 1): 40_000}
    assert {r.stretch for r in store.read(spark).collect()} == {1, 2}
