"""Hand-made rows for the rules that are easy to get wrong."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from agorakit.functions import exprs
from agorakit.operators import cohorts, events, kpis, lists, messaging, networks, segments, users

NOW = "2024-03-31 12:00:00"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def ts(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    "later,earlier,days",
    [
        ("2024-03-01 11:00:00", "2024-01-01 12:00:00", 59),
        ("2024-01-01 00:00:00", "2024-01-01 23:00:00", 0),
        ("2024-01-01 00:00:00", "2024-01-03 01:00:00", -2),
    ],
)
def test_days_are_whole_24_hour_periods(spark, later, earlier, days):
    assert one(spark, exprs.whole_days(ts(later), ts(earlier))) == days


@pytest.mark.parametrize(
    "text,expected",
    [("2011-04-30", "2011-04-30"), ("4-2011", "2011-04-01"), ("12-2019", "2019-12-01"), ("13-2019", None), ("n/a", None), (None, None)],
)
def test_loose_dates(spark, text, expected):
    value = one(spark, exprs.loose_timestamp(F.lit(text).cast("string")))
    assert (str(value.date()) if value else None) == expected


def test_hex_key_and_blank_and_json(spark):
    assert one(spark, exprs.hex_key(F.lit("00000000-0000-0ff0-0000-000000000000"))) == 0xFF
    assert one(spark, exprs.blank_to_null(F.lit("  "))) is None
    assert one(spark, exprs.json_text(F.struct(F.lit(None).cast("string").alias("a")))) == '{"a":null}'


def test_rates_are_null_on_zero_and_round_half_up(spark):
    assert one(spark, exprs.pct(F.lit(1), F.lit(0))) is None
    assert one(spark, exprs.ratio(F.lit(97), F.lit(40))) == 2.43


PERSON = (
    "id long, created_at timestamp, updated_at timestamp, deleted_at timestamp, email string, first_name string, last_name string, "
    "headline_description string, linked_in_url string, location_id long, has_finder boolean"
)


def _unify(spark, persons, social=(), posts=(), comments=(), votes=(), collections=(), test_emails=()):
    now = datetime.fromisoformat(NOW)
    at = lambda days: now - timedelta(days=days)
    rows = [(i, at(signup), at(updated), None, f"u{i}@x", "F", "", None, None, None, None) for i, signup, updated in persons]
    act = lambda rows, key: spark.createDataFrame(
        [(k, at(d), at(0) if gone else None) for k, d, gone in rows], f"{key}, created_at timestamp, deleted_at timestamp"
    )
    none = "person_id long, created_at timestamp, deleted_at timestamp"
    return users.unified_users(
        spark.createDataFrame(rows, PERSON),
        spark.createDataFrame(list(social), "id string, external_id string, email string"),
        spark.createDataFrame([], none), spark.createDataFrame([], none),
        act(posts, "person_id string"), act(comments, "person_id string"), act(votes, "voter_id long"),
        act(collections, "person_id long"),
        spark.createDataFrame([], "mentioned_person_id string, created_at timestamp, deleted_at timestamp"),
        spark.createDataFrame([], "person_id string, deleted_at timestamp"), spark.createDataFrame([], none),
        as_of=NOW, test_emails=list(test_emails),
    )


def test_lifecycle_order_and_recency(spark):
    people = [(1, 200, 91), (2, 200, 90), (3, 200, 31), (4, 200, 30), (5, 3, 3), (6, 20, 20), (7, 200, 100)]
    social = [("e7", "7", "s7@x"), ("e6", "6", "s6@x")]
    found = _unify(spark, people, social, comments=[("e7", 1, False)], collections=[(4, 150, False)])
    stages = {r.user_id: r.user_lifecycle_stage for r in found.collect()}
    # A comment keeps user 7 recent for last activity, but not for the lifecycle.
    assert stages == {1: "CHURNED", 2: "DORMANT", 3: "DORMANT", 4: "ENGAGED", 5: "NEW", 6: "ACTIVATED", 7: "CHURNED"}


def test_comments_do_not_activate_but_date_activation(spark):
    found = _unify(spark, [(1, 50, 50)], [("e1", "1", "s1@x")], comments=[("e1", 40, False)]).first()
    assert found.activation_status is False and found.activated_at is not None and found.days_to_first_activity == 10


def test_deleted_rows_count_for_dates_only(spark):
    found = _unify(spark, [(1, 50, 50)], [("e1", "1", None)], posts=[("e1", 5, True)]).first()
    assert found.posts_created == 0 and found.first_post_date is not None and found.activation_status
    assert found.days_to_first_activity == 45


def test_no_activity_is_null_and_types_default(spark):
    found = _unify(spark, [(1, 50, 50)], test_emails=["u1@x"]).first()
    assert found.activated_at is None and found.days_to_first_activity is None
    assert found.has_finder is False and found.user_type == "STANDARD" and found.is_test_account
    assert found.profile_completion_score == 20


def test_duplicate_social_persons_do_not_multiply_users(spark):
    assert _unify(spark, [(1, 50, 50)], [("e1", "1", None), ("e0", "1", None)]).count() == 1


def test_first_flag_sees_deleted_rows_and_keeps_ties(spark):
    rows = [(1, "2024-01-02", False), (1, "2024-01-01", True), (2, "2024-01-01", False), (2, "2024-01-01", False)]
    df = spark.createDataFrame(rows, "owner long, at string, gone boolean")
    flags = [(r.owner, r.gone, r.is_first_activity_of_type) for r in events.flag_first(df, "owner", "at").collect()]
    assert sorted(flags) == [(1, False, False), (1, True, True), (2, False, True), (2, False, True)]


def test_week_bucket_ignores_hours_before_signup(spark):
    signup = ts("2024-01-08 12:00:00")
    weeks = [one(spark, cohorts.week_bucket(ts(t), signup)) for t in ("2024-01-08 06:00:00", "2024-01-08 12:00:00", "2024-01-15 11:59:59", "2024-01-15 12:00:00", "2025-02-01 12:00:00")]
    assert weeks == [None, 0, 0, 1, None]


def test_post_with_link_and_media_counts_twice_and_zero_posts_give_null(spark):
    rows = [(1, "post", "2024-01-01", True, True), (1, "comment", "2024-01-02", None, None)]
    df = spark.createDataFrame(rows, "user_id long, activity_type string, activity_date string, l boolean, m boolean")
    df = df.withColumn("metadata", F.struct(F.col("l").alias("has_link"), F.col("m").alias("has_media")))
    got = {str(r.metric_date): r for r in kpis.post_metrics(df).collect()}
    assert (got["2024-01-01"].link_posts, got["2024-01-01"].media_posts, got["2024-01-01"].text_posts) == (1, 1, 0)
    assert got["2024-01-02"].avg_comments_per_post is None


def test_groups_of_any_size_have_the_same_shape(spark):
    df = spark.range(12_000).select(F.when(F.col("id") < 11_000, "hot").alias("g"), F.col("id").alias("v"))
    rows = lists.listed(df.unionByName(df), ["g"], "v", "n").collect()
    assert len(rows) == 12_000 and {(r.g, r.n) for r in rows} == {("hot", 11_000), (None, 1_000)}


def test_reaction_counts_of_any_size(spark):
    message = spark.sql("SELECT 1L AS id, 1L AS conversation_id, 'a' AS sender_id, 'x' AS body, 'TEXT' AS message_type, 'SENT' AS status, current_timestamp() AS created_at, NULL AS updated_at")
    persons = spark.sql("SELECT 'a' AS id, 'A' AS first_name, 'B' AS last_name")
    reacted = spark.range(10_500).selectExpr("1L AS message_id", "CAST(id AS string) AS person_id", "if(id < 10, 'laugh', 'like') AS reaction_type")
    none = spark.createDataFrame([], "message_id bigint, person_id string, id bigint, storage_key string, mime_type string, file_size_bytes bigint, metadata string")
    (row,) = messaging.thread(message, persons, none, reacted, none, "a").collect()
    assert [tuple(x) for x in row.reactions] == [("laugh", 10), ("like", 10_490)] and row.reaction_count == 10_500


def test_paths_of_any_length(spark):
    from agorakit.operators import graphprofile

    edges = spark.range(24).selectExpr("CAST(id AS string) AS source_node_id", "CAST(id + 1 AS string) AS target_node_id")
    more = spark.createDataFrame([("5", "9"), ("x", "y")], "source_node_id string, target_node_id string")
    edges = edges.unionByName(more)
    for ends, length in ((("24", "0"), 21), (("3", "3"), 0), (("0", "y"), None), (("none", "0"), None), (("5", "9"), 1)):
        assert graphprofile.shortest_path_length(edges, *ends).first().path_length == length


def test_location_names_rule_and_true_top(spark):
    companies = [(f"c{n:02d}", f"Co {n:02d}", None, None, u) for n in range(12) for u in range(n + 1)]
    members = spark.createDataFrame(companies, "company_id string, company_name string, role_id string, role_title string, user_id long")
    where = spark.createDataFrame([("L1", "X", u) for u in range(12)], "location_id string, country string, user_id long")
    rule = networks.location_based_networks(where, members).first()
    top = networks.location_based_networks(where, members, by_count=True).first()
    assert rule.top_companies == [f"Co {n:02d}" for n in range(9, -1, -1)]
    assert top.top_companies == [f"Co {n:02d}" for n in range(11, 1, -1)]
    assert rule.company_diversity_score == 12.0 and rule.role_diversity_score == 0.0 and rule.top_roles is None


def test_company_map_with_wide_companies_and_long_lists(spark, monkeypatch):
    monkeypatch.setattr(networks, "SHORT_LIST", 2)
    rows = [(f"c{c}", f"Co {c}", None, None, u) for u, cs in {1: range(6), 2: (0, 1), 3: (0, 1), 4: (4,)}.items() for c in cs]
    members = spark.createDataFrame(rows, "company_id string, company_name string, role_id string, role_title string, user_id long")
    got = networks.company_network_map(members, k=3, degree=2).orderBy(F.desc("shared_employee_count"), "company_id_1", "company_id_2").collect()
    assert {(r.company_id_1, r.company_id_2, r.employee_id) for r in got} == {("c0", "c1", u) for u in (1, 2, 3)} | {("c0", "c2", 1), ("c0", "c3", 1)}


def test_recommendation_reason_prefers_work(spark):
    rows = [(f"s{n}", m, "STUDIED_TOGETHER") for n in range(3) for m in (1, 2)] + [("w", 2, "WORKED_TOGETHER"), ("w", 1, "WORKED_TOGETHER")]
    rows += [("s9", m, "STUDIED_TOGETHER") for m in (5, 4)]
    df = spark.createDataFrame(rows, "grp string, member long, kind string")
    got = [tuple(r) for r in networks.connection_recommendations(df).collect()]
    assert got == [(1, 2, 30.0, networks.REASON_WORKED), (4, 5, 10.0, networks.REASON_STUDIED)]


MESSAGES = "id long, conversation_id long, sender_id string, body string, created_at timestamp, message_type string"


def test_sample_conversation_has_one_unread_message(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, 1, "ana" if i % 2 else "bo", f"m{i}", start + timedelta(minutes=i), "TEXT") for i in range(1, 14)]
    messages = spark.createDataFrame(rows, MESSAGES)
    reads = [(i, "ana") for i in range(1, 14)] + [(i, "bo") for i in range(1, 13)]
    reads = spark.createDataFrame(reads, "message_id long, person_id string")
    members = spark.createDataFrame(
        [(1, "ana", "MAIN", None, None, "ALL"), (1, "bo", "REQUEST", None, None, "ALL")],
        "conversation_id long, person_id string, folder string, left_at timestamp, last_read_at timestamp, notification_level string",
    )
    talks = spark.createDataFrame([(1, "DIRECT", start)], "id long, conversation_type string, updated_at timestamp")
    people = spark.createDataFrame(
        [("ana", "Ana", "A", "ana@x"), ("bo", "Bo", "B", "bo@x")], "id string, first_name string, last_name string, email string"
    )
    box = {r.person_id: r for r in messaging.inbox(talks, members, messages, reads, people).collect()}
    assert (box["ana"].unread_count, box["bo"].unread_count) == (0, 1)
    assert box["bo"].other_name == "Ana A" and box["bo"].last_message_id == 13
    reactions = spark.createDataFrame([(13, "bo", "like")], "message_id long, person_id string, reaction_type string")
    found = [(1, 2, "k", "a/b", 10, '{"file_name": "one.png", "size": [1, {"x": 2}]}'), (0, 2, "k0", "a/b", 11, '{"file_name": "first.png"}'),
             (2, 3, "k", "a/b", 12, "no json"), (3, 4, "k", "a/b", 13, None), (4, 5, "k", "a/b", None, '{"file_name": null}')]
    files = spark.createDataFrame(found, "id long, message_id long, storage_key string, mime_type string, file_size_bytes long, metadata string")
    sent = messages.withColumns({"status": F.lit("SENT"), "updated_at": F.lit(None).cast("timestamp")})
    lines = {r.id: r for r in messaging.thread(sent, people, reads, reactions, files, "bo").collect()}
    assert not lines[13].is_read and lines[13].reaction_count == 1 and lines[1].reactions == [] and lines[1].status == "SENT"
    assert {i: (lines[i].file_name, lines[i].file_size_bytes) for i in (1, 2, 3, 4, 5)} == {
        1: (None, None), 2: ("first.png", 11), 3: (None, 12), 4: (None, 13), 5: (None, None)}


def test_folder_log_request_keeps_the_level(spark):
    rows = [(1, "a", "START", "STARTER", 0), (1, "a", "MOVE", "RESTRICTED", 1), (1, "a", "MOVE", "REQUEST", 2), (1, "b", "START", "RECIPIENT", 0)]
    log = spark.createDataFrame(rows, "conversation_id long, person_id string, action string, detail string, seq long")
    got = {r.person_id: (r.folder, r.notification_level) for r in messaging.folder_state(log).collect()}
    assert got == {"a": ("REQUEST", "MUTED"), "b": ("REQUEST", "ALL")}


def test_search_escapes_wildcards_and_bounds_queries(spark):
    people = spark.createDataFrame([(1, "A_b", "C", "x@y"), (2, "Axb", "C", "z@y")], "id long, first_name string, last_name string, email string")
    assert [r.id for r in messaging.search_users(people, [("a_B", "9")]).collect()] == [1]
    assert messaging.search_users(people, [("a", "9")]).count() == 0
    with pytest.raises(ValueError):
        messaging.search_users(people, [("ab", "9")] * 1001)


@pytest.mark.parametrize("mime,kind", [("image/png", "IMAGE"), ("audio/ogg", "AUDIO"), ("application/pdf", "FILE"), (None, "TEXT")])
def test_message_types(spark, mime, kind):
    assert one(spark, messaging.message_type(F.lit(mime).cast("string"))) == kind


def test_export_columns_are_complete(spark):
    assert len(segments.ACTIVATION_EXPORT) == 14 and len(segments.ENGAGEMENT_EXPORT) == 16


def test_many_searches_at_once(spark):
    people = spark.range(6_000).selectExpr("id", "'Ann' AS first_name", "concat('Lee', id) AS last_name", "if(id = 7, NULL, concat('Mail', id, '@x.org')) AS email")
    searches = spark.range(5_000).selectExpr("concat(' LEE', id, ' ') AS query", "CAST(id AS string) AS searcher_id").unionByName(
        spark.createDataFrame([("l", "1"), ("zz", "1"), ("nn", "3"), (None, "3"), ("il5", "5")], "query string, searcher_id string"))
    found = {}
    for r in messaging.search_user_table(people, searches).collect():
        found.setdefault((r.query, r.searcher_id), []).append(r.id)
    for i in (0, 7, 45, 599, 4_999):
        want = [k for k in range(6_000) if str(k).startswith(str(i)) and k != i][:20]
        assert sorted(found.get((f"LEE{i}", str(i)), [])) == want
    assert sorted(found["nn", "3"]) == [k for k in range(22) if k != 3][:20] and sorted(found["il5", "5"]) == [k for k in range(6_000) if str(k).startswith("5") and k != 5][:20]
    assert {q for q, _ in found} & {"l", "zz"} == set()


def test_hot_parts_of_names(spark):
    people = [(i, ["Ann", "", None][i % 3], f"Lee{i % 40}", None if i % 5 else f"İ{i}@X.org") for i in range(400)]
    texts = ["el", "lee", "lee1", "ann lee3", "n ", "x.org", "İ1", "5@x", "25@x", "q", "leeq", "ann"]
    asked = [(q, str(k)) for q in texts for k in (0, 3, 399)] + [("lee", "3")]
    people_df = spark.createDataFrame(people, "id bigint, first_name string, last_name string, email string")
    found = messaging.search_user_table(people_df, spark.createDataFrame(asked, "query string, searcher_id string"), n=7, block=16)
    plain = messaging.search_users(people_df, sorted(set(asked)), n=7)
    rows = [sorted((r.query, r.searcher_id, r.id, r.full_name, r.email or "") for r in f.collect()) for f in (found, plain)]
    assert rows[0] == rows[1] and {r[0] for r in rows[0]} == {q.strip() for q in texts} - {"q", "el", "leeq", "n"}
    assert "WindowGroupLimit" in found._jdf.queryExecution().toString()


def test_persons_are_dealt_out_before_their_parts(spark):
    """A small file of persons is one task; the parts of their names are not made there, and lists with texts are not shuffled by part."""
    people = spark.range(400).selectExpr("id", "concat('F', id) AS first_name", "concat('𝒳\n', id) AS last_name", "concat('c', id, '@x.org') AS email").coalesce(1)
    searches = spark.createDataFrame([("𝒳\n39", "1"), ("𝒳\n7", "7"), ("c12", "12"), ("c123@", "5"), ("@x.org", "2")], "query string, searcher_id string")
    found = messaging.search_user_table(people, searches, n=7, block=16)
    plain = messaging.search_users(people, [tuple(r) for r in searches.collect()], n=7)
    rows = [sorted((r.query, r.searcher_id, r.id) for r in f.collect()) for f in (found, plain)]
    assert rows[0] == rows[1] and ("𝒳\n39", "1", 39) in rows[0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert "REPARTITION_BY_COL" in initial and "hashpartitioning(_part" not in "".join(x for x in initial.splitlines() if "_email" in x)
