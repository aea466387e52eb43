"""DuckDB SQL for every query, written from the stated semantics and independent of the Spark plans.

The SQL joins per-table summaries, correlated tests, range conditions and plain self joins; the Spark operators use
none of these shapes, so agreement means something.
"""

from __future__ import annotations

from agorakit.plans.catalog import PATH_ENDS, READERS, SEARCHES
from agorakit.sources.bindings import VIEWS, with_clause

NOW = "TIMESTAMP '2001-08-02 12:00:00'"
TODAY = "DATE '2001-08-02'"
SNAP_DAY = "DATE '2001-08-01'"


def _half_up(part: str, whole: str, factor: int) -> str:
    """factor * part / whole to two places, halves away from zero, in whole numbers; NULL for whole 0."""
    p, w = f"({part})::HUGEINT", f"nullif(({whole})::HUGEINT, 0)"
    return f"(sign({p}) * ((200 * {factor} * abs({p}) + {w}) // (2 * {w})))::DOUBLE / 100"


def _pct(part: str, whole: str) -> str:
    return _half_up(part, whole, 100)


def _ratio(part: str, whole: str) -> str:
    return _half_up(part, whole, 1)


def _mean(value: str, where: str = "TRUE") -> str:
    return _half_up(f"sum({value}) FILTER (WHERE {where})", f"count({value}) FILTER (WHERE {where})", 1)


def _spell_date(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN strptime({text}, '%Y-%m-%d') "
        f"WHEN regexp_full_match({text}, '[0-9]{{1,2}}-[0-9]{{4}}') THEN strptime(lpad({text}, 7, '0'), '%m-%Y') END"
    )


def _summary(view: str, key: str) -> str:
    return (
        f"(SELECT {key} AS k, count(*) FILTER (WHERE deleted_at IS NULL) AS n, min(created_at) AS f, max(created_at) AS l "
        f"FROM {view} GROUP BY 1)"
    )


PARTS: dict[str, str] = {}

PARTS["o_people"] = f"""
SELECT p.id AS user_id, s.id AS engagement_person_id, p.person_id, coalesce(p.email, s.email) AS email, p.first_name, p.last_name,
  p.has_finder IS TRUE AS has_finder, CASE WHEN p.has_finder IS TRUE THEN 'FINDER' ELSE 'STANDARD' END AS user_type,
  coalesce(wk.n, 0) AS experience_count, coalesce(ed.n, 0) AS education_count, coalesce(po.n, 0) AS posts_created,
  coalesce(co.n, 0) AS comments_made, coalesce(vo.n, 0) AS votes_cast, coalesce(cl.n, 0) AS collections_created,
  coalesce(me.n, 0) AS mentions_received, coalesce(gm.n, 0) AS groups_joined, coalesce(vi.n, 0) AS views_given,
  po.f AS pf, co.f AS cf, vo.f AS vf, cl.f AS lf, po.l AS pl, co.l AS ccl, vo.l AS vl, cl.l AS ll,
  p.headline_description, p.linked_in_url, p.location_id, p.created_at, p.updated_at, p.deleted_at,
  p.email IN (SELECT email FROM fx_persons WHERE id % 50 = 0) AS is_test_account
FROM fx_persons p
LEFT JOIN fx_engagement_persons s ON s.external_id = CAST(p.id AS VARCHAR)
LEFT JOIN {_summary('fx_work', 'person_id')} wk ON wk.k = p.id
LEFT JOIN {_summary('fx_study', 'person_id')} ed ON ed.k = p.id
LEFT JOIN {_summary('fx_posts', 'person_id')} po ON po.k = s.id
LEFT JOIN {_summary('fx_comments', 'person_id')} co ON co.k = s.id
LEFT JOIN {_summary('fx_votes', 'voter_id')} vo ON vo.k = p.id
LEFT JOIN {_summary('fx_collections', 'person_id')} cl ON cl.k = p.id
LEFT JOIN {_summary('fx_views', 'person_id')} vi ON vi.k = p.id
LEFT JOIN {_summary('fx_mentions', 'mentioned_person_id')} me ON me.k = s.id
LEFT JOIN (SELECT person_id AS k, count(*) FILTER (WHERE deleted_at IS NULL) AS n FROM fx_group_members GROUP BY 1) gm ON gm.k = s.id
WHERE p.deleted_at IS NULL
"""

#: Points of a filled profile, by the test that fills it.
_POINTS = {
    "length(first_name) > 0": 10, "length(last_name) > 0": 10, "email IS NOT NULL": 10, "length(headline_description) > 10": 15,
    "linked_in_url IS NOT NULL": 10, "experience_count > 0": 20, "education_count > 0": 15, "location_id IS NOT NULL": 10,
}
#: Stages in the order in which they are tried, on the days without activity (w), the days since signup (age) and the first activities (seen).
_STAGES = (("CHURNED", "w > 90"), ("DORMANT", "w > 30"), ("ENGAGED", "len(seen) > 0"), ("NEW", "age <= 7"), ("ACTIVATED", "TRUE"))
PARTS["o_users"] = f"""
WITH timed AS (
  SELECT *, list_filter([pf, vf, lf], lambda x: x IS NOT NULL) AS seen, list_min(list_filter([pf, cf, vf, lf], lambda x: x IS NOT NULL)) AS opened,
    list_max(list_filter([updated_at, created_at, pl, vl], lambda x: x IS NOT NULL)) AS moved,
    list_max(list_filter([updated_at, created_at, pl, ccl, vl, ll], lambda x: x IS NOT NULL)) AS latest
  FROM o_people
), aged AS (SELECT *, datediff('hour', moved, {NOW}) // 24 AS w, extract(day FROM ({NOW} - created_at)) AS age FROM timed)
SELECT user_id, engagement_person_id, person_id, email, first_name, last_name, has_finder, user_type, experience_count, education_count,
  CAST(list_sum([{", ".join(f"CASE WHEN {test} THEN {n} ELSE 0 END" for test, n in _POINTS.items())}]) AS BIGINT) AS profile_completion_score,
  posts_created, comments_made, votes_cast, collections_created, mentions_received, groups_joined, views_given,
  created_at AS signup_date, latest AS last_activity_date, pf AS first_post_date, vf AS first_vote_date, age AS days_since_signup,
  extract(day FROM (opened - created_at)) AS days_to_first_activity,
  list_filter([{", ".join(f"{{'stage': '{stage}', 'holds': {test}}}" for stage, test in _STAGES)}], lambda x: x.holds)[1].stage AS user_lifecycle_stage,
  len(seen) > 0 AS activation_status, opened AS activated_at, is_test_account, created_at, updated_at, deleted_at
FROM aged
"""

PARTS["o_std"] = "SELECT * FROM o_users WHERE NOT is_test_account AND deleted_at IS NULL"


def _event(kind: str, view: str, owner: str, user_key: str, base: str, table: str, source_id: str, meta: str, extra: str) -> str:
    return f"""
SELECT u.user_id, '{kind}' AS activity_type, s.created_at AS activity_date, '{base}' AS source_database, '{table}' AS source_table,
  {source_id} AS source_id, CAST({meta} AS VARCHAR) AS metadata, extract(day FROM (s.created_at - u.signup_date)) AS days_since_signup,
  s.created_at = s.earliest AS is_first_activity_of_type, {extra}
FROM (SELECT *, min(created_at) OVER (PARTITION BY {owner}) AS earliest FROM {view}) s JOIN o_users u ON u.{user_key} = s.{owner}
WHERE s.deleted_at IS NULL
"""


_HEX = "CAST('0x' || substr(replace(s.id, '-', ''), 1, 15) AS BIGINT)"
_NONE = "CAST(NULL AS BOOLEAN) AS linked, CAST(NULL AS BOOLEAN) AS pictured, CAST(NULL AS VARCHAR) AS privacy"
PARTS["o_posts"] = _event(
    "post", "fx_posts", "person_id", "engagement_person_id", "social", "posts", _HEX,
    "json_object('type', s.type, 'status', s.status, 'has_link', s.link_url IS NOT NULL, 'has_media', s.media_keys IS NOT NULL)",
    "s.link_url IS NOT NULL AS linked, s.media_keys IS NOT NULL AS pictured, CAST(NULL AS VARCHAR) AS privacy",
)
PARTS["o_comments"] = _event(
    "comment", "fx_comments", "person_id", "engagement_person_id", "social", "comments", _HEX,
    "json_object('post_id', s.post_id, 'is_reply', s.parent_comment_id IS NOT NULL)", _NONE,
)
PARTS["o_votes"] = _event(
    "vote", "fx_votes", "voter_id", "user_id", "profile", "query_votes", "s.id",
    "json_object('type', s.type, 'score', s.score, 'profile_id', s.profile_id)", _NONE,
)
PARTS["o_collections"] = _event(
    "collection", "fx_collections", "person_id", "user_id", "profile", "collections", "s.id",
    "json_object('name', s.name, 'privacy', s.privacy)",
    "CAST(NULL AS BOOLEAN) AS linked, CAST(NULL AS BOOLEAN) AS pictured, s.privacy AS privacy",
)
PARTS["o_views"] = _event(
    "view", "fx_views", "person_id", "user_id", "profile", "view_access", "s.id",
    "json_object('type', s.type, 'expiry', strftime(s.expiry, '%Y-%m-%dT%H:%M:%S'))", _NONE,
)
PARTS["o_events"] = " UNION ALL ".join(f"SELECT * FROM o_{n}" for n in ("posts", "comments", "votes", "collections", "views"))

_EVENT_COLUMNS = (
    "user_id, activity_type, activity_date, source_database, source_table, source_id, metadata, days_since_signup, "
    "is_first_activity_of_type"
)

PARTS["o_dates"] = f"""
SELECT CAST(unnest(generate_series((SELECT min(CAST(signup_date AS DATE)) FROM o_users), {TODAY}, INTERVAL 1 DAY)) AS DATE) AS metric_date
"""
PARTS["o_signups"] = """
SELECT CAST(signup_date AS DATE) AS signup_date, count(*) AS new_users, count(*) FILTER (WHERE has_finder) AS new_finders,
  count(*) FILTER (WHERE NOT has_finder) AS new_standards FROM o_std GROUP BY 1
"""
#: Daily columns of each kind of activity: how many there were, and by how many users.
_KINDS = {
    "post": ("posts_created", "active_posters"), "comment": ("comments_created", "active_commenters"), "vote": ("votes_cast", "active_voters"),
    "collection": ("collections_created", "active_collectors"), "view": ("views_given", None),
}
PARTS["o_user_days"] = """
SELECT CAST(activity_date AS DATE) AS activity_date, user_id, activity_type, count(*) AS n FROM o_events GROUP BY ALL
"""
PARTS["o_activity"] = f"""
WITH kinds AS (SELECT activity_date, map_from_entries(list({{'k': activity_type, 'v': {{'n': n, 'users': users}}}})) AS m FROM (
    SELECT activity_date, activity_type, sum(n) AS n, count(*) AS users FROM o_user_days GROUP BY ALL) GROUP BY 1),
people AS (SELECT activity_date, len(list_distinct(list(user_id))) AS dau FROM o_user_days GROUP BY 1)
SELECT activity_date, dau, {", ".join(f"CAST(coalesce(m['{k}'].{part}, 0) AS BIGINT) AS {name}" for k, names in _KINDS.items() for part, name in zip(("n", "users"), names) if name)}
FROM kinds JOIN people USING (activity_date)
"""
PARTS["o_by_type"] = """
SELECT CAST(e.activity_date AS DATE) AS activity_date, count(DISTINCT CASE WHEN u.has_finder THEN e.user_id END) AS finder_active,
  count(DISTINCT CASE WHEN NOT u.has_finder THEN e.user_id END) AS standard_active
FROM o_events e JOIN o_std u USING (user_id) GROUP BY 1
"""
PARTS["o_cumulative"] = """
SELECT d.metric_date, (SELECT count(*) FROM o_std u WHERE CAST(u.signup_date AS DATE) <= d.metric_date) AS total_users_cumulative
FROM o_dates d
"""
#: Daily table: output column and the measure it shows; a measure without a row for the day is 0.
_DAILY = {
    "new_signups": "new_users", "total_users": "new_users", "dau": "dau", **{name: name for names in _KINDS.values() for name in names if name},
    "finder_active": "finder_active", "standard_active": "standard_active", "new_finder_signups": "new_finders", "new_standard_signups": "new_standards",
}


def _long(view: str, day: str, *measures: str) -> str:
    entries = ", ".join(f"{{'k': '{m}', 'v': CAST({m} AS BIGINT)}}" for m in measures)
    return f"SELECT {day} AS metric_date, unnest([{entries}]) AS e FROM {view}"


_MEASURES = " UNION ALL ".join((
    _long("o_signups", "signup_date", "new_users", "new_finders", "new_standards"), _long("o_by_type", "activity_date", "finder_active", "standard_active"),
    _long("o_activity", "activity_date", "dau", *[name for names in _KINDS.values() for name in names if name]),
    _long("o_cumulative", "metric_date", "total_users_cumulative"),
))
PARTS["o_daily"] = f"""
WITH days AS (SELECT metric_date, map_from_entries(list(e)) AS m FROM ({_MEASURES}) SEMI JOIN o_dates USING (metric_date) GROUP BY 1),
named AS (SELECT metric_date, m['total_users_cumulative'] AS total_users_cumulative, m['dau'] AS seen, {", ".join(f"coalesce(m['{k}'], 0) AS {name}" for name, k in _DAILY.items())} FROM days)
SELECT * EXCLUDE seen, if(total_users_cumulative = 0, 0.0, {_pct('seen', 'total_users_cumulative')}) AS engagement_rate, coalesce({_pct('active_posters + active_commenters', 'dau')}, 0.0) AS social_engagement_rate
FROM named
"""
#: Monthly table: output column, and what is taken of the month's days.
_SUMS = {
    "new_signups": "new_signups", "sum_dau": "dau", "total_posts": "posts_created", "total_comments": "comments_created", "total_votes": "votes_cast",
    "total_collections": "collections_created",
}
_PEAKS = {"total_users_end_of_month": "total_users_cumulative", "finder_mau": "finder_active", "standard_mau": "standard_active"}
PARTS["o_rollup"] = f"""
WITH months AS (SELECT CAST(date_trunc('month', metric_date) AS DATE) AS metric_month, list(d) AS days FROM o_daily d GROUP BY 1)
SELECT metric_month, len(days) AS total_days, len(list_filter(days, lambda d: d.dau > 0)) AS active_days, list_avg(list_transform(days, lambda d: d.dau)) AS avg_dau,
  {", ".join(f"CAST(list_sum(list_transform(days, lambda d: d.{k})) AS BIGINT) AS {name}" for name, k in _SUMS.items())},
  {", ".join(f"list_max(list_transform(days, lambda d: d.{k})) AS {name}" for name, k in _PEAKS.items())}
FROM months
"""
PARTS["o_mau"] = """
SELECT CAST(date_trunc('month', activity_date) AS DATE) AS metric_month, count(DISTINCT user_id) AS mau, count(*) AS total_activities
FROM o_events WHERE user_id IN (SELECT user_id FROM o_std) GROUP BY 1
"""
PARTS["o_activation"] = """
SELECT CAST(date_trunc('month', signup_date) AS DATE) AS metric_month, count(*) AS cohort_users,
  count(*) FILTER (WHERE activation_status) AS activated_users FROM o_std GROUP BY 1
"""


def _retained(day: str) -> str:
    return f"""
SELECT CAST(date_trunc('month', {day}) AS DATE) AS metric_month, count(*) AS retained_from_prev FROM (
  SELECT user_id FROM o_events WHERE date_trunc('month', activity_date) = date_trunc('month', {day})
  INTERSECT SELECT user_id FROM o_events WHERE date_trunc('month', activity_date) = date_trunc('month', {day} - INTERVAL 1 MONTH)) x
"""


PARTS["o_retained"] = _retained(TODAY)
PARTS["o_weeks"] = f"""
SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month, w.week AS weeks_since_signup, user_id, signup_date,
  signup_date + w.week * INTERVAL 7 DAY AS opens, signup_date + (w.week + 1) * INTERVAL 7 DAY AS closes
FROM o_std, (SELECT unnest(range(0, 53)) AS week) w WHERE signup_date + w.week * INTERVAL 7 DAY <= {TODAY}
"""
PARTS["o_week_activity"] = """
SELECT w.cohort_month, w.weeks_since_signup, w.user_id, count(e.user_id) AS activities
FROM o_weeks w LEFT JOIN o_events e ON e.user_id = w.user_id AND e.activity_date >= w.opens AND e.activity_date < w.closes
GROUP BY 1, 2, 3
"""

_SCORE = "3 * posts_created + 2 * comments_made + votes_cast + 5 * collections_created"
_ACTIONS = "posts_created + comments_made + votes_cast + collections_created"
PARTS["o_levels"] = f"""
SELECT user_id, email, first_name, last_name, has_finder, {_SCORE} AS engagement_score,
  CASE WHEN {_SCORE} >= 50 THEN 'POWER_USER' WHEN {_SCORE} >= 20 THEN 'ACTIVE' WHEN {_ACTIONS} > 0 THEN 'CASUAL'
    WHEN last_activity_date IS NOT NULL THEN 'LURKER' ELSE 'INACTIVE' END AS engagement_level,
  posts_created, comments_made, votes_cast, collections_created, {_ACTIONS} AS total_activities, last_activity_date,
  extract(day FROM ({NOW} - last_activity_date)) AS days_since_last_activity, signup_date, days_since_signup, user_lifecycle_stage,
  {NOW} AS updated_at
FROM o_std
"""
_YEAR = f"CAST(signup_date AS DATE) >= CAST(date_trunc('month', {TODAY}) AS DATE) - INTERVAL 12 MONTH"
PARTS["o_f1"] = f"""
WITH parts AS (SELECT *, date_part(['dow', 'hour', 'month'], signup_date) AS t, days_to_first_activity AS d FROM o_std WHERE {_YEAR})
SELECT user_id, signup_date, created_at, CAST(signup_date - (day(signup_date) - 1) * INTERVAL 1 DAY AS DATE) AS cohort_month, {NOW} AS generated_at,
  has_finder, experience_count, education_count, profile_completion_score, t.dow AS signup_day_of_week, t.hour AS signup_hour, t.month AS signup_month,
  d AS days_to_first_activity, list_filter([d], lambda x: x <= 7)[1] AS days_to_first_activity_7d, len(list_filter([d], lambda x: x <= 1)) = 1 AS activated_within_24h,
  activation_status AS activated, greatest(posts_created, comments_made) > 0 AS activated_social, greatest(votes_cast, collections_created) > 0 AS activated_finder,
  list_sum([posts_created, comments_made, votes_cast, collections_created]) > 2 AS became_engaged
FROM parts
"""
PARTS["o_f2"] = f"""
WITH early AS (SELECT user_id, sum(n) AS acts, count(*) AS kinds FROM (
    SELECT user_id, activity_type, count(*) AS n FROM o_events WHERE days_since_signup <= 30 GROUP BY ALL) GROUP BY 1)
SELECT user_id, s.has_finder, s.profile_completion_score, s.experience_count, s.education_count, s.days_since_signup,
  CAST(coalesce(acts, 0) AS BIGINT) AS first_30d_activities, coalesce(kinds, 0) AS first_30d_activity_types,
  NOT s.profile_completion_score < 50 AS completed_profile, sign(s.experience_count) = 1 AS added_experience, sign(s.education_count) = 1 AS added_education,
  l.engagement_score >= 20 AS became_power_user, l.engagement_score AS engagement_score_90d,
  datediff('day', s.signup_date, s.last_activity_date) >= 90 AND s.last_activity_date - INTERVAL 90 DAY >= s.signup_date AS retained_90d,
  s.user_lifecycle_stage IN ('CHURNED') AS churned, l.engagement_level AS final_engagement_level,
  CAST(s.signup_date - (day(s.signup_date) - 1) * INTERVAL 1 DAY AS DATE) AS cohort_month, s.signup_date, s.last_activity_date, {NOW} AS generated_at
FROM (SELECT * FROM o_std WHERE {_YEAR} AND days_since_signup > 89) s JOIN o_levels l USING (user_id) LEFT JOIN early USING (user_id)
"""

PARTS["o_nodes_of"] = "SELECT n.node_id, u.user_id FROM fx_nodes n JOIN o_users u ON n.node_type = 'Person' AND n.name = u.email"
PARTS["o_role_of"] = """
SELECT DISTINCT e.source_node_id AS node_id, n.node_id AS role_id, n.name AS role_title
FROM fx_edges e LEFT JOIN fx_nodes n ON n.node_id = e.target_node_id AND n.node_type = 'Role' WHERE e.relationship_type = 'WORKED_AS'
"""
PARTS["o_company"] = """
SELECT DISTINCT c.node_id AS company_id, c.name AS company_name, r.role_id, r.role_title, p.user_id
FROM fx_nodes c JOIN fx_edges e ON e.target_node_id = c.node_id AND e.target_node_type = 'Company'
JOIN o_nodes_of p ON p.node_id = e.source_node_id LEFT JOIN o_role_of r ON r.node_id = e.source_node_id
WHERE c.node_type = 'Company' AND e.relationship_type IN ('WORKED_AT', 'WORKS_AT')
"""
PARTS["o_school"] = f"""
SELECT s.node_id AS school_id, s.name AS school_name, d.node_id AS degree_id, d.name AS degree_name, p.user_id,
  extract(year FROM {_spell_date('ed.name')}) AS yr
FROM fx_edges se JOIN fx_nodes s ON s.node_id = se.target_node_id AND s.node_type = 'School'
JOIN fx_nodes ed ON ed.node_id = se.source_node_id AND ed.node_type = 'Education'
JOIN fx_edges pe ON pe.target_node_id = ed.node_id AND pe.relationship_type = 'EDUCATED_IN'
JOIN o_nodes_of p ON p.node_id = pe.source_node_id
LEFT JOIN fx_edges de ON de.source_node_id = ed.node_id AND de.relationship_type = 'EARNED'
LEFT JOIN fx_nodes d ON d.node_id = de.target_node_id AND d.node_type = 'Degree'
WHERE se.relationship_type = 'STUDIED_AT'
"""
PARTS["o_location"] = """
SELECT DISTINCT l.node_id AS location_id, l.name AS country, p.user_id
FROM fx_edges e JOIN fx_nodes l ON l.node_id = e.target_node_id AND l.node_type = 'Location'
JOIN o_nodes_of p ON p.node_id = e.source_node_id WHERE e.relationship_type = 'LIVES_AT'
"""
PARTS["o_project"] = """
SELECT j.node_id AS project_id, j.name AS project_name, c.node_id AS company_id, p.user_id, r.name AS role_title
FROM fx_edges je JOIN fx_nodes j ON j.node_id = je.target_node_id AND j.node_type = 'Project'
JOIN fx_edges pe ON pe.target_node_id = je.source_node_id AND pe.relationship_type = 'EXPERIENCED_IN'
JOIN o_nodes_of p ON p.node_id = pe.source_node_id
LEFT JOIN fx_edges ce ON ce.source_node_id = je.source_node_id AND ce.relationship_type = 'WORKED_AT'
LEFT JOIN fx_nodes c ON c.node_id = ce.target_node_id AND c.node_type = 'Company'
LEFT JOIN fx_edges re ON re.source_node_id = je.source_node_id AND re.relationship_type = 'WORKED_AS'
LEFT JOIN fx_nodes r ON r.node_id = re.target_node_id AND r.node_type = 'Role'
WHERE je.relationship_type = 'WORKED_ON'
"""


def _pairs(target: str, first_types: str, spell_edge: str, spell_target_edge: str, context_edge: str, label: str, names: tuple[str, str], kind: str) -> str:
    started = f"""(SELECT min({_spell_date('sp.name')}) FROM fx_edges pe JOIN fx_edges te ON te.source_node_id = pe.target_node_id
      AND te.relationship_type = '{spell_target_edge}' AND te.target_node_id = a.target_node_id
      JOIN fx_nodes sp ON sp.node_id = pe.target_node_id
      WHERE pe.source_node_id = a.source_node_id AND pe.relationship_type = '{spell_edge}')"""
    return f"""
SELECT x.user_id, x.related_user_id, '{kind}' AS relationship_type, x.strength AS relationship_strength,
  CAST(json_object('{names[0]}', x.places, '{names[1]}', coalesce((SELECT list_sort(list(DISTINCT t.name)) FROM fx_edges ce
    JOIN fx_nodes t ON t.node_id = ce.target_node_id AND t.node_type = '{label}'
    WHERE ce.relationship_type = '{context_edge}' AND ce.source_node_id = x.node_id), CAST([] AS VARCHAR[]))) AS VARCHAR) AS connection_context,
  x.first_connected_at
FROM (SELECT ua.user_id, ub.user_id AS related_user_id, min(a.source_node_id) AS node_id, count(DISTINCT a.target_node_id) AS strength,
    list_sort(list(DISTINCT c.name)) AS places, min(a.started) AS first_connected_at
  FROM (SELECT a.*, {started} AS started FROM (SELECT DISTINCT source_node_id, target_node_id FROM fx_edges
      WHERE target_node_type = '{target}' AND source_node_type = 'Person' AND relationship_type IN ({first_types})) a) a
  JOIN (SELECT DISTINCT source_node_id, target_node_id FROM fx_edges WHERE target_node_type = '{target}') b
    ON a.target_node_id = b.target_node_id AND a.source_node_id < b.source_node_id
  JOIN o_nodes_of ua ON ua.node_id = a.source_node_id JOIN o_nodes_of ub ON ub.node_id = b.source_node_id
  JOIN fx_nodes c ON c.node_id = a.target_node_id
  WHERE ua.user_id <> ub.user_id GROUP BY 1, 2) x
"""


def _memberships(target: str, own_types: str, spell_edge: str, spell_target_edge: str, context_edge: str, label: str, kind: str) -> str:
    return f"""
WITH member AS (
  SELECT e.target_node_id AS grp, u.user_id, bool_or(e.relationship_type IN ({own_types})) AS leads
  FROM fx_edges e JOIN o_nodes_of u ON u.node_id = e.source_node_id WHERE e.target_node_type = '{target}' GROUP BY ALL
), entry AS (SELECT user_id, min(node_id) AS member_key FROM o_nodes_of GROUP BY ALL),
spell AS (
  SELECT t.target_node_id AS grp, u.user_id, min({_spell_date('s.name')}) AS first_connected_at
  FROM fx_edges t JOIN fx_edges h ON h.target_node_id = t.source_node_id AND h.relationship_type = '{spell_edge}'
  JOIN o_nodes_of u ON u.node_id = h.source_node_id JOIN fx_nodes s ON s.node_id = t.source_node_id
  WHERE t.relationship_type = '{spell_target_edge}' AND t.target_node_type = '{target}' GROUP BY ALL
), title AS (
  SELECT u.user_id, string_agg(DISTINCT n.name, ',' ORDER BY n.name) AS titles
  FROM fx_edges e JOIN fx_nodes n ON n.node_id = e.target_node_id AND n.node_type = '{label}' JOIN o_nodes_of u ON u.node_id = e.source_node_id
  WHERE e.relationship_type = '{context_edge}' GROUP BY ALL
)
SELECT '{kind}' AS relationship_type, grp AS group_id, c.name AS group_name, user_id, member_key, leads, first_connected_at, titles,
  count(*) OVER (PARTITION BY grp) AS group_size, count(*) OVER (PARTITION BY grp ORDER BY member_key DESC) - 1 AS later_members
FROM member JOIN entry USING (user_id) JOIN fx_nodes c ON c.node_id = grp LEFT JOIN spell USING (grp, user_id) LEFT JOIN title USING (user_id)
"""


PARTS["o_worked"] = _pairs(
    "Company", "'EXPERIENCED_IN', 'WORKED_AT'", "EXPERIENCED_IN", "WORKED_AT", "WORKED_AS", "Role", ("companies", "roles"), "WORKED_TOGETHER"
)
PARTS["o_studied"] = _pairs(
    "School", "'EDUCATED_IN', 'STUDIED_AT'", "EDUCATED_IN", "STUDIED_AT", "EARNED", "Degree", ("schools", "degrees"), "STUDIED_TOGETHER"
)
PARTS["o_relations"] = "SELECT * FROM o_worked UNION ALL SELECT * FROM o_studied"
PARTS["o_groups"] = """
SELECT company_id, company_name, role_id, role_title, list_sort(list(DISTINCT user_id)) AS ids, count(DISTINCT user_id) AS user_count
FROM o_company GROUP BY 1, 2, 3, 4
"""

def _leading(groups: str, keys: str, name: str, by_count: bool = False) -> str:
    """Ten names for each owner group, of the largest overlapping group first."""
    choose = "size DESC, nm" if by_count else "nm"
    return f"""
SELECT {keys}, string_agg(nm, ',' ORDER BY size DESC, nm) AS names FROM (
  SELECT {keys}, nm, size, row_number() OVER (PARTITION BY {keys} ORDER BY {choose}) AS place FROM (
    SELECT {keys}, {name} AS nm, max(user_count) AS size FROM {groups} WHERE {name} IS NOT NULL GROUP BY ALL)) WHERE place <= 10 GROUP BY ALL
"""


PARTS["o_located"] = """
SELECT DISTINCT l.location_id, l.country, c.company_id, c.role_id, c.company_name, c.role_title, g.user_count
FROM o_location l JOIN o_company c USING (user_id)
JOIN o_groups g ON g.company_id = c.company_id AND g.role_id IS NOT DISTINCT FROM c.role_id
"""
PARTS["o_schooled"] = """
SELECT DISTINCT s.school_id, coalesce(s.degree_id, '') AS degree, c.company_name, c.role_title, g.user_count
FROM o_school s JOIN o_company c USING (user_id)
JOIN o_groups g ON g.company_id = c.company_id AND g.role_id IS NOT DISTINCT FROM c.role_id
"""


def _location_sql(by_count: bool) -> str:
    return f"""
WITH kinds AS (SELECT location_id, len(list_distinct(list(company_id))) AS companies, len(list_distinct(list(role_id))) AS roles FROM o_located GROUP BY 1),
firms AS ({_leading('o_located', 'location_id', 'company_name', by_count)}), jobs AS ({_leading('o_located', 'location_id', 'role_title', by_count)})
SELECT location_id, country, user_id, count(*) OVER (PARTITION BY location_id) AS user_count, CAST(coalesce(companies, 0) AS DOUBLE) AS company_diversity_score,
  CAST(coalesce(roles, 0) AS DOUBLE) AS role_diversity_score, firms.names AS top_companies, jobs.names AS top_roles
FROM (SELECT DISTINCT location_id, country, user_id FROM o_location) LEFT JOIN kinds USING (location_id) LEFT JOIN firms USING (location_id) LEFT JOIN jobs USING (location_id)
"""


PARTS["o_inbox_unread"] = """
WITH due AS (
  SELECT p.person_id, m.conversation_id, m.id FROM fx_members p JOIN fx_messages m USING (conversation_id) WHERE m.sender_id <> p.person_id
  EXCEPT SELECT r.person_id, m.conversation_id, m.id FROM fx_message_reads r JOIN fx_messages m ON m.id = r.message_id
), waiting AS (SELECT person_id, conversation_id, count(*) AS n FROM due GROUP BY ALL),
rooms AS (SELECT conversation_id, list_sort(list(DISTINCT person_id)) AS ids FROM fx_members GROUP BY 1)
SELECT p.*, coalesce(n, 0) AS unread_count, list_filter(ids, lambda x: x <> p.person_id)[1] AS other_person_id, len(ids) AS participants
FROM fx_members p JOIN rooms USING (conversation_id) LEFT JOIN waiting USING (person_id, conversation_id)
"""
PARTS["o_inbox"] = """
SELECT p.person_id, p.conversation_id, c.conversation_type, c.updated_at, p.folder, p.last_read_at, p.notification_level,
  p.other_person_id, o.first_name || ' ' || o.last_name AS other_name, o.email AS other_email, m.id AS last_message_id,
  m.body AS last_message_body, m.sender_id AS last_sender_id, m.created_at AS last_message_at, m.message_type AS last_message_type,
  p.unread_count
FROM o_inbox_unread p JOIN fx_conversations c ON c.id = p.conversation_id LEFT JOIN fx_chat_people o ON o.id = p.other_person_id
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at DESC, id DESC) AS rn FROM fx_messages) m
  ON m.conversation_id = p.conversation_id AND m.rn = 1
WHERE p.left_at IS NULL
"""

SQL: dict[str, str] = {}

# Sources and sinks

SQL["a1_active_scan"] = "SELECT id, email, first_name, last_name, created_at FROM fx_persons WHERE deleted_at IS NULL"
SQL["a2_orphan_filter"] = """
SELECT id, person_id, company_id, start_date FROM fx_work WHERE person_id IN (SELECT id FROM fx_persons WHERE deleted_at IS NULL)
"""
SQL["a2_orphan_filter_all"] = " UNION ALL ".join(
    f"SELECT '{name}' AS child, count(*) AS kept FROM fx_{name} WHERE {key} IN ({owners})"
    for name, key, owners in [
        *[(n, k, "SELECT id FROM fx_persons WHERE deleted_at IS NULL") for n, k in (
            ("work", "person_id"), ("study", "person_id"), ("votes", "voter_id"), ("collections", "person_id"), ("views", "person_id"))],
        *[(n, k, "SELECT id FROM fx_engagement_persons") for n, k in (
            ("posts", "person_id"), ("comments", "person_id"), ("group_members", "person_id"), ("mentions", "mentioned_person_id"), ("groups", "created_by"))],
    ]
)
SQL["a3_full_refresh"] = "SELECT id, person_id, company_id, created_at FROM fx_work WHERE deleted_at IS NULL"
SQL["a4_upsert"] = """
SELECT coalesce(o.id, c.c_custkey) AS id, o.version, CASE WHEN o.id IS NULL THEN c.c_acctbal ELSE o.amount END AS amount
FROM customer c FULL JOIN (
  SELECT CASE o_orderstatus WHEN 'O' THEN -o_custkey ELSE o_custkey END AS id, max(o_orderkey) AS version, arg_max(o_totalprice, o_orderkey) AS amount
  FROM orders GROUP BY 1) o ON o.id = c.c_custkey
"""
SQL["a5_json_text"] = """
SELECT id, CAST(json_object('headline_description', headline_description, 'linked_in_url', linked_in_url, 'location_id', location_id) AS VARCHAR) AS profile
FROM fx_persons
"""
SQL["a6_glossary_scan"] = "SELECT id, term, meaning, category, description FROM fx_glossary"
SQL["a7_nodes"] = "SELECT node_type AS label, node_id, name AS value FROM fx_nodes"
SQL["a8_dedupe_first"] = """
SELECT role_id, id, company_id FROM (SELECT *, row_number() OVER (PARTITION BY role_id ORDER BY id) AS rn FROM fx_experiences WHERE role_id IS NOT NULL)
WHERE rn = 1
"""
SQL["a9_edge_list"] = """
SELECT CASE WHEN a_person_id IS NOT NULL THEN a_person_id WHEN a_experience_id IS NOT NULL THEN a_experience_id
    WHEN a_education_id IS NOT NULL THEN a_education_id ELSE a_internal END AS source_node_id, a_label AS source_node_type,
  type AS relationship_type, coalesce(b_company_id, b_role_id, b_school_id, b_location_id, b_internal) AS target_node_id,
  b_label AS target_node_type
FROM fx_rels
"""
SQL["a10_extraction_log"] = """
SELECT k.kind AS extraction_type, (SELECT count(*) FROM fx_nodes) AS nodes_extracted, (SELECT count(*) FROM fx_edges) AS relationships_extracted,
  'success' AS status FROM (VALUES ('full'), ('incremental')) k(kind)
"""
SQL["a11_refresh"] = "SELECT engagement_level, count(*) AS users FROM o_levels GROUP BY 1"
SQL["a12_export_activation"] = f"""
SELECT user_id, has_finder::INT AS has_finder, experience_count, education_count, profile_completion_score, signup_day_of_week,
  signup_hour, signup_month, days_to_first_activity_7d, activated_within_24h::INT AS activated_within_24h, activated::INT AS activated,
  activated_social::INT AS activated_social, activated_finder::INT AS activated_finder, became_engaged::INT AS became_engaged
FROM o_f1 WHERE cohort_month >= date_trunc('month', {NOW} - INTERVAL 6 MONTH)
"""
SQL["a13_export_engagement"] = f"""
SELECT user_id, has_finder::INT AS has_finder, profile_completion_score, experience_count, education_count, days_since_signup,
  first_30d_activities, first_30d_activity_types, completed_profile::INT AS completed_profile, added_experience::INT AS added_experience,
  added_education::INT AS added_education, became_power_user::INT AS became_power_user, engagement_score_90d,
  retained_90d::INT AS retained_90d, churned::INT AS churned, final_engagement_level
FROM o_f2 WHERE cohort_month >= date_trunc('month', {NOW} - INTERVAL 6 MONTH)
"""
SQL["a15_stage_runner"] = " UNION ALL ".join(
    f"SELECT '{stage}' AS stage, 'ok' AS status, (SELECT count(*) FROM {table}) AS rows"
    for stage, table in (
        ("unified_users", "o_users"), ("activity_events", "o_all_owned_events"), ("daily_metrics", "o_dates"),
        ("user_engagement_levels", "o_std"), ("glossary_terms", "o_terms"),
        ("staging_persons", "(SELECT * FROM fx_persons WHERE deleted_at IS NULL) p"), ("staging_social_persons", "fx_engagement_persons"),
        *[(f"staging_{name}", f"(SELECT c.* FROM {view} c SEMI JOIN {owners} o ON CAST(o.id AS VARCHAR) = CAST(c.{key} AS VARCHAR) WHERE c.deleted_at IS NULL) s")
          for name, view, key, owners in (
              *[(name, view, key, "(SELECT * FROM fx_persons WHERE deleted_at IS NULL)") for name, view, key in (
                  ("experiences", "fx_work", "person_id"), ("education", "fx_study", "person_id"), ("collections", "fx_collections", "person_id"),
                  ("query_votes", "fx_votes", "voter_id"), ("view_access", "fx_views", "person_id"))], ("posts", "fx_posts", "person_id", "fx_engagement_persons"),
              ("comments", "fx_comments", "person_id", "fx_engagement_persons"), ("group_members", "fx_group_members", "person_id", "fx_engagement_persons"),
              ("mentions", "fx_mentions", "mentioned_person_id", "fx_engagement_persons"))],
        ("staging_glossary", "fx_glossary"), ("staging_graph_nodes", "fx_nodes"), ("staging_graph_edges", "fx_edges"),
    )
)
PARTS["o_terms"] = """
SELECT id AS glossary_id, CASE WHEN trim(term) <> '' THEN trim(term) END AS term, CASE WHEN trim(meaning) <> '' THEN trim(meaning) END AS meaning,
  CASE WHEN trim(category) <> '' THEN trim(category) END AS category, description FROM fx_glossary WHERE coalesce(trim(description), '') <> ''
"""
PARTS["o_all_owned_events"] = "SELECT * FROM o_events"
SQL["a16_active_count"] = "SELECT count(*) AS active_users FROM fx_persons WHERE deleted_at IS NULL"

# Users, events, cohorts

SQL["u1_merge_identity"] = "SELECT user_id, engagement_person_id, email, first_name, last_name FROM o_people"
for _name, _columns in {
    "u2_user_type": "has_finder, user_type",
    "u3_activity_counts": "experience_count, education_count, posts_created, comments_made, votes_cast, collections_created, "
    "mentions_received, groups_joined, views_given",
    "u4_completion_score": "profile_completion_score",
    "u5_last_activity": "last_activity_date",
    "u6_first_dates": "first_post_date, first_vote_date",
    "u7_days_since_signup": "days_since_signup",
    "u8_days_to_first": "days_to_first_activity",
    "u9_lifecycle_stage": "user_lifecycle_stage",
    "u10_activation_status": "activation_status",
    "u11_activated_at": "activated_at",
}.items():
    SQL[_name] = f"SELECT user_id, {_columns} FROM o_users"
SQL["u12_unified_users"] = "SELECT * FROM o_users"
SQL["g1_glossary"] = "SELECT *, coalesce(term, meaning, category) AS display_value FROM o_terms"
for _name, _part in (
    ("e1_post_events", "o_posts"), ("e2_comment_events", "o_comments"), ("e3_vote_events", "o_votes"),
    ("e4_collection_events", "o_collections"), ("e5_view_events", "o_views"), ("e6_activity_events", "o_events"),
):
    SQL[_name] = f"SELECT {_EVENT_COLUMNS} FROM {_part}"
SQL["e7_first_of_type"] = """
SELECT p.id, p.person_id, NOT EXISTS (SELECT 1 FROM fx_posts q WHERE q.person_id = p.person_id AND q.created_at < p.created_at)
  AS is_first_activity_of_type FROM fx_posts p
"""
SQL["e8_hex_id"] = "SELECT s.id, CAST('0x' || substr(replace(s.id, '-', ''), 1, 15) AS BIGINT) AS source_id FROM fx_comments s"
SQL["e9_event_day"] = "SELECT user_id, activity_type, source_id, days_since_signup FROM o_events"
_AFTER = (30, 60, 90)
SQL["c1_user_cohorts"] = f"""
WITH months AS (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month, has_finder, profile_completion_score AS score, experience_count AS jobs,
    education_count AS schools, activation_status AS active, days_to_first_activity AS wait,
    list_filter([{", ".join(map(str, _AFTER))}], lambda d: last_activity_date >= signup_date + d * INTERVAL 1 DAY) AS stayed FROM o_std),
counted AS (SELECT cohort_month, count(*) AS total_users, CAST(count_if(has_finder) AS BIGINT) AS finder_users, CAST(count_if(active) AS BIGINT) AS activated_users,
    {_mean('score')} AS avg_profile_completion, {_mean('jobs')} AS avg_experience_count, {_mean('schools')} AS avg_education_count,
    {_mean('wait', 'wait < 10000')} AS avg_days_to_activation, {", ".join(f"CAST(count_if(list_contains(stayed, {d})) AS BIGINT) AS retained_{d}d" for d in _AFTER)}
  FROM months GROUP BY 1)
SELECT *, total_users - finder_users AS standard_users, {_pct('activated_users', 'total_users')} AS activation_rate,
  {", ".join(f"{_pct(f'retained_{d}d', 'total_users')} AS retention_rate_{d}d" for d in _AFTER)}
FROM counted
"""

# KPIs

SQL["d1_daily_signups"] = "SELECT * FROM o_signups"
SQL["d2_daily_activity"] = "SELECT * FROM o_activity"
SQL["d3_daily_active_by_type"] = "SELECT * FROM o_by_type"
SQL["d4_date_series"] = "SELECT * FROM o_dates"
SQL["n5_cumulative_users"] = "SELECT * FROM o_cumulative"
SQL["d5_daily_metrics"] = "SELECT * FROM o_daily"
SQL["m1_monthly_rollup"] = "SELECT * EXCLUDE (sum_dau) REPLACE (round(avg_dau, 4) AS avg_dau) FROM o_rollup"
SQL["m2_monthly_active"] = "SELECT * FROM o_mau"
SQL["m3_monthly_activation"] = "SELECT * FROM o_activation"
SQL["m4_retained_from_previous"] = _retained(SNAP_DAY)
SQL["m2_active_from_sets"] = "SELECT metric_month, mau FROM o_mau"
SQL["m4_retained_by_month"] = """
WITH active AS (SELECT DISTINCT CAST(date_trunc('month', activity_date) AS DATE) AS metric_month, user_id FROM o_events)
SELECT a.metric_month, count(b.user_id) AS retained_from_prev
FROM active a LEFT JOIN active b ON b.user_id = a.user_id AND b.metric_month = CAST(a.metric_month - INTERVAL 1 MONTH AS DATE)
GROUP BY 1
"""
SQL["m5_monthly_metrics"] = f"""
WITH joined AS (SELECT r.*, m.mau, m.total_activities, a.cohort_users, a.activated_users, t.retained_from_prev,
    lag(r.total_users_end_of_month) OVER (ORDER BY r.metric_month) AS before_total, lag(m.mau) OVER (ORDER BY r.metric_month) AS before_mau
  FROM o_rollup r LEFT JOIN o_mau m USING (metric_month) LEFT JOIN o_activation a USING (metric_month) LEFT JOIN o_retained t USING (metric_month))
SELECT metric_month, new_signups, total_users_end_of_month,
  CASE WHEN before_total > 0 THEN {_pct('total_users_end_of_month - before_total', 'before_total')} ELSE 0.0 END AS growth_rate_pct,
  coalesce(mau, 0) AS mau, {_ratio('sum_dau', 'total_days')} AS avg_dau, total_posts, total_comments, total_votes, total_collections,
  CASE WHEN cohort_users > 0 THEN {_pct('activated_users', 'cohort_users')} ELSE 0.0 END AS activation_rate,
  CASE WHEN mau > 0 THEN {_ratio('total_activities', 'mau')} ELSE 0.0 END AS avg_activities_per_user,
  CASE WHEN mau > 0 THEN {_ratio('3 * total_posts + 2 * total_comments + total_votes + 5 * total_collections', 'mau')} ELSE 0.0 END AS avg_engagement_score,
  finder_mau, standard_mau,
  CASE WHEN total_users_end_of_month > 0 THEN {_pct('finder_mau', 'total_users_end_of_month')} ELSE 0.0 END AS finder_adoption_pct,
  coalesce(retained_from_prev, 0) AS retained_from_prev_month,
  CASE WHEN before_mau > 0 THEN {_pct('retained_from_prev', 'before_mau')} ELSE 0.0 END AS retention_rate
FROM joined
"""
SQL["r1_cohort_weeks"] = "SELECT cohort_month, weeks_since_signup, user_id, signup_date FROM o_weeks"
SQL["r2_cohort_activity"] = "SELECT * FROM o_week_activity"
SQL["r3_cohort_retention"] = f"""
WITH grid AS (SELECT cohort_month, weeks_since_signup, count(*) AS total_users, count(*) FILTER (WHERE activities > 0) AS retained_users,
    CAST(sum(activities) AS BIGINT) AS total_activities, {_mean('activities', 'activities > 0')} AS mean
  FROM o_week_activity GROUP BY 1, 2)
SELECT g.cohort_month, g.weeks_since_signup, g.total_users, g.retained_users, {_pct('g.retained_users', 'g.total_users')} AS retention_rate,
  {_pct('g.retained_users', 'b.total_users')} AS cumulative_retention, g.mean AS avg_activities_per_user, g.total_activities
FROM grid g JOIN grid b ON b.cohort_month = g.cohort_month AND b.weeks_since_signup = (SELECT min(z.weeks_since_signup) FROM grid z WHERE z.cohort_month = g.cohort_month)
"""
SQL["r4_week_bucket"] = """
SELECT week, count(*) AS events FROM (
  SELECT w.week FROM (SELECT e.activity_date - INTERVAL 5 HOUR AS at, u.signup_date FROM o_events e JOIN o_users u USING (user_id)) x
  LEFT JOIN (SELECT unnest(range(0, 53)) AS week) w
    ON x.at >= x.signup_date + w.week * INTERVAL 7 DAY AND x.at < x.signup_date + (w.week + 1) * INTERVAL 7 DAY) y
GROUP BY 1
"""
SQL["k1_post_metrics"] = f"""
WITH d AS (SELECT CAST(activity_date AS DATE) AS metric_date, sum((activity_type = 'post')::BIGINT)::BIGINT AS p,
    sum((activity_type = 'comment')::BIGINT)::BIGINT AS c, sum((activity_type = 'vote')::BIGINT)::BIGINT AS v,
    count(DISTINCT CASE activity_type WHEN 'post' THEN user_id END) AS up, count(DISTINCT CASE activity_type WHEN 'comment' THEN user_id END) AS uc,
    count(CASE WHEN activity_type = 'post' AND NOT (linked OR pictured) THEN 1 END) AS t,
    count(CASE WHEN activity_type = 'post' AND linked THEN 1 END) AS l, count(CASE WHEN activity_type = 'post' AND pictured THEN 1 END) AS m
  FROM o_events WHERE activity_type NOT IN ('view', 'collection') GROUP BY 1)
SELECT metric_date, p AS posts_created, c AS comments_created, up AS unique_posters, uc AS unique_commenters, {_ratio('p', 'up')} AS avg_posts_per_poster,
  {_ratio('c', 'p')} AS avg_comments_per_post, {_ratio('v', 'p')} AS avg_votes_per_post, {_pct('c', 'p')} AS engagement_rate_comments_pct,
  {_pct('v', 'p')} AS engagement_rate_votes_pct, v AS total_votes, t AS text_posts, l AS link_posts, m AS media_posts FROM d
"""
SQL["k2_finder_metrics"] = """
SELECT CAST(activity_date AS DATE) AS metric_date, count(CASE activity_type WHEN 'vote' THEN 1 END) AS total_votes,
  count(DISTINCT CASE activity_type WHEN 'vote' THEN user_id END) AS unique_voters, count(CASE activity_type WHEN 'view' THEN 1 END) AS profiles_viewed,
  count(DISTINCT CASE activity_type WHEN 'view' THEN user_id END) AS unique_profile_viewers
FROM o_events WHERE activity_type = 'vote' OR activity_type = 'view' GROUP BY 1
"""
SQL["k3_collection_metrics"] = """
SELECT CAST(activity_date AS DATE) AS metric_date, count(*) AS total_collections_created, count(CASE privacy WHEN 'PUBLIC' THEN 1 END) AS public_collections,
  count(CASE privacy WHEN 'PRIVATE' THEN 1 END) AS private_collections, count(DISTINCT user_id) AS unique_collectors
FROM o_collections GROUP BY 1
"""
_ADDED = {"profiles_updated": ("fx_persons", "updated_at", "updated_at IS DISTINCT FROM created_at"), "experiences_added": ("fx_work", "created_at", "TRUE"),
          "education_added": ("fx_study", "created_at", "TRUE")}
_WITH = {"headline": "p.headline_description IS NOT NULL", "linkedin": "p.linked_in_url IS NOT NULL", "location": "p.location_id IS NOT NULL",
         "experience": "u.experience_count > 0", "education": "u.education_count > 0"}
SQL["k4_profile_metrics"] = f"""
WITH added AS (SELECT {", ".join(f"CAST(count_if(k = '{k}') AS BIGINT) AS {k}" for k in _ADDED)} FROM (
    {" UNION ALL ".join(f"SELECT '{k}' AS k FROM {view} WHERE deleted_at IS NULL AND {at}::DATE = {SNAP_DAY} AND {test}" for k, (view, at, test) in _ADDED.items())}) x)
SELECT {SNAP_DAY} AS metric_date, a.*, b.* FROM added a, (
  SELECT {_mean('u.profile_completion_score')} AS avg_profile_completion_score, {", ".join(f"CAST(count_if({test}) AS BIGINT) AS profiles_with_{name}" for name, test in _WITH.items())}
  FROM o_std u JOIN fx_persons p ON p.id = u.user_id) b
"""
SQL["k5_funnel_metrics"] = f"""
WITH t AS (SELECT count(*) AS n, count(CASE WHEN first_name IS NOT NULL AND last_name IS NOT NULL AND email IS NOT NULL THEN 1 END) AS basic,
    count(CASE WHEN first_name IS NOT NULL AND last_name IS NOT NULL THEN 1 END) AS named, count(CASE WHEN experience_count > 0 THEN 1 END) AS x,
    count(CASE WHEN education_count > 0 THEN 1 END) AS e, count(CASE WHEN profile_completion_score >= 70 THEN 1 END) AS c,
    count(CASE WHEN activation_status THEN 1 END) AS a FROM o_std)
SELECT {TODAY} AS metric_date, n AS total_signups, basic AS profiles_with_basic_info, x AS profiles_with_experience, e AS profiles_with_education,
  c AS profiles_completed, a AS profiles_activated, {_pct('named', 'n')} AS basic_info_rate, {_pct('x', 'n')} AS experience_rate,
  {_pct('e', 'n')} AS education_rate, {_pct('c', 'n')} AS completion_rate, {_pct('a', 'n')} AS activation_rate FROM t
"""
SQL["v1_engagement_levels"] = "SELECT * FROM o_levels"
SQL["f1_activation_training"] = "SELECT * FROM o_f1"
SQL["f2_engagement_training"] = "SELECT * FROM o_f2"

# Graph

SQL["n1_listed_pairs"] = "SELECT * FROM o_worked"
SQL["n1_worked_together"] = _memberships("Company", "'EXPERIENCED_IN', 'WORKED_AT'", "EXPERIENCED_IN", "WORKED_AT", "WORKED_AS", "Role", "WORKED_TOGETHER")
SQL["n2_studied_together"] = _memberships("School", "'EDUCATED_IN', 'STUDIED_AT'", "EDUCATED_IN", "STUDIED_AT", "EARNED", "Degree", "STUDIED_TOGETHER")
for _n, _part in (("n1", "o_worked"), ("n2", "o_studied")):
    SQL[f"{_n}_relationships_of"] = f"""
    WITH ends AS (SELECT user_id AS a, related_user_id AS b, * FROM {_part} UNION ALL SELECT related_user_id, user_id, * FROM {_part})
    SELECT a AS user_id, b AS related_user_id, relationship_type, relationship_strength FROM ends WHERE a % 20 = 0
    """
SQL["n1_worked_together_direct"] = "SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS first_connected_at) FROM o_worked"
SQL["n2_listed_pairs"] = "SELECT * FROM o_studied"
SQL["n3_company_networks"] = """
SELECT DISTINCT company_id, company_name, role_id, role_title, user_id, user_count FROM (SELECT *, unnest(ids) AS user_id FROM o_groups)
"""
SQL["n4_education_networks"] = f"""
SELECT * EXCLUDE ids, unnest(ids) AS user_id FROM (SELECT school_id, school_name, degree_id, degree_name, list(DISTINCT user_id) AS ids,
  count(DISTINCT user_id) AS user_count, min(yr) AS graduation_year_min, max(yr) AS graduation_year_max FROM o_school GROUP BY 1, 2, 3, 4)
"""
SQL["n6_location_networks"] = f"""
SELECT DISTINCT location_id, country, user_id, count(user_id) OVER (PARTITION BY location_id, country) AS user_count FROM o_location
"""
PARTS["o_project_groups"] = f"""
WITH g AS (SELECT project_id, project_name, company_id, list(DISTINCT user_id) AS ids, count(DISTINCT user_id) AS user_count,
  list(DISTINCT role_title) FILTER (WHERE role_title IS NOT NULL) AS titles FROM o_project GROUP BY 1, 2, 3)
SELECT project_id, project_name, company_id, user_count, unnest(ids) AS user_id, NULL::VARCHAR AS role_title FROM g
UNION ALL SELECT project_id, project_name, company_id, user_count, NULL, unnest(titles) FROM g
"""
SQL["n7_project_collaborations"] = "SELECT * FROM o_project_groups"
SQL["n8_career_paths"] = f"""
WITH spells AS (SELECT p.user_id, x.node_id AS spell, {_spell_date('x.name')} AS start FROM o_nodes_of p
    JOIN fx_edges e ON e.source_node_id = p.node_id AND e.relationship_type = 'EXPERIENCED_IN' JOIN fx_nodes x ON x.node_id = e.target_node_id),
steps AS (SELECT s.user_id, r.name AS title, min(s.start) AS start FROM spells s JOIN fx_edges e ON e.source_node_id = s.spell AND e.relationship_type = 'WORKED_AS'
    JOIN fx_nodes r ON r.node_id = e.target_node_id GROUP BY 1, 2),
paths AS (SELECT user_id, string_agg(title, '->' ORDER BY start ASC NULLS LAST, title) AS path_vector, count(*) AS number_of_roles, min(start) AS since FROM steps GROUP BY 1)
SELECT user_id, path_vector, number_of_roles,
  (SELECT count(DISTINCT e.target_node_id) FROM spells s JOIN fx_edges e ON e.source_node_id = s.spell AND e.relationship_type = 'WORKED_AT'
    WHERE s.user_id = paths.user_id) AS number_of_companies,
  date_sub('year', since, {NOW}) AS total_years_experience, md5(path_vector) AS path_hash FROM paths
"""
_RECOMMENDATIONS = """
SELECT least(user_id, related_user_id) AS user_id, greatest(user_id, related_user_id) AS recommended_user_id,
  CAST(10 * max(relationship_strength) AS DOUBLE) AS recommendation_score,
  CASE WHEN bool_or(relationship_type = 'WORKED_TOGETHER') THEN 'Worked at the same companies'
    WHEN bool_or(relationship_type = 'STUDIED_TOGETHER') THEN 'Studied at the same schools' ELSE 'Have connections in common' END AS recommendation_reason
FROM o_relations GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 100000
"""
SQL["l1_connection_recommendations"] = SQL["l1_recommendations_small_hubs"] = _RECOMMENDATIONS
SQL["l1_shared_names"] = f"""
WITH best AS ({_RECOMMENDATIONS}),
named AS (SELECT least(user_id, related_user_id) AS low, greatest(user_id, related_user_id) AS high, relationship_type AS kind,
  CAST(coalesce(json_extract(connection_context, '$.companies'), json_extract(connection_context, '$.schools')) AS VARCHAR[]) AS names FROM o_relations)
SELECT user_id, recommended_user_id, coalesce(max(array_to_string(names, ',')) FILTER (WHERE kind = 'WORKED_TOGETHER'), '') AS common_companies,
  coalesce(max(array_to_string(names, ',')) FILTER (WHERE kind = 'STUDIED_TOGETHER'), '') AS common_schools
FROM best JOIN named ON low = user_id AND high = recommended_user_id GROUP BY 1, 2
"""
SQL["l2_company_network_map"] = """
SELECT * EXCLUDE ids, unnest(ids) AS employee_id FROM (
SELECT a.company_id AS company_id_1, b.company_id AS company_id_2, min(a.company_name) AS company_name_1, min(b.company_name) AS company_name_2,
  count(DISTINCT a.user_id) AS shared_employee_count, list(DISTINCT a.user_id) AS ids,
  CAST(count(DISTINCT a.user_id) AS DOUBLE) AS network_strength_score
FROM o_company a JOIN o_company b ON a.user_id = b.user_id AND a.company_id < b.company_id
GROUP BY 1, 2 ORDER BY shared_employee_count DESC, 1, 2 LIMIT 10000)
"""
SQL["l3_skills_matching"] = f"""
SELECT u.user_id, x.role_id, x.role_title, CAST(least(date_sub('year', u.signup_date, CAST({TODAY} AS TIMESTAMP)), 50) AS DOUBLE) AS experience_years,
  CAST(least(10 * u.experience_count + u.profile_completion_score // 10, 999) AS DOUBLE) AS proficiency_score, x.company_id,
  g.user_count AS similar_user_count
FROM (SELECT user_id, role_id, min(role_title) AS role_title, min(company_id) AS company_id FROM o_company WHERE role_id IS NOT NULL GROUP BY 1, 2) x
JOIN o_users u ON u.user_id = x.user_id JOIN o_groups g ON g.company_id = x.company_id AND g.role_id = x.role_id
ORDER BY u.user_id, x.role_id LIMIT 50000
"""
SQL["l4_career_path_patterns"] = """
WITH t AS (SELECT company_id, list_sort(list(DISTINCT role_title)) AS titles, list_sort(list(DISTINCT user_id)) AS ids, count(DISTINCT user_id) AS n
  FROM o_company WHERE role_title IS NOT NULL GROUP BY 1 HAVING count(DISTINCT user_id) > 1)
SELECT company_id, array_to_string(titles, ' -> ') AS path_vector, md5(array_to_string(titles, ' -> ')) AS path_hash, array_to_string(titles, ',') AS role_sequence,
  n AS user_count, unnest(ids) AS user_id, 2.5::DOUBLE AS avg_years_per_role
FROM (SELECT * FROM t ORDER BY n DESC, company_id LIMIT 1000)
"""
SQL["l5_location_based_networks"] = _location_sql(False)
SQL["l5_location_networks_by_count"] = _location_sql(True)
SQL["l6_alumni_networks"] = f"""
WITH firms AS ({_leading('o_schooled', 'school_id, degree', 'company_name')}), jobs AS ({_leading('o_schooled', 'school_id, degree', 'role_title')}),
years AS (SELECT school_id, coalesce(degree_id, '') AS degree, min(yr) AS low, max(yr) AS high FROM o_school GROUP BY ALL)
SELECT school_id, school_name, coalesce(degree_id, 'ALL') AS degree_id, degree_name, user_id, count(*) OVER (PARTITION BY school_id, degree) AS alumni_count,
  low AS graduation_year_min, high AS graduation_year_max, firms.names AS current_companies, jobs.names AS current_roles
FROM (SELECT DISTINCT school_id, school_name, degree_id, degree_name, user_id, coalesce(degree_id, '') AS degree FROM o_school)
JOIN years USING (school_id, degree) LEFT JOIN firms USING (school_id, degree) LEFT JOIN jobs USING (school_id, degree)
"""
SQL["l7_project_graph"] = """
SELECT p.project_id, p.project_name, p.company_id, (SELECT min(c.company_name) FROM o_company c WHERE c.company_id = p.company_id) AS company_name,
  p.user_id, p.user_count, p.role_title, CAST(p.user_count AS DOUBLE) AS collaboration_strength FROM o_project_groups p
"""
_SUMMARY = """
SELECT user_id, count(*) AS total_connections, count(CASE relationship_type WHEN 'WORKED_TOGETHER' THEN 1 END) AS work_connections,
  count(CASE relationship_type WHEN 'STUDIED_TOGETHER' THEN 1 END) AS school_connections, count(CASE relationship_type WHEN 'SAME_LOCATION' THEN 1 END) AS location_connections,
  round(avg(relationship_strength), 4) AS avg_connection_strength FROM o_relations GROUP BY 1
"""
SQL["v2_connection_summary"] = SQL["v2_summary_small_hubs"] = _SUMMARY
_TOP_CONNECTED = """
SELECT u.user_id, u.email, u.first_name, u.last_name, count(DISTINCT r.related_user_id) AS connection_count,
  round(avg(r.relationship_strength), 4) AS avg_connection_strength
FROM o_users u LEFT JOIN o_relations r ON r.user_id = u.user_id GROUP BY 1, 2, 3, 4 ORDER BY connection_count DESC, u.user_id LIMIT 100
"""
SQL["v3_top_connected"] = SQL["v3_top_connected_small_hubs"] = _TOP_CONNECTED
SQL["v4_talent_pools"] = """
WITH c AS (SELECT company_id, company_name, count(DISTINCT user_id) AS total_employees, count(DISTINCT role_id) AS role_diversity FROM o_company GROUP BY 1, 2)
SELECT c.*, r.role_title AS role_available FROM c
LEFT JOIN (SELECT DISTINCT company_id, role_title FROM o_company WHERE role_title IS NOT NULL) r ON r.company_id = c.company_id
"""

# Messaging

SQL["h1_inbox"] = "SELECT * FROM o_inbox"
SQL["h2_thread"] = f"""
SELECT m.id, m.conversation_id, m.sender_id, m.body, m.message_type, m.status, m.created_at, m.updated_at, s.first_name || ' ' || s.last_name AS sender_name,
  EXISTS (SELECT 1 FROM fx_message_reads r WHERE r.message_id = m.id AND r.person_id = '{READERS[0]}') AS is_read,
  coalesce((SELECT string_agg(k || ':' || n, ',' ORDER BY k) FROM (SELECT x.reaction_type AS k, count(*) AS n FROM fx_reactions x WHERE x.message_id = m.id GROUP BY 1)), '') AS reactions,
  (SELECT count(*) FROM fx_reactions x WHERE x.message_id = m.id) AS reaction_count,
  (SELECT arg_min(a.storage_key, a.id) FROM fx_attachments a WHERE a.message_id = m.id) AS storage_key,
  (SELECT arg_min(a.mime_type, a.id) FROM fx_attachments a WHERE a.message_id = m.id) AS mime_type,
  (SELECT arg_min(a.file_size_bytes, a.id) FROM fx_attachments a WHERE a.message_id = m.id) AS file_size_bytes,
  (SELECT json_extract_string(arg_min(coalesce(a.metadata, '{{}}'), a.id), '$.file_name') FROM fx_attachments a WHERE a.message_id = m.id) AS file_name
FROM fx_messages m JOIN fx_chat_people s ON s.id = m.sender_id
"""
SQL["h2_reactions"] = "SELECT message_id, person_id, reaction_type FROM fx_reactions"
SQL["h3_read_matrix"] = f"""
SELECT m.id, m.conversation_id, s.first_name || ' ' || s.last_name AS sender, m.body, m.created_at,
  {", ".join(f"(m.id, '{r}') IN (SELECT (message_id, person_id) FROM fx_message_reads) AS read_{n}" for n, r in enumerate(READERS, 1))}
FROM fx_messages m JOIN fx_chat_people s ON s.id = m.sender_id
"""
SQL["h4_unread_total"] = """
SELECT person_id, CAST(sum(unread_count) AS BIGINT) AS unread_count FROM o_inbox_unread WHERE folder IN ('MAIN', 'REQUEST') GROUP BY 1
"""
SQL["h5_unread_by_conversation"] = """
SELECT u.person_id, u.conversation_id, u.participants, CASE WHEN u.participants = 2 THEN o.first_name || ' ' || o.last_name END AS other_person, u.unread_count
FROM o_inbox_unread u SEMI JOIN fx_conversations c ON c.id = u.conversation_id LEFT JOIN fx_chat_people o ON o.id = u.other_person_id
"""
SQL["h6_folder_badges"] = "SELECT person_id, folder, CAST(sum(unread_count) AS BIGINT) AS unread_count FROM o_inbox GROUP BY 1, 2"
SQL["h7_folder_distribution"] = "SELECT person_id, folder, count(*) AS conversation_count FROM fx_members GROUP BY 1, 2"
SQL["h8_notification_settings"] = """
SELECT m.conversation_id, m.person_id, p.first_name || ' ' || p.last_name AS person_name, m.folder, m.notification_level, m.last_read_at
FROM fx_members m, fx_chat_people p WHERE p.id = m.person_id
"""
SQL["h9_user_search"] = f"""
SELECT query, searcher_id, id, first_name, last_name, full_name, email FROM (
  SELECT q.query, q.searcher_id, p.id, p.first_name, p.last_name, p.first_name || ' ' || p.last_name AS full_name, p.email,
    row_number() OVER (PARTITION BY q.query, q.searcher_id ORDER BY p.id) AS rn
  FROM (VALUES {", ".join(f"('{q}', '{s}')" for q, s in SEARCHES)}) q(query, searcher_id)
  JOIN fx_chat_people p ON p.id <> q.searcher_id AND (instr(lower(p.first_name || ' ' || p.last_name), lower(q.query)) > 0 OR instr(lower(p.email), lower(q.query)) > 0)
  WHERE length(q.query) >= 2) x WHERE rn <= 20
"""
SQL["h9_user_search_table"] = """
WITH asked AS (SELECT 'l' || id AS query, CAST(id AS VARCHAR) AS searcher_id FROM fx_persons WHERE id % 20 = 0),
met AS (SELECT a.*, p.id, p.first_name, p.last_name, p.first_name || ' ' || p.last_name AS full_name, p.email FROM asked a JOIN fx_persons p
  ON CAST(p.id AS VARCHAR) <> a.searcher_id AND (contains(lower(p.first_name || ' ' || p.last_name), a.query) OR contains(lower(p.email), a.query)))
SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY query, searcher_id ORDER BY id) <= 20
"""
SQL["h9_user_search_parts"] = SQL["h9_user_search_table"].replace("'l' || id AS query", "right(CAST(id AS VARCHAR), 2) AS query").replace("id % 20 = 0", "id % 20 = 0 AND id > 9")
SQL["h10_direct_conversations"] = """
SELECT a.person_id AS person_1, b.person_id AS person_2, min(a.conversation_id) AS conversation_id, count(*) AS conversations
FROM fx_members a JOIN fx_members b ON a.conversation_id = b.conversation_id AND a.person_id < b.person_id
JOIN fx_conversations c ON c.id = a.conversation_id AND c.conversation_type = 'DIRECT' GROUP BY 1, 2
"""
SQL["h11_reaction_state"] = """
SELECT message_id, person_id, reaction_type FROM (SELECT *, row_number() OVER (PARTITION BY message_id, person_id ORDER BY seq DESC) AS rn FROM fx_reaction_log)
WHERE rn = 1 AND action <> 'DELETE'
"""
SQL["h12_read_state"] = """
SELECT message_id, person_id, read_at FROM fx_read_log a
WHERE NOT EXISTS (SELECT 1 FROM fx_read_log b WHERE b.message_id = a.message_id AND b.person_id = a.person_id AND b.read_at < a.read_at)
"""
SQL["h12_last_read"] = "SELECT conversation_id, person_id, max(read_at) AS last_read_at FROM fx_read_log GROUP BY 1, 2"
SQL["h13_folder_state"] = """
SELECT conversation_id, person_id,
  arg_max(CASE WHEN action = 'START' AND detail = 'STARTER' THEN 'MAIN' WHEN action = 'START' THEN 'REQUEST' ELSE detail END, seq) AS folder,
  coalesce(CASE arg_max(detail, seq) FILTER (WHERE action = 'MOVE' AND detail <> 'REQUEST') WHEN 'RESTRICTED' THEN 'MUTED' ELSE 'ALL' END, 'ALL') AS notification_level
FROM fx_folder_log GROUP BY 1, 2
"""
SQL["h14_membership_state"] = """
SELECT conversation_id, person_id FROM fx_membership_log GROUP BY 1, 2 HAVING arg_max(action, seq) = 'JOIN'
"""
SQL["h14_membership_messages"] = """
SELECT l.conversation_id, l.person_id, l.seq, 'SYSTEM' AS message_type,
  p.first_name || ' ' || p.last_name || CASE l.action WHEN 'JOIN' THEN ' joined the group' ELSE ' left the group' END AS body
FROM fx_membership_log l JOIN fx_chat_people p ON p.id = l.person_id
"""
SQL["h15_message_type"] = """
SELECT m.id, CASE WHEN a.mime_type IS NULL THEN 'TEXT' WHEN split_part(a.mime_type, '/', 1) IN ('image', 'video', 'audio')
  THEN upper(split_part(a.mime_type, '/', 1)) ELSE 'FILE' END AS message_type
FROM fx_messages m LEFT JOIN fx_attachments a ON a.message_id = m.id
"""

# Graph profile

SQL["q1_label_counts"] = "SELECT node_type, count(*) AS node_count FROM fx_nodes GROUP BY 1"
SQL["q2_relationship_counts"] = "SELECT relationship_type, count(*) AS edge_count FROM fx_edges GROUP BY 1"
SQL["q3_patterns"] = """
SELECT source_node_type AS from_node, relationship_type AS relationship, target_node_type AS to_node, count(*) AS edge_count FROM fx_edges GROUP BY 1, 2, 3
"""
_KEY_NAMES = {
    "Person": ("person_id", "email"), "Company": ("company_id", "company_name"), "Role": ("role_id", "title"), "School": ("school_id", "school_name"),
    "Degree": ("degree_id", "degree_name"), "Location": ("location_id", "country"), "Project": ("project_id", "project_name"),
    "Language": ("language_id", "language_name"), "Experience": ("experience_id", "start_date"), "Education": ("education_id", "end_date"),
}
SQL["q4_property_profile"] = " UNION ALL ".join(
    f"SELECT '{label}' AS label, '{prop}' AS property, 'string' AS property_type, count({col}) AS present, count({col}) = count(*) AS mandatory "
    f"FROM fx_nodes WHERE node_type = '{label}' HAVING count({col}) > 0"
    for label, props in _KEY_NAMES.items() for prop, col in zip(props, ("node_id", "name"))
)
SQL["q4_relationship_properties"] = """
SELECT label, property, 'string' AS property_type, count(v) AS present, count(v) = count(*) AS mandatory FROM (
""" + " UNION ALL ".join(
    f"SELECT type AS label, '{c}' AS property, {c} AS v FROM fx_rels"
    for c in ("a_person_id", "a_experience_id", "a_education_id", "b_company_id", "b_role_id", "b_school_id", "b_location_id")
) + ") GROUP BY 1, 2 HAVING count(v) > 0"
SQL["q5_orphans"] = """
SELECT node_type, count(*) AS orphan_count FROM fx_nodes n WHERE NOT EXISTS (SELECT 1 FROM fx_edges e WHERE e.source_node_id = n.node_id)
  AND NOT EXISTS (SELECT 1 FROM fx_edges e WHERE e.target_node_id = n.node_id) GROUP BY 1
"""
SQL["q6_hubs"] = """
SELECT node_type, node_id, coalesce(name, 'N/A') AS name, connection_count FROM (SELECT n.*,
  (SELECT count(*) FROM fx_edges e WHERE e.source_node_id = n.node_id) + (SELECT count(*) FROM fx_edges e WHERE e.target_node_id = n.node_id) AS connection_count
  FROM fx_nodes n) WHERE connection_count > 0 ORDER BY connection_count DESC, node_id LIMIT 20
"""
SQL["q7_samples"] = """
SELECT node_type, node_id, name FROM (SELECT *, row_number() OVER (PARTITION BY node_type ORDER BY node_id) AS rn,
  dense_rank() OVER (ORDER BY node_type) AS dr FROM fx_nodes) WHERE rn < 4 AND dr < 6
"""
SQL["q8_missing_and_ranges"] = """
SELECT node_type, count(*) AS total_records, count(*) FILTER (WHERE coalesce(name, '') = '') AS missing, min(d) AS oldest_record, max(d) AS newest_record
FROM (SELECT *, CASE WHEN regexp_full_match(name, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN strptime(name, '%Y-%m-%d') END AS d FROM fx_nodes) GROUP BY 1
"""
SQL["q9_both_patterns"] = """
SELECT x.node_id, x.n AS count_a, y.n AS count_b
FROM (SELECT source_node_id AS node_id, count(DISTINCT target_node_id) AS n FROM fx_edges WHERE relationship_type = 'EXPERIENCED_IN' GROUP BY 1) x
JOIN (SELECT source_node_id AS node_id, count(DISTINCT target_node_id) AS n FROM fx_edges WHERE relationship_type = 'EDUCATED_IN' GROUP BY 1) y USING (node_id)
ORDER BY x.n + y.n DESC, node_id LIMIT 10
"""
SQL["q10_neighbourhood"] = """
SELECT CASE WHEN source_node_id = 'L1' THEN 'OUT' ELSE 'IN' END AS direction, relationship_type,
  CASE WHEN source_node_id = 'L1' THEN target_node_id ELSE source_node_id END AS node_id,
  CASE WHEN source_node_id = 'L1' THEN target_node_type ELSE source_node_type END AS node_type
FROM fx_edges WHERE 'L1' IN (source_node_id, target_node_id)
"""
SQL["q11_shortest_path"] = f"""
WITH RECURSIVE links AS (SELECT source_node_id AS a, target_node_id AS b FROM fx_edges UNION SELECT target_node_id, source_node_id FROM fx_edges),
walk(node, hop) USING KEY (node) AS (
  SELECT '{PATH_ENDS[0]}', 0::BIGINT UNION SELECT l.b, min(w.hop) + 1 FROM walk w JOIN links l ON l.a = w.node WHERE l.b NOT IN (SELECT node FROM recurring.walk) GROUP BY l.b)
SELECT '{PATH_ENDS[0]}' AS source_node_id, '{PATH_ENDS[1]}' AS target_node_id, min(hop) AS path_length FROM walk WHERE node = '{PATH_ENDS[1]}'
"""

# Streaming

SQL["x1_stream_daily_activity"] = "SELECT CAST(ts AS DATE) AS metric_date, event_type, count(*) AS events FROM events GROUP BY 1, 2"
SQL["x1_stream_daily_users"] = """
SELECT CAST(ts AS DATE) AS metric_date, count(DISTINCT user_id) AS dau FROM events GROUP BY 1
"""
SQL["x2_stream_upsert"] = """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1
"""


def oracle_sql() -> dict[str, str]:
    """Complete statements over the raw tables; the driver registers those as views."""
    return {name: with_clause(sql, {**VIEWS, **PARTS}) for name, sql in SQL.items()}
