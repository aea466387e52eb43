"""Deterministic input views over the star-schema test tables.

Each entry is SQL that Spark and DuckDB both accept; a later view may use earlier ones.
The views only shape raw rows into profile, social, graph and messaging inputs; no operator logic lives here.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["fx_persons"] = """
SELECT c_custkey AS id, CASE WHEN c_custkey % 23 <> 0 THEN md5(CAST(c_custkey AS STRING)) END AS person_id,
  CAST(DATE '1995-01-01' + CAST((c_custkey * 253) % 2404 AS INT) AS TIMESTAMP) AS created_at,
  COALESCE(CASE WHEN c_custkey % 3 <> 0 THEN o.last_order END, CAST(DATE '1995-01-01' + CAST((c_custkey * 253) % 2404 AS INT) AS TIMESTAMP)) AS updated_at,
  CASE WHEN c_custkey % 97 = 5 THEN TIMESTAMP '2001-08-01 00:00:00' END AS deleted_at,
  lower(c_name) || '@example.com' AS email,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'F' || CAST(c_custkey AS STRING) END AS first_name,
  CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 'L' || CAST(c_custkey AS STRING) END AS last_name,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' specialist' ELSE '' END END AS headline_description,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'https://example.com/in/' || CAST(c_custkey AS STRING) END AS linked_in_url,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_nationkey END AS location_id,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_mktsegment IN ('BUILDING','MACHINERY') END AS has_finder
FROM customer LEFT JOIN (
  SELECT o_custkey, MAX(o_orderdate) AS last_order FROM orders
  WHERE o_orderdate >= CAST(DATE '1995-01-01' + CAST((o_custkey * 253) % 2404 AS INT) AS TIMESTAMP)
  GROUP BY o_custkey) o ON c_custkey = o.o_custkey
"""

VIEWS["fx_engagement_persons"] = """
SELECT 'e' || CAST(c_custkey AS STRING) AS id, CAST(c_custkey AS STRING) AS external_id,
  lower(c_name) || '@social.example.com' AS email
FROM customer WHERE c_custkey % 5 <> 0
"""

VIEWS["fx_actions"] = """
SELECT o_orderkey AS id, o_custkey AS person_id, o_orderdate AS created_at,
  CASE WHEN o_orderkey % 41 = 0 THEN o_orderdate END AS deleted_at,
  CASE WHEN o_orderstatus = 'F' THEN 'post' WHEN o_orderstatus = 'P' THEN 'comment'
       WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'vote'
       WHEN o_orderpriority IN ('3-MEDIUM','5-LOW') THEN 'collection' ELSE 'view' END AS kind,
  CASE WHEN o_orderkey % 4 = 1 THEN 'https://example.com/' || CAST(o_orderkey AS STRING) END AS link_url,
  CASE WHEN o_orderkey % 5 = 1 THEN 'k' || CAST(o_orderkey AS STRING) END AS media_keys,
  CASE WHEN o_orderkey % 3 = 0 THEN 'PRIVATE' ELSE 'PUBLIC' END AS privacy
FROM orders
WHERE o_orderdate >= CAST(DATE '1995-01-01' + CAST((o_custkey * 253) % 2404 AS INT) AS TIMESTAMP)
"""

VIEWS["fx_mentions"] = """
SELECT 'e' || CAST(l_partkey AS STRING) AS mentioned_person_id, l_shipdate AS created_at,
  CASE WHEN l_orderkey % 29 = 0 THEN l_shipdate END AS deleted_at
FROM lineitem WHERE l_returnflag = 'R'
"""

VIEWS["fx_group_members"] = """
SELECT l_suppkey AS group_id, 'e' || CAST(l_partkey AS STRING) AS person_id,
  CASE WHEN l_orderkey % 31 = 0 THEN l_shipdate END AS deleted_at
FROM lineitem WHERE l_returnflag <> 'R'
"""

VIEWS["fx_experiences"] = """
SELECT id, person_id, CAST(supp AS STRING) || '-' || brand || '-' || CAST(size % 5 AS STRING) AS company_id, role_id, brand || '/' || CAST(size AS STRING) AS project_id,
  CASE WHEN id % 3 = 0 THEN CAST(CAST(d AS DATE) AS STRING)
       WHEN id % 3 = 1 THEN CAST(month(d) AS STRING) || '-' || CAST(year(d) AS STRING)
       ELSE 'n/a' END AS start_date
FROM (SELECT l_orderkey AS id, MIN(o_custkey) AS person_id, MIN_BY(l_suppkey, line) AS supp, MIN_BY(p_brand, line) AS brand,
        MIN_BY(p_type, line) AS role_id, MIN_BY(p_size, line) AS size, MIN(o_orderdate) AS d
      FROM (SELECT *, CAST(l_linenumber AS BIGINT) * 1000000000000 + CAST(l_partkey AS BIGINT) * 100000 + l_suppkey AS line FROM lineitem) li
      JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      GROUP BY l_orderkey) x
"""

VIEWS["fx_education"] = """
SELECT o_orderkey AS id, o_custkey AS person_id,
  CASE WHEN o_orderkey % 100 = 0 THEN 'S0' ELSE 'S' || CAST(CAST(floor(o_orderkey / 16) AS BIGINT) + 1 AS STRING) END AS school_id,
  o_orderpriority AS degree_id,
  CASE WHEN o_orderkey % 12 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
       ELSE CAST(month(o_orderdate) AS STRING) || '-' || CAST(year(o_orderdate) AS STRING) END AS end_date
FROM orders
"""

VIEWS["fx_edges"] = """
SELECT 'P' || CAST(person_id AS STRING) AS source_node_id, 'Person' AS source_node_type, 'WORKED_AT' AS relationship_type, 'C' || company_id AS target_node_id, 'Company' AS target_node_type FROM fx_experiences
UNION ALL SELECT 'P' || CAST(person_id AS STRING), 'Person', 'WORKED_AS', 'R' || role_id, 'Role' FROM fx_experiences
UNION ALL SELECT 'P' || CAST(person_id AS STRING), 'Person', 'EXPERIENCED_IN', 'X' || CAST(id AS STRING), 'Experience' FROM fx_experiences
UNION ALL SELECT 'X' || CAST(id AS STRING), 'Experience', 'WORKED_ON', 'J' || project_id, 'Project' FROM fx_experiences
UNION ALL SELECT 'X' || CAST(id AS STRING), 'Experience', 'WORKED_AT', 'C' || company_id, 'Company' FROM fx_experiences
UNION ALL SELECT 'X' || CAST(id AS STRING), 'Experience', 'WORKED_AS', 'R' || role_id, 'Role' FROM fx_experiences
UNION ALL SELECT 'P' || CAST(person_id AS STRING), 'Person', 'STUDIED_AT', school_id, 'School' FROM fx_education
UNION ALL SELECT 'P' || CAST(person_id AS STRING), 'Person', 'EDUCATED_IN', 'E' || CAST(id AS STRING), 'Education' FROM fx_education
UNION ALL SELECT 'E' || CAST(id AS STRING), 'Education', 'STUDIED_AT', school_id, 'School' FROM fx_education
UNION ALL SELECT 'E' || CAST(id AS STRING), 'Education', 'EARNED', 'D' || degree_id, 'Degree' FROM fx_education
UNION ALL SELECT 'P' || CAST(id AS STRING), 'Person', 'LIVES_AT', 'L' || CAST(location_id AS STRING), 'Location' FROM fx_persons WHERE location_id IS NOT NULL
"""

VIEWS["fx_nodes"] = """
SELECT 'P' || CAST(id AS STRING) AS node_id, 'Person' AS node_type, email AS name FROM fx_persons
UNION ALL SELECT DISTINCT 'C' || company_id, 'Company', 'Company ' || company_id FROM fx_experiences
UNION ALL SELECT DISTINCT 'R' || role_id, 'Role', role_id FROM fx_experiences
UNION ALL SELECT DISTINCT 'J' || project_id, 'Project', project_id FROM fx_experiences
UNION ALL SELECT 'X' || CAST(id AS STRING), 'Experience', start_date FROM fx_experiences
UNION ALL SELECT DISTINCT school_id, 'School', 'School ' || school_id FROM fx_education
UNION ALL SELECT DISTINCT 'D' || degree_id, 'Degree', degree_id FROM fx_education
UNION ALL SELECT 'E' || CAST(id AS STRING), 'Education', end_date FROM fx_education
UNION ALL SELECT 'L' || CAST(n_nationkey AS STRING), 'Location', n_name FROM nation
UNION ALL SELECT DISTINCT 'G' || lang, 'Language', lang FROM documents
"""

VIEWS["fx_groups"] = """
SELECT CAST(s_suppkey AS STRING) AS id, s_name AS name, 'e' || CAST((s_suppkey * 37) % 997 + 1 AS STRING) AS created_by,
  CASE WHEN s_suppkey % 19 = 0 THEN TIMESTAMP '2001-01-01 00:00:00' END AS deleted_at
FROM supplier
"""

VIEWS["fx_messages"] = """
SELECT conv_id * 100 + turn AS id, conv_id AS conversation_id, role || '-' || CAST(conv_id % 40 AS STRING) AS sender_id,
  text AS body, turn, CASE WHEN turn % 4 = 3 THEN 'FILE' ELSE 'TEXT' END AS message_type,
  CASE turn % 5 WHEN 0 THEN 'EDITED' WHEN 1 THEN 'SENT' ELSE 'DELIVERED' END AS status,
  CASE WHEN turn % 5 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' + (conv_id * 60 + turn) * INTERVAL '1' MINUTE END AS updated_at,
  TIMESTAMP '2024-01-01 00:00:00' + (conv_id * 60 + turn) * INTERVAL '1' MINUTE AS created_at
FROM conversations
"""

VIEWS["fx_participants"] = """
SELECT conversation_id, sender_id AS person_id, MAX(turn) AS last_turn,
  CASE conversation_id % 4 WHEN 1 THEN 'REQUEST' WHEN 2 THEN 'RESTRICTED' ELSE 'MAIN' END AS folder,
  CASE WHEN conversation_id % 17 = 3 THEN MAX(created_at) END AS left_at
FROM fx_messages GROUP BY conversation_id, sender_id
"""

VIEWS["fx_message_reads"] = """
SELECT m.id AS message_id, p.person_id FROM fx_messages m
JOIN fx_participants p ON m.conversation_id = p.conversation_id WHERE m.turn <= p.last_turn
"""

VIEWS["fx_reactions"] = """
SELECT m.id AS message_id, p.person_id, CASE WHEN m.id % 2 = 0 THEN 'like' ELSE 'laugh' END AS reaction_type
FROM fx_messages m JOIN fx_participants p ON m.conversation_id = p.conversation_id AND m.sender_id <> p.person_id
WHERE m.turn % 3 = 0
"""

VIEWS["fx_attachments"] = """
SELECT id * 10 AS id, id AS message_id, 'k' || CAST(id AS STRING) AS storage_key,
  CASE id % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'video/mp4' WHEN 2 THEN 'audio/ogg' ELSE 'application/pdf' END AS mime_type, id * 37 % 100000 AS file_size_bytes,
  CASE id % 3 WHEN 0 THEN '{"file_name": "file ' || CAST(id AS STRING) || '.bin", "pages": 3}' WHEN 1 THEN '{"width": 640}' END AS metadata
FROM fx_messages WHERE message_type = 'FILE'
"""

VIEWS["fx_glossary"] = """
SELECT doc_id AS id, CASE WHEN doc_id % 5 = 0 THEN '  ' ELSE ' ' || source || ' entry ' || CAST(doc_id AS STRING) || ' ' END AS term,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS meaning, source AS category,
  CASE WHEN doc_id % 10 = 0 THEN '   ' WHEN doc_id % 10 = 1 THEN NULL ELSE text END AS description
FROM documents
"""

# Source tables split out of the shared action log, with the extra columns the event operators read.

VIEWS["fx_posts"] = """
SELECT substring(md5(CAST(id AS STRING)), 1, 8) || '-' || substring(md5(CAST(id AS STRING)), 9, 24) AS id,
  'e' || CAST(person_id AS STRING) AS person_id, CASE id % 3 WHEN 0 THEN 'ARTICLE' ELSE 'UPDATE' END AS type,
  CASE WHEN id % 9 = 0 THEN NULL ELSE 'PUBLISHED' END AS status, link_url, media_keys, created_at, deleted_at
FROM fx_actions WHERE kind = 'post'
"""

VIEWS["fx_comments"] = """
SELECT substring(md5(CAST(id AS STRING)), 1, 8) || '-' || substring(md5(CAST(id AS STRING)), 9, 24) AS id,
  'e' || CAST(person_id AS STRING) AS person_id, CAST(id - id % 7 AS STRING) AS post_id,
  CASE WHEN id % 4 = 0 THEN CAST(id - 1 AS STRING) END AS parent_comment_id, created_at, deleted_at
FROM fx_actions WHERE kind = 'comment'
"""

VIEWS["fx_votes"] = """
SELECT id, person_id AS voter_id, CASE WHEN id % 2 = 0 THEN 'UP' ELSE 'DOWN' END AS type,
  id % 5 AS score, CASE WHEN id % 6 = 0 THEN NULL ELSE person_id % 100 END AS profile_id, created_at, deleted_at
FROM fx_actions WHERE kind = 'vote'
"""

VIEWS["fx_collections"] = """
SELECT id, person_id, 'List ' || CAST(id AS STRING) AS name, privacy, created_at, deleted_at
FROM fx_actions WHERE kind = 'collection'
"""

VIEWS["fx_views"] = """
SELECT id, person_id, CASE WHEN id % 2 = 0 THEN 'FULL' ELSE 'CARD' END AS type,
  CASE WHEN id % 3 = 0 THEN NULL ELSE created_at + INTERVAL '30' DAY END AS expiry, created_at, deleted_at
FROM fx_actions WHERE kind = 'view'
"""

VIEWS["fx_work"] = """
SELECT id, person_id, company_id, role_id, project_id, start_date,
  CASE WHEN id % 50 = 0 THEN TIMESTAMP '2001-08-01 08:00:00' ELSE TIMESTAMP '2001-03-01 08:00:00' END AS created_at,
  CASE WHEN id % 37 = 0 THEN TIMESTAMP '2001-07-01 00:00:00' END AS deleted_at
FROM fx_experiences
"""

VIEWS["fx_study"] = """
SELECT id, person_id, school_id, degree_id, end_date,
  CASE WHEN id % 48 = 0 THEN TIMESTAMP '2001-08-01 09:00:00' ELSE TIMESTAMP '2001-03-01 08:00:00' END AS created_at,
  CASE WHEN id % 42 = 0 THEN TIMESTAMP '2001-07-01 00:00:00' END AS deleted_at
FROM fx_education
"""

VIEWS["fx_conversations"] = """
SELECT conversation_id AS id, CASE WHEN COUNT(DISTINCT sender_id) = 2 THEN 'DIRECT' ELSE 'GROUP' END AS conversation_type,
  MAX(created_at) AS updated_at
FROM fx_messages GROUP BY conversation_id
"""

VIEWS["fx_members"] = """
SELECT p.conversation_id, p.person_id, p.folder, p.left_at,
  CASE WHEN p.folder = 'RESTRICTED' THEN 'MUTED' ELSE 'ALL' END AS notification_level,
  TIMESTAMP '2024-01-01 00:00:00' + (p.conversation_id * 60 + p.last_turn) * INTERVAL '1' MINUTE AS last_read_at
FROM fx_participants p
"""

VIEWS["fx_chat_people"] = """
SELECT DISTINCT sender_id AS id, CASE WHEN sender_id LIKE 'user%' THEN 'User' WHEN sender_id LIKE 'assistant%' THEN 'Assistant' ELSE 'System' END AS first_name,
  'No' || substring(md5(sender_id), 1, 4) AS last_name, sender_id || '@chat.example.com' AS email
FROM fx_messages
"""

VIEWS["fx_rels"] = """
SELECT CASE WHEN source_node_type = 'Person' THEN source_node_id END AS a_person_id,
  CASE WHEN source_node_type = 'Experience' THEN source_node_id END AS a_experience_id,
  CASE WHEN source_node_type = 'Education' AND substring(source_node_id, 2, 9) NOT LIKE '%0' THEN source_node_id END AS a_education_id,
  source_node_type AS a_label, 'i' || source_node_id AS a_internal,
  relationship_type AS type,
  CASE WHEN target_node_type = 'Company' THEN target_node_id END AS b_company_id,
  CASE WHEN target_node_type = 'Role' THEN target_node_id END AS b_role_id,
  CASE WHEN target_node_type = 'School' THEN target_node_id END AS b_school_id,
  CASE WHEN target_node_type = 'Location' THEN target_node_id END AS b_location_id,
  target_node_type AS b_label, 'i' || target_node_id AS b_internal
FROM fx_edges
"""

# Change logs for the log-to-state operators. seq breaks ties between equal timestamps.

VIEWS["fx_reaction_log"] = """
SELECT message_id, person_id, reaction_type, 'SET' AS action, message_id AS seq FROM fx_reactions
UNION ALL SELECT message_id, person_id, 'love', 'SET', message_id + 1 FROM fx_reactions WHERE message_id % 5 = 0
UNION ALL SELECT message_id, person_id, NULL, 'DELETE', message_id + 2 FROM fx_reactions WHERE message_id % 7 = 0
"""

VIEWS["fx_read_log"] = """
SELECT r.message_id, m.conversation_id, r.person_id, m.created_at + INTERVAL '5' MINUTE AS read_at
FROM fx_message_reads r JOIN fx_messages m ON r.message_id = m.id
UNION ALL SELECT r.message_id, m.conversation_id, r.person_id, m.created_at + INTERVAL '9' MINUTE
FROM fx_message_reads r JOIN fx_messages m ON r.message_id = m.id WHERE r.message_id % 4 = 0
"""

VIEWS["fx_folder_log"] = """
SELECT conversation_id, person_id, 'START' AS action, CASE WHEN person_id LIKE 'user%' THEN 'STARTER' ELSE 'RECIPIENT' END AS detail, 0 AS seq FROM fx_participants
UNION ALL SELECT conversation_id, person_id, 'MOVE', folder, 1 FROM fx_participants WHERE conversation_id % 3 = 0
UNION ALL SELECT conversation_id, person_id, 'MOVE', 'REQUEST', 2 FROM fx_participants WHERE conversation_id % 6 = 0
"""

VIEWS["fx_membership_log"] = """
SELECT conversation_id, person_id, 'JOIN' AS action, conversation_id * 10 AS seq FROM fx_participants
UNION ALL SELECT conversation_id, person_id, 'LEAVE', conversation_id * 10 + 1 FROM fx_participants WHERE conversation_id % 4 = 1
UNION ALL SELECT conversation_id, person_id, 'JOIN', conversation_id * 10 + 2 FROM fx_participants WHERE conversation_id % 8 = 1
"""

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def needed_views(names: list[str], views: dict[str, str] = VIEWS) -> list[str]:
    """The given views and every view they use, in definition order."""
    wanted, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name in wanted:
            continue
        wanted.add(name)
        todo += [other for other in views if other != name and re.search(rf"\b{other}\b", views[name])]
    return [name for name in views if name in wanted]


def with_clause(sql: str, views: dict[str, str] = VIEWS) -> str:
    """Prefix ``sql`` with common table expressions for the views it mentions."""
    used = needed_views([name for name in views if re.search(rf"\b{name}\b", sql)], views)
    body = sql.strip()
    keyword = "WITH RECURSIVE" if body.upper().startswith("WITH RECURSIVE") else "WITH"
    own = body[len(keyword):].strip() if body.upper().startswith("WITH") else None
    head = ",\n".join(f"{name} AS ({views[name].strip()})" for name in used)
    if not head:
        return body
    return f"{keyword} {head},\n{own}" if own else f"{keyword} {head}\n{body}"


def placeholders(sql: str) -> tuple[str, list[str]]:
    """``sql`` with its tables as ``{name}`` placeholders for ``spark.sql``, and their names."""
    pattern = re.compile(r"\b(FROM|JOIN)\s+([A-Za-z_]\w*)")
    plain = sql.replace("{", "{{").replace("}", "}}")
    return pattern.sub(r"\1 {\2}", plain), sorted({m.group(2) for m in pattern.finditer(sql)})
