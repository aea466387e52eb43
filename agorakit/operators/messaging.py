"""Messaging: inboxes, threads, unread counts, search and state rebuilt from change logs.

Unread counts never pair messages with participants. A participant's unread messages in a conversation are
all its messages, less the ones they sent, less the ones by others they have a receipt for: three grouped counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorakit.functions.exprs import contains_ignoring_case
from agorakit.session import cut

# Folders, notification levels and message types.
RESTRICTED, REQUEST, MAIN = "RESTRICTED", "REQUEST", "MAIN"
MUTED, ALL = "MUTED", "ALL"
MEDIA_PREFIXES = {"image/": "IMAGE", "video/": "VIDEO", "audio/": "AUDIO"}
MAX_QUERIES, MIN_QUERY_CHARS, SEARCH_HITS = 1_000, 2, 20
#: Characters of the longest part that is listed; persons in a block of a long posting list.
PART_CHARS, POSTING_BLOCK = 3, 4_096



def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """First and last name; NULL if either is missing."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def _unread(participants: DataFrame, messages: DataFrame, reads: DataFrame) -> DataFrame:
    """Participants with ``unread_count``: others' messages in the conversation without an own receipt."""
    total = messages.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("_total"))
    sent = messages.groupBy("conversation_id", F.col("sender_id").alias("person_id")).agg(F.count(F.lit(1)).alias("_sent"))
    receipts = (
        reads.select("message_id", "person_id").distinct()
        .join(messages.select(F.col("id").alias("message_id"), "conversation_id", "sender_id"), "message_id")
        .where(F.col("person_id") != F.col("sender_id"))
        .groupBy("conversation_id", "person_id")
        .agg(F.count(F.lit(1)).alias("_read"))
    )
    unread = F.coalesce("_total", F.lit(0)) - F.coalesce("_sent", F.lit(0)) - F.coalesce("_read", F.lit(0))
    return (
        participants.join(total, "conversation_id", "left")
        .join(sent, ["conversation_id", "person_id"], "left")
        .join(receipts, ["conversation_id", "person_id"], "left")
        .withColumn("unread_count", unread.cast("bigint"))
        .drop("_total", "_sent", "_read")
    )


def _other_participant(participants: DataFrame) -> DataFrame:
    """The least person id of each conversation other than the row's own: from the two least ids, not a self join."""
    least = participants.groupBy("conversation_id").agg(F.min("person_id").alias("_least"))
    marked = participants.select("conversation_id", "person_id").join(least, "conversation_id")
    second = (
        marked.where(F.col("person_id") != F.col("_least"))
        .groupBy("conversation_id")
        .agg(F.min("person_id").alias("_second"))
    )
    other = F.when(F.col("person_id") == F.col("_least"), F.col("_second")).otherwise(F.col("_least"))
    return marked.join(second, "conversation_id", "left").select(
        "conversation_id", "person_id", other.alias("other_person_id")
    )


def inbox(
    conversations: DataFrame, participants: DataFrame, messages: DataFrame, reads: DataFrame, persons: DataFrame
) -> DataFrame:
    """Every user's inbox: conversation, folder, other participant, last message and unread count."""
    last = messages.groupBy("conversation_id").agg(
        F.max_by(F.struct("id", "body", "sender_id", "created_at", "message_type"), F.struct("created_at", "id")).alias("_last")
    )
    present = _unread(participants.where(F.col("left_at").isNull()), messages, reads)
    people = persons.select(
        F.col("id").alias("other_person_id"), full_name().alias("other_name"), F.col("email").alias("other_email")
    )
    return (
        present.join(conversations.select(F.col("id").alias("conversation_id"), "conversation_type", "updated_at"), "conversation_id")
        .join(_other_participant(participants), ["conversation_id", "person_id"], "left")
        .join(people, "other_person_id", "left")
        .join(last, "conversation_id", "left")
        .select(
            "person_id", "conversation_id", "conversation_type", "updated_at", "folder", "last_read_at",
            "notification_level", "other_person_id", "other_name", "other_email",
            F.col("_last.id").alias("last_message_id"), F.col("_last.body").alias("last_message_body"),
            F.col("_last.sender_id").alias("last_sender_id"), F.col("_last.created_at").alias("last_message_at"),
            F.col("_last.message_type").alias("last_message_type"), "unread_count",
        )
    )


def thread(
    messages: DataFrame, persons: DataFrame, reads: DataFrame, reactions: DataFrame, attachments: DataFrame, reader: str
) -> DataFrame:
    """Messages with status and times, sender name, the reader's read flag, reaction counts by type and the first attachment.

    The name of an attached file is a member of its JSON metadata; text that is no JSON, and JSON without a name, give none.

    Who reacted is in ``reactions`` itself, row by row; here is one count for each of the few types.
    """
    mine = reads.where(F.col("person_id") == reader).select(F.col("message_id").alias("id"), F.lit(True).alias("_read")).distinct()
    by_type = reactions.groupBy(F.col("message_id").alias("id"), F.col("reaction_type").alias("reaction")).agg(F.count(F.lit(1)).alias("n"))
    reacted = by_type.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("reaction", "n"))).alias("reactions"), F.sum("n").alias("reaction_count"))
    file_name = F.try_variant_get(F.try_parse_json("metadata"), "$.file_name", "string").alias("file_name")
    first = attachments.groupBy(F.col("message_id").alias("id")).agg(
        F.min_by(F.struct("storage_key", "mime_type", "file_size_bytes", file_name), "id").alias("_file")
    )
    senders = persons.select(F.col("id").alias("sender_id"), full_name().alias("sender_name"))
    nothing = F.expr("cast(array() as array<struct<reaction:string,n:bigint>>)")
    counts = F.coalesce("reactions", nothing)
    return (
        messages.join(senders, "sender_id")
        .join(mine, "id", "left")
        .join(reacted, "id", "left")
        .join(first, "id", "left")
        .select(
            "id", "conversation_id", "sender_id", "body", "message_type", "status", "created_at", "updated_at", "sender_name",
            F.coalesce("_read", F.lit(False)).alias("is_read"), counts.alias("reactions"),
            F.coalesce("reaction_count", F.lit(0)).cast("bigint").alias("reaction_count"),
            *[F.col(f"_file.{c}").alias(c) for c in ("storage_key", "mime_type", "file_size_bytes", "file_name")],
        )
    )


def read_matrix(messages: DataFrame, reads: DataFrame, persons: DataFrame, readers: Sequence[str]) -> DataFrame:
    """Messages with one read flag per given reader, named ``read_1``, ``read_2`` and so on."""
    wanted = reads.where(F.col("person_id").isin(list(readers)))
    flags = [F.max(F.col("person_id") == r).alias(f"read_{i}") for i, r in enumerate(readers, 1)]
    by_message = wanted.groupBy(F.col("message_id").alias("id")).agg(*flags)
    senders = persons.select(F.col("id").alias("sender_id"), full_name().alias("sender"))
    return (
        messages.join(senders, "sender_id")
        .join(by_message, "id", "left")
        .select(
            "id", "conversation_id", "sender", "body", "created_at",
            *[F.coalesce(f"read_{i}", F.lit(False)).alias(f"read_{i}") for i in range(1, len(readers) + 1)],
        )
    )


def unread_total(participants: DataFrame, messages: DataFrame, reads: DataFrame) -> DataFrame:
    """Unread messages per person outside restricted conversations; conversations left still count."""
    open_ = participants.where(F.col("folder") != RESTRICTED)
    return _unread(open_, messages, reads).groupBy("person_id").agg(F.sum("unread_count").alias("unread_count"))


def unread_by_conversation(
    conversations: DataFrame, participants: DataFrame, messages: DataFrame, reads: DataFrame, persons: DataFrame
) -> DataFrame:
    """Unread messages per person and conversation, with the number of participants.

    The other participant is named in conversations of two; in larger ones nobody is the other one.
    """
    people = persons.select(F.col("id").alias("other_person_id"), full_name().alias("_name"))
    known = conversations.select(F.col("id").alias("conversation_id"))
    members = participants.join(known, "conversation_id", "left_semi")
    sizes = members.select("conversation_id", "person_id").distinct().groupBy("conversation_id").agg(F.count(F.lit(1)).alias("participants"))
    return (
        _unread(members, messages, reads)
        .join(sizes, "conversation_id")
        .join(_other_participant(participants), ["conversation_id", "person_id"])
        .join(people, "other_person_id", "left")
        .select("person_id", "conversation_id", "participants", F.when(F.col("participants") == 2, F.col("_name")).alias("other_person"), "unread_count")
    )


def folder_badges(inboxes: DataFrame) -> DataFrame:
    return inboxes.groupBy("person_id", "folder").agg(F.sum("unread_count").alias("unread_count"))


def folder_distribution(participants: DataFrame) -> DataFrame:
    return participants.groupBy("person_id", "folder").agg(F.count(F.lit(1)).alias("conversation_count"))


def notification_settings(participants: DataFrame, persons: DataFrame) -> DataFrame:
    people = persons.select(F.col("id").alias("person_id"), full_name().alias("person_name"))
    return participants.join(people, "person_id").select(
        "conversation_id", "person_id", "person_name", "folder", "notification_level", "last_read_at"
    )


def search_users(persons: DataFrame, queries: Sequence[tuple[str, str]], n: int = SEARCH_HITS) -> DataFrame:
    """Up to ``n`` persons per (query, searching person) whose name or email contains the query, by least id.

    All queries are answered in one scan: the checked, bounded list travels as a literal, so nothing is joined.
    Queries shorter than two characters find nothing.
    """
    if len(queries) > MAX_QUERIES:
        raise ValueError(f"at most {MAX_QUERIES} queries a call, got {len(queries)}")
    usable = [(text.strip(), searcher) for text, searcher in queries if len(text.strip()) >= MIN_QUERY_CHARS]
    entries = [F.struct(F.lit(q).alias("query"), F.lit(s).alias("searcher_id")) for q, s in usable]
    wanted = F.array(*entries) if entries else F.expr("cast(array() as array<struct<query:string,searcher_id:string>>)")
    name, email = F.coalesce(full_name(), F.lit("")), F.coalesce("email", F.lit(""))
    hits = F.filter(
        wanted,
        lambda q: (contains_ignoring_case(name, q["query"]) | contains_ignoring_case(email, q["query"]))
        & (F.col("id").cast("string") != q["searcher_id"]),
    )
    place = F.row_number().over(Window.partitionBy("query", "searcher_id").orderBy("id"))
    return (
        persons.select("id", "first_name", "last_name", full_name().alias("full_name"), "email", F.explode(hits).alias("_hit"))
        .select("_hit.query", "_hit.searcher_id", "id", "first_name", "last_name", "full_name", "email")
        .withColumn("_place", place)
        .where(F.col("_place") <= n)
        .drop("_place")
    )


def _grams(text: Column, n: int) -> Column:
    """The different parts of n characters of a text. Each match looks n characters ahead and takes one."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), 1))


def _postings(persons: DataFrame, *texts: str) -> DataFrame:
    """A row for each different part of two or three characters of a person's name or email, with these columns of the person."""
    parts = F.array_distinct(F.concat(*[_grams(F.col(text), k) for text in ("_name", "_email") for k in (2, 3)]))
    return persons.select("id", *texts, F.explode(parts).alias("_part"))


def _least_ids(hits: DataFrame, key: str, n: int) -> DataFrame:
    """The n least ids of each key. Each task keeps n rows of a key before rows are shuffled, so a key that everybody has stays small."""
    place = F.row_number().over(Window.partitionBy(key).orderBy("id"))
    return hits.select(key, "id").withColumn("_place", place).where(F.col("_place") <= n).select(key, "id")


def search_user_table(persons: DataFrame, queries: DataFrame, n: int = SEARCH_HITS, block: int = POSTING_BLOCK) -> DataFrame:
    """As ``search_users``, for a table of queries (query, searcher_id) of any size.

    A query of two or three characters is itself a part, so its hits are the part's posting list, of which only the least ids are kept.
    A longer query can only match persons who have all its parts of three characters. It meets those of its rarest part by an equality join
    and is checked against their texts, which holds all its other parts too. The posting list of a hot part is dealt into
    blocks of about ``block`` persons, and its queries go to each block, so no task holds the list of a part that everybody has. Equal queries are
    answered once, with one hit more than asked for, as the person who searches is left out.
    """
    asked = queries.select(F.trim("query").alias("query"), F.col("searcher_id").cast("string").alias("searcher_id")).distinct()
    asked = asked.where(F.char_length("query") >= MIN_QUERY_CHARS)
    # Persons are few bytes and become many parts, so they are dealt out before that: a small file would be read by one task.
    name, email = F.lower(F.coalesce(full_name(), F.lit(""))), F.lower(F.coalesce("email", F.lit("")))
    people = persons.select("id", name.alias("_name"), email.alias("_email")).repartition("id", "_name", "_email")
    needle, listed = F.lower("query"), _postings(people)
    different = asked.select("query").distinct().withColumn("_part", needle)
    short = different.where(F.char_length("_part") <= PART_CHARS)
    # Parts that are asked for are stored, so that Spark knows how few they are: the lists of all others, with everybody in some, are left
    # out before a shuffle.
    parts = cut(short.select("_part").distinct(), "short-parts")
    of_parts = _least_ids(listed.join(parts, "_part", "left_semi"), "_part", n + 1)

    wanted = different.where(F.char_length("_part") > PART_CHARS).withColumn("_part", F.explode(_grams(needle, PART_CHARS)))
    counts = listed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    rarest = wanted.join(counts, "_part").groupBy("query").agg(F.min(F.struct("_n", "_part")).alias("_least"))
    rarest = cut(rarest.select("query", F.col("_least._part").alias("_part"), F.ceil(F.col("_least._n") / block).alias("_blocks")), "rarest-parts")
    blocks = cut(rarest.select("_part", "_blocks").distinct(), "part-blocks")
    dealt = _postings(people, "_name", "_email").join(blocks, "_part").withColumn("_block", F.pmod(F.xxhash64("id"), "_blocks")).drop("_blocks")
    sent = rarest.select("query", "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)).alias("_block"))
    met = sent.join(dealt, ["_part", "_block"]).where(F.col("_name").contains(needle) | F.col("_email").contains(needle))

    few = short.join(of_parts, "_part").select("query", "id").unionByName(_least_ids(met, "query", n + 1))
    hits = asked.join(few, "query").where(F.col("id").cast("string") != F.col("searcher_id"))
    place = F.row_number().over(Window.partitionBy("query", "searcher_id").orderBy("id"))
    named = persons.select("id", "first_name", "last_name", full_name().alias("full_name"), "email")
    found = hits.withColumn("_place", place).where(F.col("_place") <= n).join(named, "id")
    return found.select("query", "searcher_id", "id", "first_name", "last_name", "full_name", "email")


def direct_conversations(conversations: DataFrame, participants: DataFrame) -> DataFrame:
    """The direct conversation of each person pair, least id first. A direct conversation has two members, so their
    least and greatest ids are the pair and no self join is needed."""
    direct = conversations.where(F.col("conversation_type") == "DIRECT").select(F.col("id").alias("conversation_id"))
    ends = (
        participants.join(direct, "conversation_id", "left_semi")
        .groupBy("conversation_id")
        .agg(F.min("person_id").alias("person_1"), F.max("person_id").alias("person_2"))
        .where(F.col("person_1") < F.col("person_2"))
    )
    return ends.groupBy("person_1", "person_2").agg(
        F.min("conversation_id").alias("conversation_id"), F.count(F.lit(1)).alias("conversations")
    )


def reaction_state(log: DataFrame) -> DataFrame:
    """Current reaction per (message, person): the last log entry, gone if that was a delete."""
    last = F.max_by(F.struct("reaction_type", "action"), "seq").alias("_last")
    return (
        log.groupBy("message_id", "person_id").agg(last)
        .where(F.col("_last.action") != "DELETE")
        .select("message_id", "person_id", F.col("_last.reaction_type").alias("reaction_type"))
    )


def read_state(log: DataFrame) -> DataFrame:
    """First receipt per (message, person); repeated receipts change nothing."""
    return log.groupBy("message_id", "person_id").agg(F.min("read_at").alias("read_at"))


def last_read(log: DataFrame) -> DataFrame:
    """Latest mark-read time per (conversation, person)."""
    return log.groupBy("conversation_id", "person_id").agg(F.max("read_at").alias("last_read_at"))


def folder_state(log: DataFrame) -> DataFrame:
    """Current folder and notification level per participant.

    ``START`` entries put the starter in MAIN and the recipient in REQUEST. A move to RESTRICTED mutes, to MAIN unmutes,
    to REQUEST leaves the level as it was. Last values come from ``max_by``, which combines on the map side.
    """
    starts = F.when(F.col("detail") == "STARTER", MAIN).otherwise(REQUEST)
    folder = F.when(F.col("action") == "START", starts).otherwise(F.col("detail"))
    moved = F.col("action") == "MOVE"
    level = F.when(moved & (F.col("detail") == RESTRICTED), MUTED).when(moved & (F.col("detail") == MAIN), ALL)
    return (
        log.select("conversation_id", "person_id", "seq", folder.alias("folder"), level.alias("level"))
        .groupBy("conversation_id", "person_id")
        .agg(
            F.max_by("folder", "seq").alias("folder"),
            F.max_by("level", F.when(F.col("level").isNotNull(), F.col("seq"))).alias("level"),
        )
        .select("conversation_id", "person_id", "folder", F.coalesce("level", F.lit(ALL)).alias("notification_level"))
    )


def membership_state(log: DataFrame) -> DataFrame:
    """Current members: pairs whose last entry is a join. A repeated join changes nothing."""
    return (
        log.groupBy("conversation_id", "person_id")
        .agg(F.max_by("action", "seq").alias("action"))
        .where(F.col("action") == "JOIN")
        .select("conversation_id", "person_id")
    )


def membership_messages(log: DataFrame, persons: DataFrame) -> DataFrame:
    """System rows announcing each join and leave."""
    people = persons.select(F.col("id").alias("person_id"), full_name().alias("_name"))
    verb = F.when(F.col("action") == "JOIN", " joined the group").otherwise(" left the group")
    return log.join(people, "person_id").select(
        "conversation_id", "person_id", "seq", F.lit("SYSTEM").alias("message_type"), F.concat("_name", verb).alias("body")
    )


def message_type(mime: Column) -> Column:
    """Message type of an attachment's MIME type; TEXT without one, FILE for anything that is not a known medium."""
    result = F.when(mime.isNull(), "TEXT")
    for prefix, name in MEDIA_PREFIXES.items():
        result = result.when(mime.startswith(prefix), name)
    return result.otherwise("FILE")
