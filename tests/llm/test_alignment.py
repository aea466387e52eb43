"""Cross-tokenizer alignment against both libraries and a definition by byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agorakit.llm import alignment
from agorakit.llm.common import documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ONE = Tokenizer.from_file(A)
ONE.encode_special_tokens = True
TWO = sentencepiece.SentencePieceProcessor(model_file=B)


@lru_cache
def byte_of():
    """The byte of each character in tokens, from what the library shows for characters that hold all bytes of UTF-8."""
    from tokenizers.pre_tokenizers import ByteLevel

    shows, out = ByteLevel(add_prefix_space=False, use_regex=False), {}
    codes = [*range(0x800), 0x800, *range(0x1000, 0xD000, 0x1000), 0xD000, 0xE000, 0xF000, *range(0x10000, 0x110000, 0x10000)]
    for text in map(chr, codes):
        out.update(zip("".join(x for x, _ in shows.pre_tokenize_str(text)), text.encode()))
    return out


def tokens(text):
    """Ids and byte ranges of both, or none."""
    if not text:
        return [], []
    a = ONE.encode(" " + text, add_special_tokens=False).ids
    b = TWO.encode(text)
    a_bytes = [bytes(byte_of()[c] for c in ONE.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(TWO.id_to_piece(i)[3:5], 16)]) if TWO.is_byte(i) else TWO.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], []

    def ranges(ids, parts):
        at, out = 0, []
        for i, p in zip(ids, parts):
            out.append((i, at, at + len(p)))
            at += len(p)
        return out

    return ranges(a, a_bytes), ranges(b, b_bytes)


def by_definition(text):
    a, b = tokens(text)
    links = [(i, j) for i, (_, s, e) in enumerate(a) for j, (_, t, f) in enumerate(b) if s < f and t < e]
    ends = sorted({e for *_, e in a} & {f for *_, f in b})
    groups, last = [], 0
    for end in ends:
        groups.append(",".join(str(i) for i, s, e in a if last <= s and e <= end) + "|" + ",".join(str(i) for i, s, e in b if last <= s and e <= end))
        last = end
    return a, b, links, groups


def statistics(rows):
    """What link_statistics returns, by definition."""
    found = [(i, *by_definition(t)) for i, t in rows]
    count = Counter()
    for _, a, b, links, _ in found:
        count.update({(a[i][0], b[j][0]) for i, j in links})
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = Counter()
    for ident, a, b, links, groups in found:
        each = [count[a[i][0], b[j][0]] for i, j in links]
        best = sum(n == most[a[i][0]] for n, (i, _) in zip(each, links))
        out[ident, len(a), len(b), len(groups), len(links), best, sum(each), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""] += 1
    return out


BITS = ["a", "the", "ing ", " ", "  ", "\n", "\n\n", "\t", "é", "é", "日本", "😀", "'s", "'ll", "<|endoftext|>", "</s>", "<s>", "<0x41>", "1", "2024", "\x1c", "\x85", " ", "​",
        "Ünï", "hello", "World", ".", ", ", "\x00", "٣", "Привет", " мир", "Ελ"]


def hard_texts(n=400):
    draw = random.Random(6)
    return [None, "", " ", "\n", "▁", "a▁b", *("".join(draw.choice(BITS) for _ in range(draw.randint(1, 25))) for _ in range(n))]


def digest_columns(rows):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows)


def test_ids_match_the_libraries(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN", 40)
    tool, texts = alignment.Pair(A, B), hard_texts(4000)
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        a, a_cuts, b, b_cuts = tool.encode(alignment.pa.array(some))
        for k, text in enumerate(some):
            want = tokens(text)
            assert [x[0] for x in want[0]] == a[a_cuts[k] : a_cuts[k + 1]].tolist() and [x[0] for x in want[1]] == b[b_cuts[k] : b_cuts[k + 1]].tolist(), text


@pytest.mark.parametrize("lane", [1, 3, 10_000])
def test_lockstep_by_definition(lane):
    draw = np.random.default_rng(2)
    sizes, a_size, b_size = [], [], []
    for k in range(60):
        total = 0 if k % 7 == 3 else int(draw.integers(1, 120))
        cuts = [np.unique(np.append(draw.integers(1, total + 1, draw.integers(0, 60)), total)) if total else np.empty(0, int) for _ in "ab"]
        sizes.append([len(c) for c in cuts])
        a_size.append(np.diff(cuts[0], prepend=0))
        b_size.append(np.diff(cuts[1], prepend=0))
    a_cuts, b_cuts = (np.cumsum([0, *x]) for x in zip(*sizes))
    a, b = np.concatenate(a_size), np.concatenate(b_size)
    found = alignment.lockstep(a, a_cuts, b, b_cuts, lane)
    a_end, b_end = np.cumsum(a), np.cumsum(b)
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if a_end[i] - a[i] < b_end[j] and b_end[j] - b[j] < a_end[i]}
    got = list(zip(found.a_link.tolist(), found.b_link.tolist()))
    assert set(got) == want and len(got) == len(want)
    assert found.a_last.tolist() == np.isin(a_end, b_end).tolist() and found.b_last.tolist() == np.isin(b_end, a_end).tolist()


def test_alignments_by_definition(spark):
    rows = list(enumerate(hard_texts(120)))
    out = alignment.align(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2), A, B).collect()
    assert sorted(r.doc_id for r in out) == [i for i, _ in rows]
    for r in out:
        a, b, links, groups = by_definition(r.text)
        assert (r.a_ids, r.b_ids) == ([x[0] for x in a], [x[0] for x in b]) and [tuple(x) for x in r.links] == links and r.groups == ";".join(groups)
        assert len(r.a_cuts) == len(r.b_cuts) == len(groups)
        assert [a[k - 1][2] for k in r.a_cuts] == [b[k - 1][2] for k in r.b_cuts]


@pytest.mark.parametrize("most", [1, 500, 1 << 20])
def test_statistics_by_definition(spark, monkeypatch, most):
    rows = list(enumerate(hard_texts(150))) + [(None, "no id"), (7, "same id"), (7, "same id"), (8, "the word " * 900), (9, "x" * 3000)]
    parts = alignment.parts
    monkeypatch.setattr(alignment, "parts", lambda batch, column, _=None: parts(batch, column, most))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert digest_columns(alignment.link_statistics(df, A, B).collect()) == statistics(rows)


def test_clashing_columns_and_no_rows(spark):
    names = "n_a N_best count_sum groups a_ids links _part _at _times _pairs _docs _body part at".split()
    df = spark.createDataFrame([(1, "Some text")], "doc_id bigint, text string").withColumns({c: F.lit(f"own {c}") for c in names})
    row = alignment.link_statistics(df, A, B).first()
    assert row["_part"] == "own _part" and row["part"] == "own part" and row["_body"] == "own _body" and row["n_a"] == 2
    assert alignment.align(df, A, B).first()["_body"] == "own _body"
    assert alignment.link_statistics(df.where("false"), A, B).count() == 0 and alignment.align(df.where("false"), A, B).count() == 0
    empty = alignment.link_statistics(df.withColumn("text", F.lit("")), A, B).first()
    assert (empty.n_a, empty.n_links, empty["n_best"], empty.groups_sha256) == (0, 0, 0, "")
    with pytest.raises(ValueError):
        alignment.Pair(public_tokenizers.path("word_bpe_49k.json"), B)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 2500]
    df = spark.createDataFrame(short, "doc_id bigint, text string")
    assert digest_columns(alignment.query(df).collect()) == statistics(short)
    assert sorted(r.doc_id for r in alignment.query(documents(spark, sf_dir)).select("doc_id").collect()) == sorted(i for i, _ in rows)
