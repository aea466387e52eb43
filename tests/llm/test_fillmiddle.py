"""Fill-in-middle against its definition, row by row."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from agorakit.llm import fillmiddle
from agorakit.llm.common import documents

SCHEMA = "doc_id bigint, text string"


def by_definition(ident, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def hard_texts():
    draw = random.Random(11)
    bits = ["a", "Zz", " ", "\n", "é", "日本", "😀", "<", "P", ">", "<P", "S>", "M>", "[", "`", "{", "@", "́", "0", "<S", "\x00"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    return [None, "", "<P>", "x<M>y", "<", "P>", *texts, "word é " * 30_000, "a" * 100_000, "é" * 50_000]


def test_whole_rows_by_definition(spark):
    texts = hard_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (7, "same id"), (7, "same id"), (-3, "below zero")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = fillmiddle.restore(fillmiddle.fill_in_middle(df)).collect()
    got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out), key=repr)
    assert got == sorted(((i, t, *by_definition(i, t)) for i, t in rows), key=repr)
    assert all(r.restored == (r.text or "") for r in out)
    assert {r.form for r in out} == set(fillmiddle.FORMS)


def test_parts_of_a_batch_do_not_change_results(spark, monkeypatch):
    from agorakit.llm import flat

    batch = fillmiddle.pa.RecordBatch.from_pydict({"x": hard_texts()[:60]})
    for most in (1, 7, 100):
        found = list(flat.parts(batch, 0, most))
        assert fillmiddle.pa.Table.from_batches(found).to_pydict() == batch.to_pydict()
        assert all(p.num_rows == 1 or sum(len((x or "").encode()) for x in p.column(0).to_pylist()) <= most for p in found)


def test_clashing_columns_and_no_rows(spark):
    names = "n form Prefix_chars middle_chars output restored _ident _body _code".split()
    df = spark.createDataFrame([(1, "some text here")], SCHEMA).withColumns({c: F.lit(f"own {c}") for c in names})
    row = fillmiddle.restore(fillmiddle.fill_in_middle(df)).first()
    assert row["_ident"] == "own _ident" and row["_body"] == "own _body" and row["_code"] == "own _code" and row.restored == row.text and row.n == 5
    assert fillmiddle.restore(fillmiddle.fill_in_middle(df.where("false"))).count() == 0
    with pytest.raises(Exception, match="three markers"):
        fillmiddle.restore(spark.createDataFrame([("no markers", "psm")], "output string, form string")).collect()


def test_query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    want = {(i, *by_definition(i, t)) for i, t in docs.select("doc_id", "text").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = fillmiddle.query(docs).collect()
    texts = {i: t or "" for i, t in docs.select("doc_id", "text").collect()}
    assert {tuple(r)[:5] + (r.output_sha256,) for r in rows} == {(*w[:5], sha(w[5])) for w in want}
    assert len(rows) == len(want) and all(r.restored_sha256 == sha(texts[r.doc_id]) for r in rows)
