"""The registered queries on whole small tables, against SQL twins, libraries or brute force."""

import compare
import public_tokenizers
import pytest

import corpus_pipeline
from agorakit.llm import catalog, pieces, simhash

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, sf_dir, name):
    _, problems = compare.compare(spark, compare.connect(sf_dir), sf_dir, name, QUERIES[name], ORACLES[name])
    assert not problems


def test_every_query_has_a_row_a_document(spark, sf_dir, texts):
    for name in set(QUERIES) - {"op7_mixing"}:
        got = [r.doc_id for r in QUERIES[name](spark, sf_dir).select("doc_id").collect()]
        assert sorted(got) == sorted(texts), name


def test_languages_of_held_out_documents(spark, sf_dir, texts):
    rows = [r for r in QUERIES["op9_language_id"](spark, sf_dir).collect() if r.held_out]
    assert rows and sum(r.lang_pred == texts[r.doc_id].lang for r in rows) >= 0.97 * len(rows)


def test_pipeline(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        kept[name] = rows
    by_language, by_line, by_copy, mixed = kept.values()
    assert {r.doc_id for r in by_language} == {i for i, r in texts.items() if any(c.isalpha() for c in r.text or "")}
    assert [r.doc_id for r in sorted(by_line)] == [r.doc_id for r in sorted(by_language)]
    values = [simhash.fingerprint(r.text) for r in sorted(by_line)]
    groups = {}
    for r, v in zip(sorted(by_line), values):
        near = [g for g in groups if any((v ^ w).bit_count() <= 3 for w in groups[g])]
        joined = [v] + [w for g in near for w in groups.pop(g)]
        groups[min([*near, r.doc_id])] = joined
    assert {r.doc_id for r in by_copy} == set(groups) and len(by_copy) == len(groups)
    assert {r.doc_id for r in mixed} == set(groups) and len(mixed) >= len(groups)
    tool = pieces.PieceEncoder(public_tokenizers.path(corpus_pipeline.MODEL))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert len(last) == len(mixed)
    whole = {r.doc_id: r.text for r in mixed}
    assert all(r.ids == tool.encode(whole[r.doc_id] or "") and r.n_tokens == len(r.ids) for r in last)


def test_line_dedup_in_the_pipeline(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text", "n_chars").schema
    copy = "\n".join(f"line {k} of the copied document" for k in range(8))
    near = [f"{copy.replace('copied', 'edited')}\nown end {i}" for i in range(5)]
    texts = {"copies": [copy] * 40 + [f"clean {i}\nother {i}" for i in range(20)] + near, "small": [f"story {i}\nfooter" for i in range(19)]}
    rows = [(source, text) for source, found in texts.items() for text in found]
    docs = spark.createDataFrame([(i, s, t, len(t)) for i, (s, t) in enumerate(rows)], schema)
    lines = corpus_pipeline.line_dedup(spark, docs, sf_dir)
    kept = corpus_pipeline.near_dedup(spark, lines, sf_dir).collect()
    assert sum(r.text == copy for r in kept) == 1
    out = {r.doc_id: r for r in lines.collect()}
    assert all(out[i].text == (t if s == "copies" else t.removesuffix("\nfooter")) for i, (s, t) in enumerate(rows))
    assert all(r.n_chars == len(r.text) for r in out.values())
