"""BPE against the library, and merge rounds against their definition."""

import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agorakit.llm import bpe
from agorakit.llm.common import documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
BITS = [
    "a", "the", "ing", " ", "  ", "\n", "\t", " ", "é", "é", "́", "Σ", "ς", "İ", "ß", "日本", "😀", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|",
    "1", "²", "٣", "\x1c", "\x85", " ", "​", "aaaaaaa", "ABC", "Ǆ", "ﬁ", "½", "\x00", "﻿", "가", "ᄀ", "ᅡ", "!?",
]


def hard_texts():
    draw = random.Random(4)
    texts = ["".join(draw.choice(BITS) for _ in range(draw.randint(0, 14))) for _ in range(3000)]
    return [None, "", " \n", *texts, "the end of all things " * 4000, "x" * 50_000, "".join(draw.choice("abcdefgh") for _ in range(20_000)), "ab" * 9_001 + "!?" * 5_000]


def test_texts_match_the_library(spark):
    rows = list(enumerate(hard_texts())) + [(None, "no id"), (5, "same"), (5, "same")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=repr) == sorted(rows, key=repr)
    for r in out:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == LIBRARY.decode(ids, skip_special_tokens=False)


def by_definition(merges, word):
    """The lowest-ranked pair joins first, of equals the leftmost."""
    rank = {m: i for i, m in enumerate(merges)}
    word = list(word)
    while True:
        found = [(rank[p], i) for i, p in enumerate(zip(word, word[1:])) if p in rank]
        if not found:
            return word
        _, i = min(found)
        word[i : i + 2] = ["".join(word[i : i + 2])]


@pytest.mark.parametrize("ordered", [True, False])
def test_rounds_by_definition(ordered):
    draw = random.Random(8)
    for _ in range(60):
        letters, merges = ["a", "b", "c"], []
        symbols = list(letters)
        while len(merges) < 12:
            pair = draw.choice(symbols), draw.choice(symbols)
            if pair not in merges and (not ordered or "".join(pair) not in symbols):
                merges.append(pair)
                symbols.append("".join(pair))
        if not ordered:
            draw.shuffle(merges)
        vocab = {s: i for i, s in enumerate(dict.fromkeys(symbols))}
        names = list(vocab)
        rules = bpe.Merges(vocab, merges)
        assert rules.ordered or not ordered
        words = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 25))) for _ in range(40)] + ["a" * k for k in range(1, 12)]
        cuts = np.cumsum([0, *map(len, words)])
        got, out = rules.join(np.array([vocab[c] for c in "".join(words)], np.int64), cuts)
        for word, a, b in zip(words, out, out[1:]):
            assert [names[i] for i in got[a:b]] == by_definition(merges, word)


def test_few_words_together_and_few_known(monkeypatch):
    monkeypatch.setattr(bpe, "TOGETHER", 3)
    monkeypatch.setattr(bpe, "KNOWN", 10)
    tool, texts = bpe.WordBpe(PATH), [x or "" for x in hard_texts()[:400]]
    for at in range(0, 400, 50):
        for text, ids in zip(texts[at : at + 50], tool.encode(texts[at : at + 50])):
            assert np.frombuffer(ids, np.uint32).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_clashing_columns_no_rows_and_other_files(spark):
    names = "IDs decoded _body _own".split()
    df = spark.createDataFrame([(1, "Some text")], "doc_id bigint, text string").withColumns({c: F.lit(f"own {c}") for c in names})
    row = bpe.decode(bpe.encode(df, PATH), PATH).first()
    assert row["_body"] == "own _body" and row["_own"] == "own _own" and row.decoded == "some</w> text</w>"
    assert bpe.decode(bpe.encode(df.where("false"), PATH), PATH).count() == 0
    assert bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), PATH).first().decoded == ""
    with pytest.raises(ValueError):
        bpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))


def test_query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = set()
    for i, text in docs.select("doc_id", "text").collect():
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        want.add((i, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    rows = [tuple(r) for r in bpe.query(docs).collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_kept_words_stay_small():
    """A worker that sees ever new words keeps at most 50 MB of them; an executor has one such worker a core."""
    tool, letters = bpe.WordBpe(PATH), "abcdefghij"
    for begin in range(0, 240_000, 40_000):
        names = ["".join(letters[int(c)] for c in str(n)) for n in range(begin, begin + 40_000)]
        tool.encode([" ".join(f"{x}日" if k % 2 else x for k, x in enumerate(names))])
    kept = [x for recent in (tool.words, tool.pieces, tool.runs) for x in (recent.known, recent.older)]
    entries = [recent.most for recent in (tool.words, tool.pieces, tool.runs)]
    each = max(sys.getsizeof(k) + sys.getsizeof(v) for held in kept for k, v in held.items()) + 104
    assert sum(entries) * each < 50 << 20 and max(map(len, kept)) <= 40_000 + max(entries) // 2
