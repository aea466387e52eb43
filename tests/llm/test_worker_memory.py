"""What a worker process keeps between tasks."""

import public_tokenizers
import sentencepiece

from agorakit.llm import arrow, langid, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_a_worker_keeps_one_tool(spark):
    """Language ID and encoding of one pipeline run in the same workers: the first one's words go when the second begins."""
    docs = spark.createDataFrame([(i, f"some words {i}", "en") for i in range(8)], "doc_id bigint, text string, lang string").coalesce(1)
    tree = langid.learn(docs)

    def held(batches):
        import gc

        yield from batches
        tools = [x for x in gc.get_objects() if type(x).__name__ in ("Scorer", "PieceEncoder")]
        if len(tools) > 1:
            raise ValueError(f"{len(tools)} tools")

    for _ in range(2):
        langid.identify(docs, tree, ["doc_id"]).collect()
        pieces.encode(docs, PATH).collect()
        docs.select("doc_id").mapInArrow(held, "doc_id bigint").collect()
    first, second = (arrow.tool_of_worker(("test", k), lambda: [0]) for k in (1, 2))
    assert first is not second and list(arrow._TOOL) == [("test", 2)] and arrow.tool_of_worker(("test", 2), list) is second
    arrow._TOOL.clear()


def test_kept_pairs_stay_few(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_PAIRS", 20)
    own, library = pieces.PieceEncoder(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("the quick brown fox jumps over lazy dogs", "é中 \n unbelievable antidisestablishment", "aaaaaa http://x.y/z"):
        assert own.encode(text) == library.encode(text) and len(own.fit) <= 20
