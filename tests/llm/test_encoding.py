import os
import random

import pytest

from aerolake.llm.encoding import DEFAULT_VOCABULARY, Encoder, encode_documents, load_vocabulary

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_VOCABULARY), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_same_ids(reference):
    rng = random.Random(3)
    texts = ["", "a", "aaa", "a" * 17, " hello  world\n\n\t x's don't", "<|endoftext|> hi", "été \x1c\x1d z\x85q", "🌡️🌬️ 👍", "日本語テキスト", "﻿abc​ d́", "1234567890 12.5e-3"]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 128), rng.randrange(128, 1000), rng.randrange(0x2000, 0x2100)])) for _ in range(200)) for _ in range(20)]
    texts += ["x" * 9000, "".join(rng.choice("abcdefghij") for _ in range(6000))]  # pieces merged by the heap
    assert Encoder(load_vocabulary(DEFAULT_VOCABULARY)).encode(texts) == reference(texts)


def test_heap_and_recursion_agree():
    enc = Encoder(load_vocabulary(DEFAULT_VOCABULARY))
    rng = random.Random(4)
    for _ in range(30):
        piece = "".join(rng.choice("aabcdeé ") for _ in range(60)).replace(" ", "")
        enc.known.clear()
        enc.learn([piece])
        assert enc.known[piece] == enc.by_heap(piece.encode())


def test_documents(spark, reference):
    rows = [(1, "The UPS kept its set point.", "c"), (2, None, "c"), (3, "", "c"), (4, "  \n", None), (5, "The UPS kept its set point.", "c"), (6, "word " * 60_000, "c")]
    got = {r.doc_id: r.ids for r in encode_documents(spark.createDataFrame(rows, "doc_id long, text string, ids string")).collect()}
    assert got[2] == got[3] == [] and got[1] == got[5]
    assert [got[i] for i in (1, 4, 6)] == reference([rows[0][1], rows[3][1], rows[5][1]])
    assert encode_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
