from __future__ import annotations

import random

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from martline.llm.bpe import Store, WordBpe, decode, encode

FILE = path("word_bpe_49k.json")
ODD = [
    None, "", " ", "a", "Hello, World's  it'S 'S", "ΟΔΥΣΣΕΥΣ Σ aΣ", "İstanbul ß ẞ ǅ", "a\x1cb \x1d c", "x<|endoftext|>y <|startoftext|>", "<|ENDOFTEXT|> <|endoftext|", "é ́x",
    "12345 a1b2", "a\xa0b c​d", "日本語 テスト", "😀 👍🏽", "\x85a", "'s's 're'", "ẛ̣", "ﬁ Å", "\x00\x01a", "a᠎b", "internationalization" * 400,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_queue_merges_as_the_library(library):
    rng, model = random.Random(3), WordBpe(FILE)
    texts = [*(t or "" for t in ODD), *("".join(rng.choices("theingroauxé' .1", k=rng.randrange(60))) for _ in range(300))]
    for text, ids in zip(texts, model.encode(texts), strict=True):
        own = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == own, text
        assert model.decode(ids) == library.decode(own, skip_special_tokens=False)


def test_small_store_gives_the_same(library):
    model = WordBpe(FILE)
    model.pieces, model.words = Store(3), Store(2)
    texts = [f"alpha{k % 7} beta{k % 3} gamma" for k in range(40)]
    for k in range(0, 40, 2):
        for t, ids in zip(texts[k : k + 2], model.encode(texts[k : k + 2]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(model.pieces.old) <= 6


def test_frames(spark, library):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(ODD)] + [(None, "a", "x"), (None, "a", "x")], "doc_id long, text string, ids string")
    coded = encode(docs, FILE)
    assert coded.columns == ["doc_id", "text", "ids"]
    back = {r["doc_id"]: r for r in decode(coded, FILE).collect()}
    for k, t in enumerate(ODD):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(back[k]["ids"], "<u4").tolist() == ids and back[k]["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert coded.filter("doc_id IS NULL").count() == 2 and encode(docs.limit(0), FILE).collect() == []
