import random

import pytest
from tokenizers import Tokenizer, models

from tripcraft.llm import tokencount
from tripcraft.llm.common import table

PIECES = tokencount.load(tokencount.default_vocabulary())


@pytest.fixture(scope="module")
def library():
    return Tokenizer(models.Unigram([("<unk>", 0.0), *PIECES, *((f"<0x{b:02X}>", 0.0) for b in range(256))], unk_id=0, byte_fallback=True))


def whole(library, text):
    return len(library.encode(tokencount.SPACE + text.replace(" ", tokencount.SPACE)).ids) if text else 0


def test_counts_equal_the_library(library):
    rng, counter = random.Random(2), tokencount.Counter(PIECES)
    parts = ["the", "a", "in", " ", "  ", "\n", "².", "2", ".", "!!", "é", "中", "🙂", "er", "ing", "▁", "x", "Q", "\t", "'s", "   "]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 16)))
        n, score = counter.count(text)
        assert n == whole(library, text.replace("▁", " ")), text
        assert not text or score == counter.path("▁" + text.replace(" ", "▁")).real


def test_ties_take_the_longest_piece():
    counter = tokencount.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abc", -3.0), ("c", -1.0)])
    assert counter.path("abc") == complex(-3, 1) and counter.path("ab") == complex(-2, 1)
    assert counter.path("aé") == complex(-1 - 13, 3)


def test_query(spark, sf001, library):
    texts = {r.doc_id: r.text for r in table(spark, sf001, "documents", "doc_id", "text").collect()}
    got = tokencount.op2_token_counts(spark, sf001).collect()
    assert len(got) == len(texts) and all(r.n_tokens == whole(library, texts[r.doc_id]) for r in got)


def test_edges(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2), (2, " ", 3), (3, "word " * 30000, 4)], "doc_id long, text string, t int")
    got = sorted((r.n_tokens for r in tokencount.token_counts(df).collect()))
    assert got[:4] == [0, 0, 0, 1] and got[4] >= 30000
    assert tokencount.token_counts(df.limit(0)).count() == 0
