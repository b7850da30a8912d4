import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tripcraft.llm import tokens
from tripcraft.llm.common import shared_path
from tripcraft.llm.eliasfano import EliasFano

SPEC = open(tokens.default_vocabulary(), encoding="utf-8").read()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=600))
def test_elias_fano(values):
    values.sort()
    e = EliasFano.from_bytes(EliasFano.encode(np.array(values, dtype=np.uint64)).to_bytes())
    assert e.decode().tolist() == values and [e.select(i) for i in range(len(values))] == values


def test_encoder_equals_whole_texts():
    encoder, random_ = tokens.Encoder(SPEC), random.Random(1)
    parts = [" ", "  ", "\n", "\t", " \n", "a", "don't", "'s", ".", "!!", " ", "é", "9", "\x1c", "　",
             "<|endoftext|>", "_", "🙂", "\r\n", "中", "²"]
    texts = ["".join(random_.choices(parts, k=random_.randint(0, 14))) for _ in range(5000)]
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_files(spark):
    rows = [(5, "five five"), (None, "none"), (-3, None), (5, "five"), (2, ""), (9, "long " * 20000), (None, "none")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, k string")
    plain = tokens.Encoder(SPEC).tokenizer
    start = 0
    ids = {t: plain.encode(t or "", add_special_tokens=False).ids + [0] for _, t in rows}
    got = [tuple(r) for r in tokens.write_and_read(docs, file_ids=3).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, None, -3, 2, 5, 5, 9]
    assert sorted((r[0] or 0, r[2], r[3]) for r in got) == sorted(
        (k or 0, len(ids[t]), zlib.crc32(np.array(ids[t], dtype="<u4").tobytes())) for k, t in rows)
    for r in got:
        assert r[1] == start
        start += r[2]
    folder = shared_path(spark, "t")
    one = tokens.write(docs.coalesce(1), folder).collect()
    file = tokens.TokenFile(one[-1].path)
    assert file.document(file.n_docs - 1).tolist() == ids["long " * 20000] and file.width == 2
    assert tokens.write_and_read(docs.limit(0)).count() == 0


def test_each_different_piece_is_looked_up_once(monkeypatch):
    class Counting(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    encoder = tokens.Encoder(SPEC)
    encoder.after = Counting()
    texts = ["one " + "two three " * 500 + "end", None, "", "alone", "é two\nlines  and runs", "two three", "two"]
    want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    assert encoder.after.asked == 3
    monkeypatch.setattr(tokens, "CHARS", 10)  # a text or two at once
    for _ in range(3):  # unknown, seen once, remembered
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
