import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripcraft.llm import decontaminate
from tripcraft.llm.fmindex import FMIndex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    out = []
    for k, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, x in items:
            y = words(x)
            for a in range(max(1, len(y) - size + 1) if y else 0):
                g = y[a:a + size]
                for p in range(len(w) - len(g) + 1):
                    if w[p:p + len(g)] == g:
                        hit.update(range(p, p + len(g)))
                        ids.update([] if i is None else [str(i)])
        out.append((k, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=40), min_size=1, max_size=5),
       st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=6), min_size=1, max_size=8))
def test_index_finds_every_occurrence(runs, patterns):
    width = max(map(len, patterns))
    rows = np.zeros((len(patterns), width), dtype=np.int64)
    for k, p in enumerate(patterns):
        rows[k, width - len(p):] = p
    index = FMIndex([np.array(r) for r in runs], 4)
    got = sorted(zip(*(x.tolist() for x in index.occurrences(rows, np.array([len(p) for p in patterns]))), strict=True))
    want = sorted((k, r, a) for k, p in enumerate(patterns) for r, run in enumerate(runs)
                  for a in range(len(run) - len(p) + 1) if run[a:a + len(p)] == p)
    assert got == want


def test_edges_and_removal(spark, monkeypatch):
    long = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, long), (20, "Short Item"), (3, None), (4, ""), (None, "nameless passage here"), (1, long), (5, "!!!")]
    docs = [(1, f"start {long.upper()} end"), (None, "a short; item b short item"), (2, None), (3, ""), (4, "clean text"),
            (4, "clean text"), (5, "some nameless passage here now"), (6, "x " * 30000 + long + " y" * 30000),
            (7, "short short item item"), (8, "short item")]
    d = spark.createDataFrame([(*x, "keep", 9) for x in docs], "doc_id long, text string, items string, spans int")
    b = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK", 2)  # several passes
    found = decontaminate.search(d, b).collect()
    got = [(r.row.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"]),
            hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.spans)) for r in found]
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)
    out = {r.doc_id: r for r in decontaminate.remove(d.selectExpr("*", "length(text) as n", "1 as n_words"), b, length="n").collect()}
    assert 8 not in out and 7 not in out  # nothing is left, the second after two cuts
    assert out[1].text == "start  end" and out[1].n == 10 and out[4].text == "clean text" and out[2].text is None
    assert not any(x[2] for x in brute([(k, r.text) for k, r in out.items()], items))
    none = spark.createDataFrame([], b.schema)
    assert not any(r.spans for r in decontaminate.search(d, none).collect())
    assert decontaminate.search(d.limit(0), b).count() == 0


def test_blocks_change_nothing(spark, monkeypatch):
    """A long item over many blocks, a window that many items share, cuts that join words to a window of another block:
    search equals brute force, and removal gives the same rows as with one block."""
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(12)]
    items = [("long", " ".join(f"t{k}" for k in range(60)))] + [(f"s{k:02d}", "shared passage") for k in range(20)]
    items += [(f"r{k}", " ".join(rng.choice(words, rng.integers(2, 5)))) for k in range(15)]
    docs = [(k, " ".join(rng.choice(words, rng.integers(0, 25)))) for k in range(120)]
    docs += [(200, "a " + " ".join(f"t{k}" for k in range(20, 45)) + " b"), (201, "one shared shared passage passage two"), (202, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.col("doc_id")).withColumn("t", F.lit("x"))
    b = spark.createDataFrame(items, "item_id string, text string")
    whole = sorted(tuple(r) for r in decontaminate.remove(d, b).collect())
    monkeypatch.setattr(decontaminate, "BLOCK", 25)
    assert decontaminate.pairs(b, "item_id", "text", 10).count() > 50
    got = [(r.row.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"]),
            hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.spans)) for r in decontaminate.search(d, b).collect()]
    assert sorted(got) == sorted(brute(docs, items))
    blocks = sorted(tuple(r) for r in decontaminate.remove(d, b).collect())
    assert not any(x[2] for x in brute([r[:2] for r in blocks], items))
    assert {r[0] for r in blocks} == {r[0] for r in whole} and (201, "one two") in {(k, " ".join((t or "").split())) for k, t, *_ in blocks}
    clean = {k for k, *_, hit in brute(docs, items) if not hit}
    assert [r for r in blocks if r[0] in clean] == [r for r in whole if r[0] in clean]


def test_one_block_is_one_python_step(spark):
    """Two chained Python steps are two workers per task. Only what was cut differs from the rows that came in."""
    docs = [(1, "a shared passage b", "p", 18), (2, "shared shared passage passage", "q", 29), (3, None, None, None), (4, "clean  Text", "r", 11), (4, "", "r", 0)]
    d = spark.createDataFrame(docs, "t long, text string, row string, ever long").repartition(2)
    b = spark.createDataFrame([("x", "shared passage")], "item_id string, text string")
    out = decontaminate.remove(d, b, length="ever")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert out.schema == d.schema
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "a  b", "p", 4), *docs[2:]], key=str)
