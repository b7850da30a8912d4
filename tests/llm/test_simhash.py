import random

import pytest
import xxhash

from tripcraft.llm import simhash
from tripcraft.llm.common import table


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


def brute_groups(rows):
    """rows: (doc_id, fingerprint) -> smallest id reachable, by doc position."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        r = find(i)
        low[r] = k if low.get(r) is None else low[r] if k is None else min(low[r], k)
    return [low[find(i)] for i in range(len(rows))]


@pytest.fixture(scope="module")
def docs(spark, sf001):
    return table(spark, sf001, "documents", "doc_id", "text")


def test_query_equals_brute_force(spark, sf001, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in simhash.op1_simhash(spark, sf001).collect()}
    prints = [(k, brute_fingerprint(t)) for k, t in rows]
    assert len(got) == len(rows)
    for (k, f), low in zip(prints, brute_groups(prints), strict=True):
        assert (got[k].fingerprint, got[k].component_id) == (f"{f:016x}", low)


def test_links_lose_nothing(spark):
    random.seed(3)
    values = set()
    for _ in range(60):  # chains and clusters at 1 to 4 bits
        v = random.getrandbits(64)
        for _ in range(12):
            values.add(v)
            w = v
            for b in random.sample(range(64), random.randint(1, 4)):
                w ^= 1 << b
            values.add(w)
            v = random.choice([v, w])
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    got = {(r.src, r.dst) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    want = {(a, b) for i, b in enumerate(signed) for a in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want


def test_edges(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, None), (7, ""), (3, " \t\n"), (None, "A B C D"), (9, "x"), (2, "ä " * 50000)]
    df = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, text string, fp int, row string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    zero = "0" * 16
    assert by[(None, zero)] == by[(7, zero)] == by[(3, zero)] == 3
    assert by[(None, f"{brute_fingerprint('a b c d'):016x}")] == 1
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 9]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0 and simhash.keep_one(df).count() == 0


def test_keep_one_with_a_map_column(spark):
    docs = spark.createDataFrame([(2, "a b c d", {"x": 1}), (1, "a b c d", {"y": 2}), (1, "a b c d", {"y": 2}), (3, "other words stand here", None)],
                                 "doc_id long, text string, tags map<string,int>")
    assert sorted((r.doc_id, r.tags) for r in simhash.keep_one(docs).collect()) == [(1, {"y": 2}), (3, None)]
