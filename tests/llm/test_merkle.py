import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripcraft.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(level, fanout):
    """Root and, per node, its steps (left, right) upwards."""
    steps, where = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, at in enumerate(where):
            low = at - at % fanout
            steps[i].append(("".join(level[low:at]), "".join(level[at + 1:low + fanout])))
        where = [at // fanout for at in where]
        level = [sha(*level[k:k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], steps


def brute(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in groups[g]], fanout)
    root, over = climb([trees[g][0] for g in names], fanout)
    out = []
    for g, more in zip(names, over, strict=True):
        for r, steps in zip(groups[g], trees[g][1], strict=True):
            path = steps + more
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                changed[3] += 1
            h = leaf(changed)
            for a, b in path:
                h = sha(a, h, b)
            out.append((r[0], leaf(r), trees[g][0], root, sha(*(a + b for a, b in path)), h, h == root))
    return sorted(out, key=str)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def proved(docs, **options):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = merkle.prove(docs, changed={"n_chars": F.try_add("n_chars", F.lit(1))}, where=hit, **options)
    return sorted((tuple(r) for r in out.drop("path").collect()), key=str)


@pytest.mark.parametrize(("fanout", "block"), [(2, 1024), (2, 4), (3, 9), (5, 2)])
def test_brute_force(spark, monkeypatch, fanout, block):
    """One group with most rows, groups of one row, a null group; several tiers where blocks are small."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = [(k, "src", "big" if k % 3 else f"l{k % 41}", k, "t" * (k % 5)) for k in range(150)]
    rows += [(k, None, None, None, None) for k in range(7)] + [(900, "s", "one", 1, "x")]
    assert proved(spark.createDataFrame(rows, COLUMNS).repartition(5), fanout=fanout) == brute(rows, fanout)


def test_edges(spark):
    rows = [(None, None, None, None, None), (None, "a", None, 1, ""), (3, "ü", "d", 2, "é\n中🙂"), (3, "ü", "d", 2, "é\n中🙂"),
            (3, "v", "d", 2, "-"), (-7, "", "", 0, ""), (4, "x", "d", (1 << 63) - 1, "long " * 100_000), (5, "-", "D", -1, "1:a")]
    docs = spark.createDataFrame([(*r, "g", 1, "h") for r in rows], COLUMNS + ", g string, pos int, top string")
    assert zlib.crc32(b"4") % 7 and proved(docs) == brute(rows)
    assert proved(docs.limit(0)) == []
    one = [(1, "s", "l", 1, "t")]
    got = proved(spark.createDataFrame(one, COLUMNS))
    assert got == brute(one) and got[0][1] == got[0][3]


def test_levels_share_one_exchange(spark):
    """All levels of a tier are windows over one partitioning."""
    nodes = spark.range(5000).selectExpr("string(id % 1) as g", "id as pos", "5000L as n", "sha2(string(id), 256) as h")
    plan = merkle.climb(nodes, 2, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window") >= 10
