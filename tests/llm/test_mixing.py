import random
from fractions import Fraction

from pyspark.sql import functions as F

from tripcraft.llm import mixing


def brute_fill(total, nodes):
    """nodes: name -> (capacity, weight); exact proportional filling."""
    out, open_, left = {}, dict(nodes), Fraction(total)
    while open_:
        weight = sum(w for _, w in open_.values())
        full = {k: c for k, (c, w) in open_.items() if c <= left * w / weight}
        if not full:
            return out | {k: left * w / weight for k, (_, w) in open_.items()}
        for k, c in full.items():
            out[k] = Fraction(c)
            left -= c
            del open_[k]
        left = max(left, 0)
    return out


def test_budgets_equal_exact_filling(spark):
    rng = random.Random(4)
    for total in (None, 1000, 10, 10**6):
        leaves = [(f"d{d}", lang, f"s{s}", rng.choice([0, 1, 5, 50, 500])) for d in range(3) for lang in ("en", "de", "xx")
                  for s in range(rng.randint(1, 4))]
        df = spark.createDataFrame(leaves, "domain string, lang string, source string, avail long")
        got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(df, total).collect()}
        spend = sum(x[3] for x in leaves) if total is None else total

        def cap(*path, leaves=leaves):
            return sum(2 * x[3] for x in leaves if x[:len(path)] == path)

        given = {(): Fraction(spend)}
        for k in range(3):
            for parent in {x[:k] for x in leaves}:
                children = {x[:k + 1] for x in leaves if x[:k] == parent}
                given |= brute_fill(given[parent], {c: (cap(*c), mixing.WEIGHTS[k].get(c[k], 1)) for c in children})
        for path, budget in got.items():
            assert 0 <= given[path] - budget < 12, (path, budget, given[path])  # whole tokens at three levels


def test_prefixes_and_edges(spark):
    rows = [(k, "w " * (k % 7), "en", "src1") for k in range(300)] + [(None, "a b c", None, None), (None, "a b c", None, None),
            (None, None, None, "src2"), (5, "", "de", "odd")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, budget int")
    got = mixing.mix(docs, total=400, max_epochs=1).collect()
    by = {}
    for r in got:
        by.setdefault((r.domain, r.lang, r.source), []).append(r)
    for leaf, taken in by.items():
        assert sum(r.tokens * r.n_epochs for r in taken) <= taken[0].budget, leaf
    leaf = by[("d1", "en", "src1")]
    budget = leaf[0].budget
    import hashlib
    order = sorted((hashlib.md5(f"{mixing.SEED}:0:{k}".encode()).hexdigest(), k % 7, k) for k in range(300))
    want, used = set(), 0
    for _, n, k in order:
        used += n
        if used > budget:
            break
        want.add(k)
    assert {r.row.doc_id for r in leaf} == want
    again = mixing.mixed(docs, max_epochs=2)
    assert again.columns == docs.columns
    assert again.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 6  # three rows of one id, two epochs
    assert mixing.mix(docs.limit(0)).count() == 0


def test_narrowing_changes_no_row(spark, monkeypatch):
    """Many passes of few buckets take the rows that one pass takes, copies of one key included, and a window stays small."""
    rows = [(k, "w " * (k % 9 + 1), "en" if k % 3 else "de", "src1") for k in range(3000)] + [(None, "same words here", "en", "src1")] * 800
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    def taken():
        return sorted((str(r.row), r.n_epochs) for r in mixing.mix(docs, total=9000, max_epochs=2).collect())

    whole = taken()
    monkeypatch.setattr(mixing, "BUCKET_HEX", 1)
    monkeypatch.setattr(mixing, "CUT_ROWS", 2)
    sizes = {len(r.cut_bucket) for r in mixing.cuts(docs.selectExpr(
        "'d1' as domain", "lang", "source", "coalesce(string(doc_id), md5(text)) as key", "3L as tokens"), total=5000, max_epochs=2).collect() if r.cut_bucket}
    assert sizes and min(sizes) >= 3
    assert taken() == whole and len(whole) > 500
