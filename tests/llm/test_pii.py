import hashlib
import random
import re

from tripcraft.llm import pii
from tripcraft.llm.common import table

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_base_spans(spark):
    rng = random.Random(5)
    parts = ["1", "22", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "+1 (202) 555-2281", "+", "1.2.3.4",
             "999.1.1.1", "256.0.0.1", ".", "@", "a@b.co", "_x", "%", "-", " ", "  ", "é", "🙂", "word", "\n", "0000255.1.2.3", "(", ")"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)]
    texts += [None, "", "1 " * 20000, "a" * 20000, "1.2.3.4 " * 1000, "1" * 30000, "a@" * 10000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.spans(df).select("row.doc_id", *pii.KINDS).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [(k, s.start, s.end) for k in pii.KINDS for s in r[k]] == brute(texts[r.doc_id]), texts[r.doc_id][:80]


def test_query(spark, sf001):
    texts = {r.doc_id: r.text for r in table(spark, sf001, "documents", "doc_id", "text").collect()}
    got = pii.op6_pii(spark, sf001).collect()
    assert len(got) == len(texts)
    for r in got:
        base = [f"{k}:{a}:{b}" for k, a, b in brute(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x.startswith(k) for x in base) for k in pii.KINDS)
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_contexts_find_unseen_identifiers(spark):
    texts = [f"the customer id: user{k}@mail.example.com ok" for k in range(150)]  # seeds of the pattern "id: "
    texts += [f"write to customer id: QX-{k:05d} now" for k in range(12)]  # unseen shape, same context
    texts += [f"passport no. QX-{k:05d} seen" for k in range(12)] + ["passport no. ZZ-99999 seen"]  # next round
    texts += [f"room number 1234{k} is free" for k in range(30)]  # a context without seeds
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, rid int")
    got = {r.row.doc_id: r.discovered for r in pii.personal_data(df).collect()}
    for k, t in enumerate(texts):
        token = re.search(r"QX-\d+|ZZ-\d+", t)
        assert [(s.kind, s.start, s.end) for s in got[k]] == ([("email", *token.span())] if token else []), t
    assert pii.personal_data(df.limit(0)).count() == 0


def test_sentence_ends_and_series(spark):
    """Punctuation after a mention makes no second instance; identifiers with spaces are candidates."""
    ends = [".", "/", "-", "%", "", ", then"]
    texts = [f"he was seen at address 10.1.{k}.3{ends[k % 6]}" for k in range(150)]  # seeds, most end a sentence
    new = ["QX-77123", "020 7946 0958", "(020) 7946-0958", "1234 5678 9012 3456", "DE12 3704 0044 0532 0130 00", "07700 900123", "node-0815"]
    texts += [f"he was seen at address {v}{ends[k % 4]}" for k, v in enumerate(new)]
    texts += ["in 12 years 1 of 3rd class", "QX-77123 and 020 7946 0958. Then node-0815-1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.row.doc_id: r for r in pii.personal_data(df).collect()}
    found = {k: [(s.kind, texts[k][s.start:s.end]) for s in r.discovered] for k, r in rows.items()}
    assert all(found[k] == [] and len(rows[k].ip) == 1 for k in range(150))
    for k, v in enumerate(new, 150):
        assert found[k] == [("ip", v)], texts[k]
    assert found[157] == [] and sorted(found[158]) == [("ip", "020 7946 0958"), ("ip", "QX-77123")]


def _discovered(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.row.doc_id: sorted((s.kind, texts[r.row.doc_id][s.start:s.end]) for s in r.discovered)
            for r in pii.personal_data(df).collect()}


def test_one_word_is_no_pattern(spark):
    """A preposition before the seeds does not make what follows it elsewhere an identifier."""
    texts = [f"the server at 10.0.0.{k} is up" for k in range(40)]
    others = ["we met at 2024-01-02 in town", "stopped at 123456 km", "at 2024-01-02", "at 123456 km", "12 at 123457"]
    got = _discovered(spark, texts + others)
    assert all(v == [] for v in got.values())


def test_a_common_shape_in_a_trusted_context_is_not_taken(spark):
    texts = [f"the server at 10.0.0.{k}" for k in range(40)] + ["the server at 2024-01-02", "the server at node-x7734"]
    texts += [f"{w} met on 2023-04-{k:02d} again" for k, w in enumerate(["we", "they", "you"], 10)]
    got = _discovered(spark, texts)
    assert got[40] == [] and got[41] == [("ip", "node-x7734")] and all(got[k] == [] for k in (42, 43, 44))


def test_right_context_and_several_kinds(spark):
    texts = [f"{w} dial +44 20 7946 0{k:03d} today" for k, w in enumerate(["please", "then", "now", "just"] * 10)]
    texts += [f"{w} mail user{k}@mail.example.com soon" for k, w in enumerate(["please", "then", "now", "just"] * 10)]
    texts += ["friends dial 020 7946 0958 today", "friends dial 020 7946 0958 times", "colleagues mail USER-0077 soon"]
    got = _discovered(spark, texts)
    assert all(got[k] == [] for k in range(80))
    assert got[80] == [("phone", "020 7946 0958")] and got[82] == [("email", "USER-0077")]


def test_ties_between_kinds_go_to_the_last_by_name(spark):
    texts = [f"first contact here {v}" for k in range(10) for v in (f"10.0.0.{k}",)]
    texts += [f"other contact there user{k}@mail.example.com" for k in range(10)]
    texts += ["first contact here KEY-4711", "other contact there KEY-4711"]
    got = _discovered(spark, texts)
    assert got[20] == got[21] == [("ip", "KEY-4711")]


def test_plan_is_native(spark, sf001):
    plan = pii.op6_pii(spark, sf001)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
