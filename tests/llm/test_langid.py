import itertools

import numpy as np

from tripcraft.llm import langid
from tripcraft.llm.common import table


def test_held_out_accuracy(spark, sf01):
    truth = {r.doc_id: r.lang for r in table(spark, sf01, "documents", "doc_id", "lang").collect()}
    got = langid.op10_langid(spark, sf01).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert 0.1 < len(held) / len(got) < 0.3
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_paths_are_optimal():
    """The shortcut and the dynamic programme against all label sequences."""
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b", "c"], np.ones((3, langid.BUCKETS + len(langid.SCRIPTS))))
    labeller = langid.Labeller(model)
    for n in (1, 2, 3, 5, 6):
        for scale in (1, 8, 20):
            labeller.scores = rng.normal(0, scale, (8, 3)).astype(np.float32)
            words = rng.integers(0, 8, n)
            path = labeller.paths([words])[0]
            path = [path] * n if isinstance(path, int) else path.tolist()

            def value(p, words=words):
                return sum(float(labeller.scores[w, k]) for w, k in zip(words, p, strict=True)) - langid.PENALTY * sum(
                    x != y for x, y in zip(p, p[1:], strict=False))

            assert abs(value(path) - max(map(value, itertools.product(range(3), repeat=n)))) < 1e-4


def test_spans_scripts_and_edges(spark):
    rows = [(k, t, g) for k, (t, g) in enumerate([("the cat and the dog sat with that hat", "en"), ("der hund und die katze sind nicht da", "de"),
            ("это русский текст и слова", "ru")] * 30)]
    model = langid.learn(spark.createDataFrame([*rows, (None, None, "xx"), (None, "zzz", None)], "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en", "ru"]
    labeller = langid.Labeller(model)
    text = "the cat and the dog and the hat. der hund und die katze und nicht! это слова и текст"
    assert [s[2] for s in labeller.spans(text)] == ["en", "de", "ru"]
    got = labeller.languages([None, "", "123 !?", "это", "the dog", "²"])
    assert [x[0] for x in got] == ["und", "und", "und", "ru", "en", "und"] and got[0][1] == 0.0
    docs = spark.createDataFrame([(None, None, None, 1, 2), (1, "the dog and the cat", "en", 3, 4)],
                                 "doc_id long, text string, lang string, row int, score int")
    out = langid.identify(docs, model, spans=True)
    assert sorted(r.lang_pred for r in out.collect()) == ["en", "und"]
    empty = langid.learn(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_null_keys_are_not_learned_from(spark):
    rows = [(None, "only here", "xx"), *((k, "the dog and the cat", "en") for k in range(20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.learn(docs.where(langid.learnable("doc_id"))).langs == ["en"]
    assert docs.where(langid.learnable("doc_id")).count() + docs.where(langid.held_out("doc_id")).count() == 20


def test_model_in_blocks_gives_the_same(spark, sf01, monkeypatch):
    """Counts read in blocks of languages from the shared folder against the array: word scores, labels and shares."""
    docs = table(spark, sf01, "documents", "doc_id", "text", "lang")
    dense = langid.learn(docs)
    monkeypatch.setattr(langid, "DENSE_LANGUAGES", 1)
    monkeypatch.setattr(langid, "BLOCK_COUNTS", 5000)
    wide = langid.learn(docs)
    assert isinstance(dense, langid.Model) and isinstance(wide, langid.WideModel) and wide.langs == dense.langs and len(wide.first) > 1
    words = sorted({w for r in docs.limit(50).collect() for w in langid._WORD.findall(r.text)} | {"это", "ελλην", "x"})
    for step in (langid.STEP, 64):
        monkeypatch.setattr(langid, "STEP", step)
        assert np.abs(wide.score(words) - dense.score(words)).max() < 1e-3
    one, two = ({r.row.doc_id: (r.lang_pred, round(r.score, 9)) for r in langid.identify(docs, m).collect()} for m in (dense, wide))
    assert one == two


def test_thousands_of_labels(spark):
    """Dirty labels beside real ones: no limit, every label takes part, the real languages are still found."""
    rows = [("the cat and the dog sat with that hat and this", "en"), ("der hund und die katze sind nicht da und ich", "de")] * 300
    rows += [(f"zq{k:x}vv", f"label {k}") for k in range(3000)]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.langs) == 3002 and len(model.uses) == 3002
    docs = spark.createDataFrame([(1, "the dog and the cat"), (2, "die katze und der hund"), (3, "zqabcvv"), (4, None),
                                  (5, "the dog and the cat " * 20000 + "und die katze ist nicht der hund " * 5000)], "doc_id long, text string")
    got = {r.row.doc_id: r for r in langid.identify(docs, model, spans=True).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[4].lang_pred) == ("en", "de", "und")
    assert got[3].lang_pred == f"label {0xabc}"
    assert got[5].lang_pred == "en" and 0.5 < got[5].score < 1 and {s.lang for s in got[5].spans} == {"en", "de"}


def test_memory_and_steps_change_no_path(monkeypatch):
    """Paths of long documents whatever is held at once, against the plain programme."""
    rng = np.random.default_rng(5)
    labeller = langid.Labeller(langid.Model(["a", "b", "c"], np.ones((3, langid.BUCKETS + len(langid.SCRIPTS)))))
    labeller.scores = rng.normal(0, 6, (50, 3)).astype(np.float32)
    docs = [rng.integers(0, 50, n) for n in (400, 1, 37, 400, 0)]

    def plain(words):
        best, back = labeller.scores[words[0]].astype(float), []
        for w in words[1:]:
            top = int(best.argmax())
            moved = best[top] - langid.PENALTY > best
            back.append([top if m else k for k, m in enumerate(moved)])
            best = np.maximum(best, best[top] - langid.PENALTY) + labeller.scores[w]
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(b[path[-1]])
        return path[::-1]

    for step in (langid.STEP, 7):
        monkeypatch.setattr(langid, "STEP", step)
        for d, p in zip(docs[:4], labeller.paths(docs)[:4], strict=True):
            assert ([p] * len(d) if isinstance(p, int) else p.tolist()) == plain(d)


def test_text_goes_to_the_workers_once(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", "x"), (2, None, None, "y")], "doc_id long, text string, lang string, t string")
    out = langid.identify(docs, langid.learn(docs))
    assert " AS t#" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.row.doc_id, r.row.t, r.lang_pred, r.score) for r in out.collect()) == [(1, "x", "en", 1.0), (2, "y", "und", 0.0)]
