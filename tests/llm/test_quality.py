import numpy as np

from tripcraft.llm import quality


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    n, k = 20_000, 4
    fault = rng.choice(k + 1, size=n, p=[0.8, 0.05, 0.05, 0.05, 0.05])  # 0: good
    votes = np.where(rng.random((n, k)) < np.where(fault[:, None] == np.arange(1, k + 1), 0.85, 0.02), -1, 1)
    votes[rng.random((n, k)) < 0.1] = 0
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    accuracy, share, posterior = quality.label_model(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.05 and np.abs(accuracy[:, 0] - 0.98).max() < 0.02 and np.abs(accuracy[:, 1] - 0.85).max() < 0.15
    share, rate = np.array([0.8] + [0.05] * k), np.where(np.arange(k + 1)[:, None] == np.arange(1, k + 1), 0.85, 0.02)
    log = np.log(share) + (patterns == -1) @ np.log(rate.T) + (patterns == 1) @ np.log(1 - rate.T)
    best = np.exp(log[:, 0]) > 0.5 * np.exp(log).sum(1)  # what the true rates would say
    right = ((posterior[inverse.ravel()] > 0.5) == (fault == 0)).mean()
    assert right >= (best[inverse.ravel()] == (fault == 0)).mean() - 0.005


def test_prior_does_not_grow_with_the_data():
    """The same patterns a thousand times over are the same fit but for the imagined votes."""
    rng = np.random.default_rng(1)
    votes = np.where(rng.random((3000, 4)) < 0.1, -1, 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    few, many, more = (quality.label_model(patterns, counts * float(f)) for f in (1, 1000, 1_000_000))
    assert np.abs(many[0] - more[0]).max() < 1e-3 and np.abs(few[0] - more[0]).max() < 0.3


def test_against_labels(spark, sf01):
    """No label is used in the fit; the scorer has to agree with them."""
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf01}/labels.parquet").collect()}
    got = quality.op8_quality(spark, sf01).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
    seen = [(truth[r.doc_id], r.keep) for r in got if r.doc_id in truth]
    good, bad = [k for q, k in seen if q], [k for q, k in seen if not q]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_texts_without_white_space_count_in_whole():
    """What follows the first 256 characters is part of the features, and there is more than one feature."""
    start = "这是一个句子，很长的句子。" * 30
    words = quality.Words()
    found = [words.features(d) for d in words.numbers([[start], [start + "||##12;;" * 200], [start]])]
    (_, at, x), (_, at2, x2), (_, at3, x3) = found
    assert len(at) > 2 and len(at2) > len(at) and len(np.setdiff1d(at, at2)) <= 1  # the end mark
    assert np.array_equal(at, at3) and np.array_equal(x, x3) and abs(np.linalg.norm(x2) - 1) < 1e-5
    assert quality.shape("x" * 300 + "9") == "x9"


def test_sample_holds_null_and_repeated_keys(spark, monkeypatch):
    """Rows are told apart by key and text: null keys, and a row that makes up most of the table, leave a sample."""
    monkeypatch.setattr(quality, "TRAIN_ROWS", 50)
    texts = [" ".join(f"word{(k * 7 + j) % 90}" for j in range(30)) + "." for k in range(200)]
    rows = [(None, t) for t in texts] + [(5, "@@ ## !! 12 " * 20)] * 1000
    scores = [r.score for r in quality.classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(scores) == 1200 and not any(abs(s - 0.5) < 1e-6 for s in scores)


def test_edges(spark):
    rows = [(None, None, 1), (1, "", 1), (1, "", 1), (2, "one two", 1), (3, "word and then more words " * 5000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, votes int")
    got = quality.classify(df).collect()
    assert len(got) == len(rows) and sum(r.score == 0 for r in got) == 3
    assert quality.classify(df.limit(0)).count() == 0
