"""Quality classifier from weak labels.

Eight heuristic labellers vote good, bad or nothing on every document (capitals, symbols, repeats, cell
separators, sentence ends, length, word length, digits). Expectation-maximisation over the counts of vote
patterns (at most 3**8, aggregated by Spark over all documents) estimates each labeller's accuracy and the share of
good documents, and gives every pattern a posterior. The posteriors are the labels of a linear scorer
over hashed features of the words (their character shape; short words themselves; of words longer than ``LONG``,
as texts without white space are, all 3-grams of the shape), fitted by gradient
descent on a bounded sample of ``TRAIN_ROWS`` documents: of all different pairs of key and text, those
of the smallest hashes.
Statistics, votes, posteriors and scores cover all documents and whole texts.

Defined results: a text without words (null, empty) gets bad votes from all and score 0; repeated rows get
the same result; with fewer than two vote patterns the posterior is the scorer's prior.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import held, sliced, stored, table

BUCKETS = 1 << 12
PSEUDO = (50.0, 5.0)  # imagined votes per labeller: in the good class, in each class of a fault
TRAIN_ROWS = 10_000  # documents the scorer is fitted on, at most
EPOCHS = 200
FEW = 8  # texts of fewer words get no votes
WORDS = 300_000  # words a worker remembers
LONG = 32  # longer words have features of their n-grams
GRAMS = 2_000_000  # buckets of long words a worker remembers
SEED = 7
LABELLERS = ("capitals", "symbols", "repeats", "separators", "sentences", "length", "word_length", "digits")


def shape(word: str) -> str:
    """Character classes of a word, runs as one: ``X`` capitals, ``x`` letters, ``9`` digits, else the character."""
    out: list[str] = []
    for c in word:
        k = "x" if c.isalpha() and not c.isupper() else "X" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def _grams(form: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of all 3-grams of a shape between boundary marks."""
    form = f"\0{form}\0"
    each = Counter(form[k:k + 3] for k in range(len(form) - 2))
    at = np.fromiter((zlib.crc32(b"g " + g.encode("utf-8", "replace")) % BUCKETS for g in each), np.int64, len(each))
    counts = np.bincount(at, np.fromiter(each.values(), np.int64, len(each)), BUCKETS).astype(np.int64)
    used = np.flatnonzero(counts)
    return used, counts[used]


class Words:
    """Numbers of words with their statistics and features, bounded memory."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.stats = np.zeros((1024, 7))  # characters, letters, capitals, digits, symbols, separator, sentence end
        self.slots = np.zeros((1024, 2), dtype=np.int64)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of long words: buckets and counts
        self.held = 0

    def numbers(self, docs: list[list[str]]) -> list[np.ndarray]:
        new = set().union(*docs).difference(self.number) if docs else set()
        if (len(self.number) + len(new) > WORDS or self.held > GRAMS) and self.number:
            self.number.clear()
            self.grams.clear()
            self.held = 0
            new = set().union(*docs)
        need = len(self.number) + len(new)
        if need > len(self.stats):
            size = max(need, 2 * len(self.stats)) - len(self.stats)
            self.stats = np.concatenate([self.stats, np.zeros((size, 7))])
            self.slots = np.concatenate([self.slots, np.zeros((size, 2), np.int64)])
        for w in new:
            k = self.number[w] = len(self.number)
            letters = sum(map(str.isalpha, w))
            digits = sum(map(str.isdigit, w))
            self.stats[k] = (len(w), letters, sum(map(str.isupper, w)), digits, len(w) - letters - digits,
                             w in ("|", ",", ";", "\t"), w[-1] in ".!?…。！？" and w[0].isalpha())
            form = shape(w)
            if len(w) > LONG:
                self.slots[k] = -1
                self.grams[k] = _grams(form)
                self.held += len(self.grams[k][0])
                continue
            self.slots[k, 0] = zlib.crc32(form.encode("utf-8", "replace")) % BUCKETS
            self.slots[k, 1] = zlib.crc32(b"w " + w.lower().encode("utf-8", "replace")) % BUCKETS if len(w) < 4 else -1
        get = self.number.__getitem__
        return [np.fromiter(map(get, d), dtype=np.int64, count=len(d)) for d in docs]

    def features(self, words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(votes, buckets, values) of a document: votes are 1 good, -1 bad, 0 none."""
        n = len(words)
        if not n:
            return [-1] * len(LABELLERS), np.zeros(0, np.int32), np.zeros(0, np.float32)
        chars, letters, capitals, digits, symbols, cells, ends = self.stats[words].sum(0)
        repeated = float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0

        def vote(x: float, good: float, bad: float) -> int:  # small is good
            return 1 if x <= good else -1 if x >= bad else 0

        votes = [vote(capitals / max(letters, 1), 0.15, 0.35), vote(symbols / chars, 0.08, 0.16), vote(repeated, 0.03, 0.15),
                 vote(cells / n, 0.005, 0.05), vote(-ends / n, -0.02, -0.005) if n >= 20 else 0,
                 int(n >= 20), vote(abs(chars / n - 6.5), 3.5, 8.0), vote(digits / chars, 0.05, 0.5)]
        if n < FEW:  # too short for shares
            votes = [0] * len(votes)
        both = self.slots[words].ravel()
        counts = np.bincount(both[both >= 0], minlength=BUCKETS)
        for k in words[self.slots[words, 0] < 0].tolist():
            at, c = self.grams[k]
            counts[at] += c
        used = np.flatnonzero(counts)
        values = np.log1p(counts[used] * (100.0 / n))
        return votes, used.astype(np.int32), (values / np.linalg.norm(values)).astype(np.float32)


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (all columns but the text), ``h`` (hash of key and text, the sampling order), ``votes``, ``at``, ``x``."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("row"),
                       F.xxhash64(F.lit(SEED), F.col(f"`{key}`"), F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("t"))
    schema = rows.select("row", "h", F.array().cast("array<int>").alias("votes"), F.lit(b"").alias("at"), F.lit(b"").alias("x")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held("quality", Words)
        for b in sliced(batches, "t", 500):
            found = [words.features(d) for d in words.numbers([t.split() if t else [] for t in b.column("t").to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("h"), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1].tobytes() for f in found], pa.binary()), pa.array([f[2].tobytes() for f in found], pa.binary())],
                names=["row", "h", "votes", "at", "x"])

    return rows.mapInArrow(run, schema)


def label_model(votes: np.ndarray, n: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over vote patterns (rows, with counts ``n``): accuracies (labeller, [good, bad]) of a vote, the share of
    good documents and the posterior of each pattern.

    A heuristic is written for one kind of fault, which the others do not see. So the hidden class of a
    document is good, or bad by the fault of one labeller; each class has its own rate of bad votes per
    labeller, and all rates and shares are estimated. The start and a fixed number of imagined votes keep the classes
    what they are named after (a labeller is mostly silent on good text and mostly right on its own fault): against
    more documents than PSEUDO they count for nothing."""
    k = votes.shape[1]
    good, bad = (votes == 1).astype(float), (votes == -1).astype(float)
    prior = np.full((k + 1, k), 0.02)
    prior[0] = 0.005
    prior[np.arange(1, k + 1), np.arange(k)] = 0.9
    total = n.sum()
    strength = np.array([PSEUDO[0]] + [PSEUDO[1]] * k)[:, None]
    faults = bad.sum(1)
    p = np.concatenate([np.where(faults == 0, 0.95, 0.1)[:, None],
                        np.where(faults[:, None] > 0, 0.9 * bad / np.maximum(faults, 1)[:, None], 0.05 / k)], axis=1)
    share, rate = np.full(k + 1, 1 / (k + 1)), prior
    for _ in range(rounds):
        w = n[:, None] * p
        share = (w.sum(0) + 1e-3) / (total + 1e-3 * (k + 1))
        rate = (w.T @ bad + strength * prior) / (w.T @ (good + bad) + strength)
        log = np.log(share) + bad @ np.log(rate.T) + good @ np.log(1 - rate.T)
        now = np.exp(log - log.max(1, keepdims=True))
        now /= now.sum(1, keepdims=True)
        if np.abs(now - p).max() < 1e-9:
            break
        p = now
    return np.stack([1 - rate[0], rate[np.arange(1, k + 1), np.arange(k)]], axis=1), float(share[0]), p[:, 0]


def fit_scorer(at: list[np.ndarray], x: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Logistic regression by full-batch gradient descent with momentum; the last weight is the bias."""
    rows = np.repeat(np.arange(len(at)), [len(a) for a in at])
    cols = np.concatenate(at) if len(at) else np.zeros(0, np.int64)
    vals = np.concatenate(x).astype(np.float64) if len(x) else np.zeros(0)
    w, speed = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for _ in range(EPOCHS if len(at) else 0):
        p = 1 / (1 + np.exp(-(np.bincount(rows, vals * w[cols], minlength=len(at)) + w[-1])))
        d = (p - target) / len(at)
        grad = np.append(np.bincount(cols, vals * d[rows], minlength=BUCKETS), d.sum()) + 1e-5 * w
        speed = 0.9 * speed - 5.0 * grad
        w += speed
    return w


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` plus ``votes``, ``posterior`` (label model), ``score`` (linear scorer, 0 to 1) and ``keep``."""
    spark = docs.sparkSession
    found = stored(features(docs, key, text), "quality-features")
    patterns = found.groupBy("votes").count().toPandas()
    votes = np.array(patterns["votes"].tolist(), dtype=np.int64).reshape(len(patterns), len(LABELLERS))
    _, _, posterior = label_model(votes, patterns["count"].to_numpy(dtype=np.float64)) if len(patterns) else (0, 0, np.zeros(0))
    labels = spark.createDataFrame(pd.DataFrame({"votes": [v.tolist() for v in votes], "posterior": posterior.tolist()}),
                                   "votes array<int>, posterior double") if len(patterns) else spark.createDataFrame(
        [], "votes array<int>, posterior double")
    # The smallest hashes. Hashes of different pairs of key and text are spread evenly, so a threshold leaves about
    # TRAIN_ROWS of them, of which the driver takes TRAIN_ROWS at most; repeated rows and null keys change nothing.
    total = found.select("h").distinct().count()
    cut = min((1 << 63) - 1, int((min(1.0, TRAIN_ROWS / max(total, 1)) - 0.5) * (1 << 64)))
    sample = found.where(F.col("h") <= cut).select("h", "votes", "at", "x").dropDuplicates(["h"]).orderBy("h").limit(TRAIN_ROWS).collect()
    by = {tuple(v.tolist()): float(p) for v, p in zip(votes, posterior, strict=True)}
    weights = spark.sparkContext.broadcast(fit_scorer(
        [np.frombuffer(r["at"], np.int32).astype(np.int64) for r in sample], [np.frombuffer(r["x"], np.float32) for r in sample],
        np.array([by[tuple(r["votes"])] for r in sample])))
    joined = found.join(F.broadcast(labels), "votes")  # at most 3 ** 8 rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for b in batches:
            z = [float(w[np.frombuffer(a, np.int32)] @ np.frombuffer(x, np.float32)) if a else None
                 for a, x in zip(b.column("at").to_pylist(), b.column("x").to_pylist(), strict=True)]
            score = [0.0 if v is None else float(1 / (1 + np.exp(-v - w[-1]))) for v in z]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("votes"), b.column("posterior"),
                                              pa.array(score, pa.float64())], names=["row", "votes", "posterior", "score"])

    scored = joined.select("row", "votes", "posterior", "at", "x").mapInArrow(
        run, joined.select("row", "votes", "posterior", F.lit(0.0).alias("score")).schema)
    return scored.select("*", (F.col("score") >= 0.5).alias("keep"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents", "doc_id", "text")).select("row.doc_id", "posterior", "score", "keep")
