"""Language identification: script ranges narrow the candidates of a word, Viterbi labels the words.

Learning (``learn``): Spark counts, over all texts of the training rows, the hashed character n-grams
(1 to 3 characters of the lower-cased word between boundary marks) and the letters per script of each
language. Up to DENSE_LANGUAGES languages the model is one array of log probabilities that is broadcast. Beyond that
(a column of dirty labels) the counts stay in the shared folder as a table in blocks of languages with about BLOCK_COUNTS
counts each; only totals and scripts per language go through the driver, and a worker reads one block at a time to
score its new words. All languages take part in every score and path.

Labelling: a word (maximal run of letters) scores the sum of its n-grams' log probabilities per language;
languages that never used the word's script are out. Viterbi over the words with a switching penalty
gives spans of one language each; it keeps, per word, the language a switch would come from and where that
language's span began, so its memory is words plus languages. A document's language is the one with most letters in its spans (ties:
the first in the order of the language codes), its score their share of all letters.

A constant path is taken at once where it is provably optimal: if no interval of words prefers another
language to the best one by more than half the penalty, no switch can pay. All other documents go through
the dynamic programme, a whole batch of documents per step.

Defined results: null or empty text, or text without letters, gives ``und`` with score 0; so does every text
if nothing could be learned; a null key counts as held out from learning; rows with null language teach nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import held, shared_path, sliced, stored, table

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
PENALTY = 12.0  # nats per change of language
UNSEEN = 0.01  # probability mass spread over all buckets
SCRIPT_SHARE = 1e-4  # a language uses a script if it holds this share of its letters
MIN_SCORE = 0.5  # the filter rejects below this
DENSE_LANGUAGES = 256  # up to this number the model is one array in memory (64 MB), above it is read in blocks
BLOCK_COUNTS = 1 << 22  # n-gram counts per block
WORDS = 300_000  # words a worker remembers
CELLS = 1 << 25  # scores (words x languages) a worker remembers
STEP = 1 << 22  # scores held at once while a path is looked for
CHARS = 1 << 21  # characters of text cut to words at once
COUNTED = 200_000  # distinct words counted, over all languages, before they are turned into n-gram counts
FOLDS = 5
_WORD = re.compile(r"[^\W\d_]+")
# First code points of script blocks (Unicode block chart) and the script from there on.
_SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
            (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
            (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
            (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
            (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
            (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
            (0x2000, "latin"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
            (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
            (0xFB50, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"),
            (0x20000, "han"), (0x323B0, "other")]
_FIRST = np.array([c for c, _ in _SCRIPTS])
SCRIPTS = sorted({s for _, s in _SCRIPTS})
_NUMBER = np.array([SCRIPTS.index(s) for _, s in _SCRIPTS])


def scripts(last: np.ndarray) -> np.ndarray:
    """Script numbers of words by the code points of their last letters (a CJK word may start with another)."""
    return _NUMBER[np.searchsorted(_FIRST, last, side="right") - 1]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words at once: the buckets of their n-grams, where each word's begin, and the script numbers.

    The words stand in one string with U+0000 as boundary mark; a window of 1 to 3 characters is an n-gram
    unless it is a mark alone or has one in the middle."""
    text = ("\0" + "\0".join(words) + "\0").lower()
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    mark = c == 0
    follow = np.concatenate([c[1:], [np.uint64(0)]])
    then = np.concatenate([c[2:], [np.uint64(0)] * 2])[:len(c)]
    inner, n = ~mark, len(c)
    windows = []
    for size, (x, ok) in enumerate([(c, inner), (c * np.uint64(0x110000) + follow, inner | np.append(inner[1:], False)),
                                    ((c * np.uint64(0x110000) + follow) * np.uint64(0x110000) + then, np.append(inner[1:], False))]):
        x = (x + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)  # multiplicative hash, the top bits are the bucket
        at = np.flatnonzero(ok & (np.arange(n) < n - size))
        windows.append((at, (x[at] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)))
    at = np.concatenate([w[0] for w in windows])
    order = np.argsort(at, kind="stable")
    starts = np.flatnonzero(mark)
    return (np.concatenate([w[1] for w in windows])[order], np.searchsorted(at[order], starts[:-1]),
            scripts(c[starts[1:] - 1].astype(np.int64)))


def _letters(word: str) -> int:
    return sum(map(str.isalpha, word)) if not word.isalpha() else len(word)


def held_out(key: str):
    """Rows that are never learned from: crc32 of the key as text is a multiple of FOLDS."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(False))


def learnable(key: str):
    """Rows that may be learned from: those whose remainder is known and not 0. A null key is neither held out nor learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS != 0, F.lit(False))


def counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, slot, n) over all rows: n-gram counts in slots below BUCKETS, then letters by script."""
    pairs = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("t")).where("lang is not null and t is not null")
    arrow = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("language counts", dict)  # drops what the worker remembers for another operator
        sums: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def fold(lang: str) -> None:
            slots = sums.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), dtype=np.int64))
            counted = words.pop(lang)
            if not counted:
                return
            at, starts, script = grams(list(counted))
            n = np.fromiter(counted.values(), dtype=np.int64)
            each = np.repeat(n, np.diff(np.append(starts, len(at))))
            slots[:BUCKETS] += np.bincount(at, each, minlength=BUCKETS).astype(np.int64)
            letters = n * np.fromiter(map(_letters, counted), dtype=np.int64)
            slots[BUCKETS:] += np.bincount(script, letters, minlength=len(SCRIPTS)).astype(np.int64)

        for b in sliced(batches, "t", 100):
            for lang, t in zip(b.column("lang").to_pylist(), b.column("t").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(_WORD.findall(t))
            if sum(map(len, words.values())) > COUNTED:
                for lang in list(words):
                    fold(lang)
        for lang in list(words):
            fold(lang)
        for lang, slots in sums.items():
            used = np.flatnonzero(slots)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used, pa.int32()),
                                              pa.array(slots[used])], schema=arrow)

    return pairs.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities per (bucket, language) and the scripts each language uses."""

    def __init__(self, langs: list[str], slots: np.ndarray):
        self.langs = langs
        c, letters = slots[:, :BUCKETS].astype(np.float64), slots[:, BUCKETS:].astype(np.float64)
        share = c / np.maximum(c.sum(1, keepdims=True), 1)
        self.log = np.log((1 - UNSEEN) * share + UNSEEN / BUCKETS).T.astype(np.float32)
        self.uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(1, keepdims=True), 1)
        self.token = zlib.crc32(self.log.tobytes())

    def score(self, words: list[str]) -> np.ndarray:
        """(word, language) scores; a language that never used the word's script is out."""
        at, starts, script = grams(words)
        total = np.stack([np.add.reduceat(self.log[:, k][at], starts) for k in range(len(self.langs))], axis=1)
        can = self.uses.T[script]
        return np.where(can | ~can.any(1, keepdims=True), total, -1e4)


class WideModel:
    """The same scores for any number of languages, from a table (block, lang, slot, n) of counts in the shared folder.

    A bucket a language never saw has the same log probability in all languages. A block adds what the others have
    above it, so only counts that are there are touched."""

    def __init__(self, langs: list[str], totals: np.ndarray, letters: np.ndarray, first: list[int], uri: str):
        self.langs, self.first, self.uri = langs, first, uri  # ``first``: number of each block's first language
        self.totals = np.maximum(totals, 1).astype(np.float64)
        self.uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(1, keepdims=True), 1)
        self.token = zlib.crc32(uri.encode())
        self.held: tuple[int, tuple] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "held": None}

    def _block(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of block ``k``, by bucket: where its entries begin, their languages (numbers in the block) and gains."""
        if self.held is None or self.held[0] != k:
            import pyarrow.parquet as pq  # only here: not every worker needs the file readers

            from tripcraft.llm.tokens import open_uri
            fs, path = open_uri(f"{self.uri}/block={k}")
            t = pq.read_table(path, filesystem=fs, columns=["number", "slot", "n"], partitioning=None)
            slot, number = t["slot"].to_numpy(), t["number"].to_numpy()
            order = np.argsort(slot, kind="stable")
            share = t["n"].to_numpy()[order] / self.totals[number[order]]
            gain = np.log((1 - UNSEEN) * share + UNSEEN / BUCKETS) - np.log(UNSEEN / BUCKETS)
            self.held = (k, (np.searchsorted(slot[order], np.arange(BUCKETS + 1)), number[order] - self.first[k], gain))
        return self.held[1]

    def score(self, words: list[str]) -> np.ndarray:
        at, starts, script = grams(words)
        sizes = np.diff(np.append(starts, len(at)))
        total = np.empty((len(words), len(self.langs)), dtype=np.float32)
        ends = [*self.first[1:], len(self.langs)]
        for k, (low, high) in enumerate(zip(self.first, ends, strict=True)):
            begin, number, gain = self._block(k)
            count = begin[at + 1] - begin[at]  # entries of each n-gram
            upto = np.concatenate([[0], np.cumsum(np.add.reduceat(count, starts) + (high - low))])
            w = 0
            while w < len(words):  # words with about STEP entries and cells at once
                v = max(w + 1, int(np.searchsorted(upto, upto[w] + STEP, side="right")) - 1)
                g = slice(starts[w], starts[v] if v < len(words) else len(at))
                word, n = np.repeat(np.arange(v - w), sizes[w:v]), count[g]
                entry = np.arange(n.sum()) + np.repeat(begin[at[g]] - (np.cumsum(n) - n), n)
                cell = np.repeat(word, n) * (high - low) + number[entry]
                total[w:v, low:high] = np.bincount(cell, gain[entry], minlength=(v - w) * (high - low)).reshape(v - w, high - low)
                w = v
        total += (sizes * np.log(UNSEEN / BUCKETS))[:, None].astype(np.float32)
        can = self.uses.T[script]
        total[~can & can.any(1, keepdims=True)] = -1e4
        return total


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | WideModel:
    """Fit on all rows of ``docs``. The driver gets a row per language and script; the counts only up to DENSE_LANGUAGES."""
    table = stored(counts(docs, text, lang), "language-counts")
    sums = table.groupBy("lang").agg(F.sum(F.when(F.col("slot") < BUCKETS, F.col("n"))).alias("total"),
                                     F.count(F.when(F.col("slot") < BUCKETS, 1)).alias("entries"),
                                     F.map_from_entries(F.collect_list(F.when(F.col("slot") >= BUCKETS, F.struct(
                                         F.col("slot") - BUCKETS, "n")))).alias("letters"))
    rows = sorted(sums.toLocalIterator(), key=lambda r: r.lang)
    langs = [r.lang for r in rows]
    if len(langs) > DENSE_LANGUAGES:
        return _wide(table, rows)
    slots = np.zeros((len(langs), BUCKETS + len(SCRIPTS)), dtype=np.int64)
    at = {x: k for k, x in enumerate(langs)}
    for r in table.toLocalIterator():
        slots[at[r.lang], r.slot] = r.n
    return Model(langs, slots)


def _wide(table: DataFrame, rows: list) -> WideModel:
    spark = table.sparkSession
    letters = np.zeros((len(rows), len(SCRIPTS)), dtype=np.float64)
    first, entries = [], BLOCK_COUNTS
    names = []
    for k, r in enumerate(rows):
        if entries + (r.entries or 0) > BLOCK_COUNTS:
            first.append(k)
            entries = 0
        entries += r.entries or 0
        names.append((r.lang, k, len(first) - 1))
        for script, n in r.letters.items():
            letters[k, script] = n
    numbers = spark.createDataFrame(names, "lang string, number int, block int")
    uri = shared_path(spark, "language-model")
    table.where(F.col("slot") < BUCKETS).join(numbers, "lang").select("block", "number", "slot", "n").repartition(
        "block").write.partitionBy("block").parquet(uri)
    return WideModel([r.lang for r in rows], np.array([r.total or 0 for r in rows], dtype=np.float64), letters, first, uri)


class Labeller:
    """Word scores of a model with a bounded memory, and the paths through them."""

    def __init__(self, model: Model | WideModel):
        self.model = model
        self.words = min(WORDS, CELLS // max(len(model.langs), 1))
        self.number: dict[str, int] = {}
        self.scores = np.zeros((1024, len(model.langs)), dtype=np.float32)
        self.letters = np.zeros(1024, dtype=np.int64)

    def numbers(self, docs: list[list[str]]) -> list[np.ndarray]:
        new = set().union(*docs).difference(self.number) if docs else set()
        if len(self.number) + len(new) > self.words and self.number:
            self.number.clear()
            self.scores, self.letters = self.scores[:self.words], self.letters[:self.words]
            new = set().union(*docs)
        need = len(self.number) + len(new)
        if need > len(self.letters):
            size = max(need, 2 * len(self.letters))
            self.scores = np.concatenate([self.scores, np.zeros((size - len(self.scores), self.scores.shape[1]), np.float32)])
            self.letters = np.concatenate([self.letters, np.zeros(size - len(self.letters), np.int64)])
        if new:
            words, first = list(new), len(self.number)
            self.number.update(zip(words, range(first, need), strict=True))
            self.letters[first:need] = np.fromiter(map(_letters, words), dtype=np.int64, count=len(words))
            if self.model.langs:
                self.scores[first:need] = np.where(self.letters[first:need, None] > 0, self.model.score(words), 0)
        get = self.number.__getitem__
        return [np.fromiter(map(get, d), dtype=np.int64, count=len(d)) for d in docs]

    def paths(self, docs: list[np.ndarray]) -> list[np.ndarray | int]:
        """Language number of each word, or one number where all words have it."""
        out: list[np.ndarray | int] = [0] * len(docs)
        hard: list[int] = []
        for k, words in enumerate(docs):
            if not len(words) or not self.model.langs:
                continue
            best = self._constant(words)
            if best is None:
                hard.append(k)
            else:
                out[k] = best
        for k, path in zip(hard, self._viterbi([docs[k] for k in hard]), strict=True):
            out[k] = path
        return out

    def _constant(self, words: np.ndarray) -> int | None:
        """The language of the path without a switch if no switch can pay, else None."""
        step = max(1, STEP // self.scores.shape[1])
        parts = range(0, len(words), step)
        best = int(sum(self.scores[words[a:a + step]].sum(0, dtype=np.float64) for a in parts).argmax())
        before, lowest = np.zeros(self.scores.shape[1]), np.zeros(self.scores.shape[1])
        for a in parts:
            s = self.scores[words[a:a + step]].astype(np.float64)
            gain = np.cumsum(s - s[:, best:best + 1], axis=0) + before
            low = np.minimum.accumulate(np.concatenate([np.minimum(lowest, before)[None], gain[:-1]]), axis=0)
            if (gain - low).max() > PENALTY / 2:
                return None
            before, lowest = gain[-1], low[-1]
        return best

    def _viterbi(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        """All documents step by step, the longest first. A span that begins at word t has the language ``source[t]``
        before it, whose own span began at ``since[t]``."""
        if not docs:
            return []
        order = np.argsort([-len(d) for d in docs], kind="stable")
        lengths = np.array([len(docs[k]) for k in order])
        starts = np.cumsum(lengths) - lengths
        flat = np.concatenate([docs[k] for k in order])
        source = np.zeros(len(flat), dtype=np.int32)
        since = np.zeros(len(flat), dtype=np.int64)
        best = self.scores[flat[starts]].astype(np.float64)
        began = np.zeros(best.shape, dtype=np.int64)
        for t in range(1, int(lengths[0])):
            live = int(np.searchsorted(-lengths, -t, side="left"))  # documents longer than t
            at = starts[:live] + t
            now, rows = best[:live], np.arange(live)
            top = now.argmax(1)
            jump = now[rows, top][:, None] - PENALTY
            source[at], since[at] = top, began[rows, top]
            began[:live][jump > now] = t
            best[:live] = np.maximum(now, jump) + self.scores[flat[at]]
        state = best.argmax(1)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(docs)
        for d, (k, a, n) in enumerate(zip(order.tolist(), starts.tolist(), lengths.tolist(), strict=True)):
            label, now, end = np.empty(n, dtype=np.int32), int(state[d]), n
            start = int(began[d, now])
            while True:
                label[start:end] = now
                if start == 0:
                    break
                now, start, end = int(source[a + start]), int(since[a + start]), start
            out[k] = label
        return out

    def languages(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, share of letters) of each text. A long text, or as many as have CHARS characters, are taken at once,
        fewer where the languages are so many that their words' scores would not fit."""
        most = min(CHARS, CELLS // max(len(self.model.langs), 1))
        out: list[tuple[str, float]] = []
        upto = np.cumsum([len(t or "") for t in texts])
        while len(out) < len(texts):
            at = len(out)
            before = int(upto[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + most, side="right")))
            out += self._languages([_WORD.findall(t) if t else [] for t in texts[at:end]])
        return out

    def _languages(self, found: list[list[str]]) -> list[tuple[str, float]]:
        docs = self.numbers(found)
        out = []
        for words, path in zip(docs, self.paths(docs), strict=True):
            letters = self.letters[words]
            total = int(letters.sum())
            if not total or not self.model.langs:
                out.append(("und", 0.0))
            elif isinstance(path, int):
                out.append((self.model.langs[path], 1.0))
            else:
                by = np.bincount(path, letters, minlength=len(self.model.langs))
                out.append((self.model.langs[int(by.argmax())], float(by.max() / total)))
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, language) of each span, in code points; a span runs from its first to its last word."""
        found = list(_WORD.finditer(text or ""))
        docs = self.numbers([[m.group() for m in found]])
        if not found or not self.model.langs:
            return []
        path = self.paths(docs)[0]
        labels = np.full(len(found), path) if isinstance(path, int) else path
        cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(found)]
        return [(found[a].start(), found[b - 1].end(), self.model.langs[int(labels[a])])
                for a, b in zip(cuts, cuts[1:], strict=False)]


def identify(docs: DataFrame, model: Model | WideModel, text: str = "text", spans: bool = False) -> DataFrame:
    """``docs`` as a column ``row`` plus ``lang_pred``, ``score`` and, if asked, ``spans`` (start, end, lang)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    at = docs.columns.index(text)  # the text goes to the workers once, inside its row
    kind = "array<struct<start:int,end:int,lang:string>>"
    schema = rows.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"),
                         *([F.array().cast(kind).alias("spans")] if spans else [])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labeller = held(("language", model.token, tuple(model.langs)), lambda: Labeller(model))
        for b in sliced(batches, "row", 1000):
            texts = b.column("row").field(at).to_pylist()
            found = labeller.languages(texts)
            columns = [b.column("row"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            if spans:
                columns.append(pa.array([[dict(zip(("start", "end", "lang"), s, strict=True)) for s in labeller.spans(t)]
                                         for t in texts], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "lang_pred", "score", *(["spans"] if spans else [])])

    return rows.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is known: a learned language holds MIN_SCORE of the letters or more."""
    model = learn(docs.where(learnable(key)), text, lang)
    found = identify(docs, model, text)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select("row.*")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = learn(docs.where(learnable("doc_id")).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
