"""Benchmark decontamination: an FM-index per training shard, searched for the windows of all benchmark items.

Words: ASCII A-Z lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (digits, letters, all code
points from 0x80). A window is ``window`` = 10 consecutive words of an item; an item of fewer words, but
not none, is one window. A document word inside any occurrence of a window is hit.

Each task cuts its documents into shards of at most ``SHARD`` words. Words that no item uses cannot be
part of a match; they end a run, and runs shorter than the shortest window are left out of the index.
Backward search through wavelet ranks finds the row range of each window, sampled suffix positions
locate it, and the spans of a document are merged. No shuffle; a document never leaves its row.

Spark makes the windows of the benchmark and their different (window, item) pairs, and deals these by hash into
blocks of about ``BLOCK`` pairs. The driver holds one block at a time and broadcasts it for one pass over the documents;
the pass is written, and its broadcast released, before the next. So driver and broadcast have a fixed bound whatever the
benchmark's size, the length of an item or the number of items that share a window.

Defined results: null or empty text has no words and no hits; repeated documents and repeated items give
the same result per row and name an item once; items with a null id count as hits but are not listed;
an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import sliced, stored, table, utf8
from tripcraft.llm.fmindex import FMIndex

WINDOW = 10
SHARD = 1 << 20  # words per index
BLOCK = 1 << 18  # windows per broadcast block
WINDOW_BATCH = 10_000  # windows a task gives out at once
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPANS = "array<struct<start:int,end:int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Windows:
    """The distinct windows of a block of items, as rows of word numbers (right-aligned), and their items."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at:at + window]), set()).update([] if item is None else [item])
        self.items = list(found.values())
        self.lengths = np.array([len(w) for w in found], dtype=np.int64)
        width = int(self.lengths.max()) if found else 0
        self.rows = np.zeros((len(found), width), dtype=np.int64)
        for k, w in enumerate(found):
            self.rows[k, width - len(w):] = w
        self.shortest = int(self.lengths.min()) if found else 0
        self.longest = width
        self.sigma = len(self.vocabulary) + 1

    def runs(self, words: list[bytes]) -> list[tuple[int, np.ndarray]]:
        """(word offset, symbols) of each run of item words that can hold a window."""
        if not self.items or len(words) < self.shortest:
            return []
        get = self.vocabulary.get
        s = np.array([get(w, 0) for w in words], dtype=np.int64)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], s > 0, [False]]).astype(np.int8)))
        out = []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= self.shortest:  # a run longer than a shard is cut, with overlap
                out += [(k, s[k:min(b, k + SHARD + self.longest - 1)]) for k in range(a, b, SHARD)]
        return out

    def search(self, texts: list[list[bytes]]) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set[str]]]:
        """By document number: merged spans of hit words, and the items found."""
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        shard: list[tuple[int, int, np.ndarray]] = []

        def flush() -> None:
            index = FMIndex([x[2] for x in shard], self.sigma)
            for p, run, at in zip(*(x.tolist() for x in index.occurrences(self.rows, self.lengths)), strict=True):
                doc, offset, _ = shard[run]
                spans.setdefault(doc, []).append((offset + at, offset + at + int(self.lengths[p])))
                items.setdefault(doc, set()).update(self.items[p])
            shard.clear()

        held = 0
        for doc, words in enumerate(texts):
            for offset, symbols in self.runs(words):
                shard.append((doc, offset, symbols))
                held += len(symbols)
                if held >= SHARD:
                    flush()
                    held = 0
        if shard:
            flush()
        return {d: merged(x) for d, x in spans.items()}, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def pairs(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """The different ``(i, w)``: item ids as strings and their windows, the words joined by a space."""
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).where("t is not null")
    arrow = pa.schema([("i", pa.string()), ("w", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str | None] = []
        found: list[bytes] = []
        for b in sliced(batches, "t", 100):
            for name, t in zip(b.column("i").to_pylist(), utf8(b.column("t")), strict=True):
                words = words_of(t)
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    names.append(name)
                    found.append(b" ".join(words[at:at + window]))
                    if len(found) == WINDOW_BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())], schema=arrow)
                        names, found = [], []
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())], schema=arrow)

    return items.mapInArrow(run, "i string, w binary").distinct()


def _blocks(benchmark: DataFrame, item: str, text: str, window: int) -> tuple[int, Callable[[int], Windows]]:
    """The number of blocks (one at least) and a function that gives the windows of one."""
    found = stored(pairs(benchmark, item, text, window), "decontaminate-windows")
    n = max(1, -(-found.count() // BLOCK))

    def block(k: int) -> Windows:
        part = found if n == 1 else found.where(F.pmod(F.xxhash64("w", "i"), F.lit(n)) == k)
        return Windows([(r.i, bytes(r.w)) for r in part.toLocalIterator()], window)

    return n, block


def _prepared(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text}`").alias("t"),
                       F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))


def _search_block(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """One block's pass: its spans and items are merged into those of the blocks before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "t", 2000):
            texts = [words_of(t) for t in utf8(b.column("t"))]
            spans, items = shared.value.search(texts)
            before, named = b.column("spans").to_pylist(), b.column("items").to_pylist()
            for d, found in spans.items():
                before[d] = [dict(zip(("start", "end"), x, strict=True))
                             for x in merged(found + [(y["start"], y["end"]) for y in before[d]])]
                named[d] = sorted({*named[d], *items[d]})
            columns = {"n_words": pa.array([len(t) for t in texts], pa.int64()), "spans": pa.array(before, b.schema.field("spans").type),
                       "items": pa.array(named, b.schema.field("items").type)}
            yield pa.RecordBatch.from_arrays([columns.get(c, b.column(k)) for k, c in enumerate(b.schema.names)], names=b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
           item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` as a column ``row`` plus ``n_words`` (long), ``spans`` (merged word spans that are hit) and ``items``
    (ids found, sorted as strings). Each block of the benchmark is one pass over the documents; its result is
    written, and its broadcast released, before the next."""
    out = _prepared(docs, text)
    n, block = _blocks(benchmark, item, item_text, window)
    for k in range(n):
        shared = docs.sparkSession.sparkContext.broadcast(block(k))
        out = _search_block(out, shared)
        if k < n - 1:
            out = stored(out, "decontaminate-block")
            shared.unpersist()
    return out.drop("t")


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
           item_text: str = "text", window: int = WINDOW, length: str | None = None) -> DataFrame:
    """``docs`` with the hit spans cut out of the text (from the first to the last hit word of each span), again
    until no window occurs; rows of which no word is left are dropped. Clean rows are unchanged. ``length`` names
    a column with the text's code points that follows the cut, where the table has it.

    With one block a single Python step searches and cuts, again and again, so a task has one worker; only texts that
    changed come back beside the rows. With more, a round is a stored pass per block and a cut of
    all spans found, and a further round takes only the rows that the last one cut: a cut can join words to a new window."""
    n, block = _blocks(benchmark, item, item_text, window)

    def cut(body: bytes, spans: list[tuple[int, int]]) -> bytes:
        places = [m.span() for m in _WORD.finditer(body)]
        for a, b in reversed(spans):
            body = body[:places[a][0]] + body[places[b - 1][1]:]
        return body

    def cut_all(shared: Broadcast) -> DataFrame:
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
        schema = rows.select("row", F.lit(None).cast("string").alias("t"), F.lit(False).alias("ever")).schema
        at = docs.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in sliced(batches, "row", 2000):
                row = b.column("row")
                raw = utf8(row.field(at))
                now: dict[int, bytes] = {}
                spans = shared.value.search([words_of(r) for r in raw])[0]
                while spans:
                    now.update((d, cut(now.get(d, raw[d]), found)) for d, found in spans.items())
                    todo = sorted(spans)
                    again = shared.value.search([words_of(now[d]) for d in todo])[0]
                    spans = {todo[k]: found for k, found in again.items()}
                new = [now[d].decode() if d in now else None for d in range(len(raw))]
                yield pa.RecordBatch.from_arrays([row, pa.array(new, pa.string()), pa.array([x is not None for x in new], pa.bool_())],
                                                 names=["row", "t", "ever"])

        return rows.mapInArrow(run, schema)

    def cut_rows(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in sliced(batches, "t", 2000):
                raw = [cut(t, [(y["start"], y["end"]) for y in x])
                       for t, x in zip(utf8(b.column("t")), b.column("spans").to_pylist(), strict=True)]
                columns = {"t": pa.array([r.decode() for r in raw], b.schema.field("t").type), "ever": pa.array([True] * len(raw), pa.bool_())}
                yield pa.RecordBatch.from_arrays([columns.get(c, b.column(k)) for k, c in enumerate(b.schema.names)], names=b.schema.names)

        return rows.mapInArrow(run, rows.schema)

    def rounds() -> DataFrame:
        rows, done = _prepared(docs, text).withColumn("ever", F.lit(False)), []
        while True:
            for k in range(n):
                shared = docs.sparkSession.sparkContext.broadcast(block(k))
                rows = stored(_search_block(rows, shared), "decontaminate-cut")
                shared.unpersist()
            done.append(rows.where(F.size("spans") == 0))
            rows = cut_rows(rows.where(F.size("spans") > 0)).withColumn("spans", F.array().cast(SPANS))
            if rows.isEmpty():
                return functools.reduce(DataFrame.unionAll, done)

    out = cut_all(docs.sparkSession.sparkContext.broadcast(block(0))) if n == 1 else rounds()
    left = F.col("t").rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]")

    def column(c: str) -> Column:
        was = F.col(f"row.`{c}`")
        if c == text:
            return F.when(F.col("ever"), F.col("t")).otherwise(was)
        return F.when(F.col("ever"), F.length("t").cast(docs.schema[c].dataType)).otherwise(was) if c == length else was

    return out.where(~F.col("ever") | left).select(*(column(c).alias(c) for c in docs.columns))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents", "doc_id", "text"),
                   table(spark, sf_dir, "benchmark", "item_id", "text"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("row.doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (hits > 0).alias("contaminated"))


OP4_SQL = r"""
with w as (
  select doc_id, row_number() over () as r,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as ws
  from documents),
b as (
  select cast(item_id as varchar) as item_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as ws
  from benchmark),
win as (
  select distinct item_id, least(len(ws), 10) as n,
         array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') as g
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) as i from b where len(ws) > 0)),
sizes as (select distinct n from win),
grams as (
  select r, n, i, array_to_string(ws[i:i + n - 1], ' ') as g
  from (select r, ws, n, unnest(range(1, len(ws) - n + 2)) as i from w, sizes where len(ws) >= n)),
occ as (select r, i, win.n, item_id from grams join win on grams.g = win.g and grams.n = win.n),
hit as (select r, count(distinct p) as n_hit
        from (select r, unnest(range(i, i + n)) as p from occ) group by r),
it as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as names
       from occ group by r)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join hit using (r) left join it using (r)
"""
