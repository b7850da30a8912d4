"""Packing documents into fixed-length training sequences along a space-filling curve.

Every document is encoded once (ids and an end id). Its ids are hashed into ``BUCKETS`` signed counts; their
logarithms, at unit length, are projected to ``DIMS`` numbers by a fixed matrix of +1 and -1, and these, cut
to ``BITS`` bits each between fixed limits, are a point of a grid whose number on the Hilbert curve is the
document's key. Documents that share words have near points, and near points mostly near keys. Nothing of a
key depends on other documents, so more data or another partitioning does not move a document on the curve.

Range partitions of (key, row) put the documents in curve order, and each partition is cut at every
``length`` ids: a sequence holds neighbours of the curve. A task holds one unfinished sequence. What is left at a
partition's end is cut into sequences of powers of two, largest first, so no sequence needs padding. Many
documents on one point (copies) are split by their row number, so they may fill many partitions.

Defined results: a null or empty text is its end id alone; repeated rows and null keys are documents of their
own; a document longer than a sequence has several pieces, the one that ends a sequence and the one that
starts the next in curve order. ``sequence_id`` is the partition times 2^33 plus a number: ascending along the
curve, not gapless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import held, sliced, stored, table
from tripcraft.llm.tokens import ROWS, Encoder, default_vocabulary

LENGTH = 2048
END_ID = 1
BUCKETS = 1024
DIMS, BITS, LIMIT = 6, 10, 4.0  # grid of the curve: 60-bit keys, coordinates from -LIMIT to LIMIT
SEED = 11
BATCH = 256  # documents hashed at once


def signs(buckets: int = BUCKETS, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """The fixed projection: buckets x dims of +1 and -1."""
    return np.random.default_rng(seed).integers(0, 2, size=(buckets, dims)).astype(np.float32) * 2 - 1


def hashed(ids: list[np.ndarray], buckets: int = BUCKETS) -> np.ndarray:
    """Documents x buckets: logarithms of signed hashed counts, rows of unit length (zero rows stay)."""
    flat = np.concatenate(ids).astype(np.uint32) * np.uint32(2654435761)  # multiplicative hash
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    side = 1.0 - 2.0 * ((flat >> np.uint32(8)) & np.uint32(1))
    counts = np.bincount(doc * buckets + (flat >> np.uint32(16)) % np.uint32(buckets), weights=side, minlength=len(ids) * buckets)
    counts = (np.sign(counts) * np.log1p(np.abs(counts))).reshape(len(ids), buckets).astype(np.float32)
    norm = np.sqrt(np.einsum("nd,nd->n", counts, counts))
    return counts / np.where(norm == 0, 1, norm)[:, None]


def projected(vectors: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The matrix product, summed in one order by one thread: threads of a BLAS library spin between small
    products, and the result would depend on their number."""
    return np.einsum("nd,dk->nk", vectors, matrix)


def grid(points: np.ndarray, bits: int = BITS, limit: float = LIMIT) -> np.ndarray:
    """Coordinates cut to whole numbers of ``bits`` bits."""
    cell = np.floor((points + limit) * ((1 << bits) / (2 * limit)))
    return np.clip(cell, 0, (1 << bits) - 1).astype(np.int64)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Number of each grid point (rows of ``cells``) on the Hilbert curve.

    Skilling's transform ("Programming the Hilbert curve", 2004): undo the rotations and reflections of each
    level from the top bit down, Gray-encode, and interleave the bits."""
    x = cells.T.copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for d in range(dims):
            inside = (x[d] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[d]) & (q - 1))
            x[0] ^= np.where(inside, q - 1, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def encode(docs: DataFrame, key: str, text: str, vocabulary: str | None, end_id: int) -> tuple[DataFrame, int]:
    """Rows (k, curve, row, n, ids) and the bytes of an id."""
    from tokenizers import Tokenizer
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        spec = f.read()
    width = 2 if max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    end = np.array([end_id], dtype="<u4").tobytes()
    arrow = pa.schema([("k", pa.int64()), ("curve", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder = held(("tokens", shared.value), lambda: Encoder(shared.value))
        matrix = signs()
        row = TaskContext.get().partitionId() << 33
        for b in sliced(batches, "t", ROWS):
            ids = [np.frombuffer(x + end, "<u4") for x in encoder.encode(b.column("t").to_pylist())]
            curve = np.concatenate([hilbert(grid(projected(hashed(ids[k:k + BATCH]), matrix))) for k in range(0, len(ids), BATCH)])
            yield pa.RecordBatch.from_arrays([
                b.column("k"), pa.array(curve), pa.array(np.arange(row, row + len(ids))), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([x.astype(f"<u{width}").tobytes() for x in ids], pa.binary())], schema=arrow)
            row += len(ids)

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "k long, curve long, row long, n long, ids binary"), width


class Packer:
    """One partition's documents, in order, cut into sequences; pieces are (key, start, length, total, sequence, offset, ids)."""

    def __init__(self, length: int, first: int):
        self.length, self.sequence = length, first
        self.open: list[tuple] = []  # pieces of the unfinished sequence: key, start, total, ids
        self.fill = 0

    def add(self, key: int | None, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            take = min(self.length - self.fill, len(ids) - at)
            self.open.append((key, at, len(ids), ids[at:at + take]))
            self.fill += take
            at += take
            if self.fill == self.length:
                yield from self._close()

    def _close(self) -> Iterator[tuple]:
        offset = 0
        for key, start, total, ids in self.open:
            yield key, start, len(ids), total, self.sequence, offset, ids
            offset += len(ids)
        self.sequence += 1
        self.open, self.fill = [], 0

    def finish(self) -> Iterator[tuple]:
        """The rest, cut into powers of two."""
        rest, left = self.open, self.fill
        self.open, self.fill = [], 0
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            while size:
                key, start, total, ids = rest.pop(0)
                take = min(size, len(ids))
                self.open.append((key, start, total, ids[:take]))
                if take < len(ids):
                    rest.insert(0, (key, start + take, total, ids[take:]))
                size -= take
            yield from self._close()


PIECE = "k long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end_id: int = END_ID,
           length: int = LENGTH, partitions: int | None = None) -> DataFrame:
    """One row per piece: key, start (ids of its document before it), length, doc_tokens, sequence_id, offset (its
    place in the sequence) and ids (little-endian unsigned 32-bit). ``length`` is a power of two."""
    if length < 1 or length & (length - 1):
        raise ValueError(f"length must be a power of two, not {length}")
    rows, width = encode(docs, key, text, vocabulary, end_id)
    rows = stored(rows, "packing-ids")
    by = [F.col("curve"), F.col("row")]
    ordered = (rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)).sortWithinPartitions(*by)
    names = ["k", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    arrow = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        packer = Packer(length, TaskContext.get().partitionId() << 33)
        out: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:-1]]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([x.astype("<u4").tobytes() for x in columns[-1]], pa.binary())], schema=arrow)

        def pieces() -> Iterator[tuple]:
            for b in batches:
                for k, ids in zip(b.column("k").to_pylist(), b.column("ids"), strict=True):
                    yield from packer.add(k, np.frombuffer(ids.as_buffer(), f"<u{width}"))
            yield from packer.finish()

        for piece in pieces():
            out.append(piece)
            size += piece[2]
            if size >= 1 << 20 or len(out) == 10_000:
                yield flush()
                out.clear()
                size = 0
        if out:
            yield flush()

    return ordered.select("k", "ids").mapInArrow(run, PIECE).withColumnRenamed("k", key)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed(table(spark, sf_dir, "documents", "doc_id", "text"))
    # written, so that a second reader sees the same sequences (range bounds are sampled anew per run)
    return stored(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"),
                  "packing-pieces")
