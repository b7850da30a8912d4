"""Token ids in binary files with Elias-Fano document boundaries.

``write`` encodes every whole text with a byte-level BPE tokenizer, appends ``end_id`` to each document and
writes the ids in ascending key order into files of about ``FILE_IDS`` ids: header, ids (16 bits where the
vocabulary allows, else 32), Elias-Fano boundaries, Elias-Fano keys. Files go to the shared folder under a
name of their own per attempt; only the manifest that Spark commits says which of them count, so a retried
task leaves no half result. ``read`` opens the files of the manifest and returns one row per document.

Order: range partitions of (key, hash of the text), sorted inside; null keys first, equal keys by text. The
position of a file's first id is a running sum over the manifest (one row per file).

Encoding: pieces between single spaces repeat a lot, so each worker keeps the ids of pieces it has seen
twice (at most ``CACHE`` entries) and gives only others to the tokenizer; Arrow cuts a batch's texts and numbers
their different pieces, so that Python looks each of them up once a batch. A space between two non-space
characters always starts a pre-token of the byte-level pattern, so the pieces' ids concatenate to the whole text's ids; texts with adjacent white space are cut before white-space runs instead, and texts with
the control characters U+001C to U+001F or with a special token's string, and all texts of a tokenizer of
another kind, are encoded whole.

Defined results: a null or empty text has the end id alone; repeated rows are repeated documents.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcraft.llm.common import held, shared_path, sliced, stored, table
from tripcraft.llm.eliasfano import EliasFano

FILE_IDS = 1 << 25  # ids per file: 64 MB of 16-bit ids
CACHE = 400_000  # pieces a worker remembers
ONCE = (1 << 22) - 1  # hash slots that note what has been seen once
JOINED = 256  # new pieces given to the tokenizer as one text
KEEP_LENGTH = 64  # longest piece that is remembered
ROWS = 1024  # documents encoded at once,
CHARS = 1 << 21  # or as many as have this number of characters
MAGIC = b"EFTOKENS"
_HEAD = struct.Struct("<8sBQQQQqQ")  # magic, id bytes, ids, documents, null keys, boundary bytes, lowest key, key bytes
_UNSAFE = re.compile(r"\s\s|[\x1c-\x1f]|^\s|\s$")
_CONTROL = re.compile(r"[\x1c-\x1f]")
_RUNS = re.compile(r"\s*\S+|\s+")


def default_vocabulary() -> str:
    """Path of the public byte-level BPE vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def open_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop-style address (``file:/x``, ``/x``, ``hdfs://...``, ``s3a://...``)."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


class Encoder:
    """Whole texts to little-endian 32-bit ids, with a bounded memory of pieces."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        parts = json.loads(spec)
        pre = parts.get("pre_tokenizer") or {}
        self.pieces = (parts.get("normalizer") is None and pre.get("type") == "ByteLevel"
                       and not pre.get("add_prefix_space", True) and pre.get("use_regex", True)
                       and not any(t["lstrip"] or t["rstrip"] or t["single_word"]
                                   for t in parts.get("added_tokens", [])))
        self.special = [t["content"] for t in parts.get("added_tokens", [])]
        # every byte of a token is one character of the byte-level alphabet
        self.lengths = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.lengths[i] = len(token)
        self.seen: dict[str, bytes] = {}  # pieces as they are
        self.after: dict[str, bytes] = {}  # pieces that follow a space
        self.once = np.zeros(ONCE + 1, dtype=bool)

    def _cut(self, text: str) -> list[str] | None:
        """Pieces as they are, or None if the text may be cut at its spaces."""
        if not self.pieces or any(x in text for x in self.special):
            return [text]
        if "  " in text or "\n\n" in text or "\n " in text or " \n" in text or text[0].isspace() or text[-1].isspace() \
                or not text.replace("\n", " ").isprintable():
            if _UNSAFE.search(text):
                return [text] if _CONTROL.search(text) else _RUNS.findall(text)
        return None

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Of each text its ids. A long text, or as many as have CHARS characters, are taken at once."""
        out: list[bytes] = []
        upto = np.cumsum([len(t or "") for t in texts])
        while len(out) < len(texts):
            at = len(out)
            before = int(upto[at - 1]) if at else 0
            out += self._encode(texts[at:max(at + 1, int(np.searchsorted(upto, before + CHARS, side="right")))])
        return out

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.seen) + len(self.after) > CACHE:
            self.seen.clear()
            self.after.clear()
            self.once[:] = False
        heads: list[str] = []
        rests: list[str | None] = []  # what follows the first space
        upto = [0]  # heads of each text and those before
        for t in texts:
            pieces = self._cut(t) if t else []
            rest = None
            if pieces is None:
                head, space, then = t.partition(" ")
                pieces, rest = [head], then if space else None
            heads += pieces
            upto.append(len(heads))
            rests.append(rest)
        first = self._ids(pa.array(heads, pa.large_string()), np.array(upto), self.seen, self._alone)
        lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        counts = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
        then = self._ids(lists.flatten(), np.concatenate([[0], np.cumsum(counts)]), self.after, self._joined)
        return [a + b for a, b in zip(first, then, strict=True)]

    def _ids(self, pieces: pa.Array, upto: np.ndarray, known: dict[str, bytes], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Of each text its pieces' ids; ``upto`` says where a text's pieces begin and end. Each different piece is looked up once."""
        if not len(pieces):
            return [b""] * (len(upto) - 1)
        numbered = pieces.dictionary_encode()
        number = numbered.indices.to_numpy()
        different = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(known.get, different))
        gaps = [k for k, x in enumerate(ids) if x is None]
        if gaps:
            new = [different[k] for k in gaps]
            made = make(new)
            for k, x in zip(gaps, made, strict=True):
                ids[k] = x
            self._remember(known, new, made)
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        start = np.cumsum(size) - size
        n = size[number]
        end = np.cumsum(n)
        at = np.repeat(start[number] - (end - n), n) + np.arange(end[-1])
        raw = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        cuts = (4 * np.concatenate([[0], end])[upto]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _remember(self, where: dict[str, bytes], pieces: list[str], ids: list[bytes]) -> None:
        """A piece is remembered when it comes again; most never do. Long ones are not."""
        slots = np.fromiter(map(hash, pieces), dtype=np.int64, count=len(pieces)) & ONCE
        again = np.flatnonzero(self.once[slots]).tolist()
        self.once[slots] = True
        where.update((pieces[k], ids[k]) for k in again if len(pieces[k]) <= KEEP_LENGTH)

    def _alone(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that follow a space. They are given to the tokenizer JOINED at a time, with their spaces:
        they do not change each other's ids, and the byte lengths of the tokens say where one ends."""
        groups = [" " + " ".join(pieces[k:k + JOINED]) for k in range(0, len(pieces), JOINED)]
        flat = np.concatenate([np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)])
        sizes = np.cumsum(pc.binary_length(pa.array(pieces, pa.large_string())).to_numpy() + 1)
        cuts = [0, *(4 * (np.searchsorted(np.cumsum(self.lengths[flat]), sizes) + 1)).tolist()]
        raw = flat.tobytes()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def pack(keys: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One file's bytes from documents in ascending key order (nulls first)."""
    sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    flat = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes()
    bounds = EliasFano.encode(np.concatenate([[0], np.cumsum(sizes)])).to_bytes()
    known = [k for k in keys if k is not None]
    lowest = known[0] if known else 0
    names = EliasFano.encode(np.array([k - lowest for k in known], dtype=np.uint64)).to_bytes()
    head = _HEAD.pack(MAGIC, width, int(sizes.sum()), len(keys), len(keys) - len(known), len(bounds), lowest, len(names))
    return b"".join([head, bounds, names, flat])


class TokenFile:
    """A file's boundaries and keys in memory; ids are read where asked."""

    def __init__(self, uri: str):
        fs, path = open_uri(uri)
        self.file = fs.open_input_file(path)
        magic, self.width, self.n_ids, self.n_docs, nulls, n_bounds, lowest, n_keys = _HEAD.unpack(
            self.file.read(_HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        self.bounds = EliasFano.from_bytes(self.file.read(n_bounds))
        self.keys = [None] * nulls + [lowest + k for k in EliasFano.from_bytes(self.file.read(n_keys)).decode().tolist()]
        self.at = self.file.tell()

    def ids(self, start: int, stop: int) -> np.ndarray:
        self.file.seek(self.at + start * self.width)
        return np.frombuffer(self.file.read((stop - start) * self.width), f"<u{self.width}").astype("<u4")

    def document(self, k: int) -> np.ndarray:
        """Ids of document number ``k`` (with the end id), found by select."""
        return self.ids(self.bounds.select(k), self.bounds.select(k + 1))

    def documents(self, block: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, start in the file, ids) in order, reading about ``block`` ids at a time."""
        ends = self.bounds.decode()
        k = 0
        while k < self.n_docs:
            stop = max(k + 1, int(np.searchsorted(ends, ends[k] + block, side="right")) - 1)
            ids = self.ids(int(ends[k]), int(ends[stop]))
            for d in range(k, stop):
                yield self.keys[d], int(ends[d]), ids[ends[d] - ends[k]:ends[d + 1] - ends[k]]
            k = stop

    def close(self) -> None:
        self.file.close()


def write(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
          end_id: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode and write; returns the manifest: path, part, seq, n_docs, n_ids, base (ids in all files before)."""
    spark = docs.sparkSession
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        spec = f.read()
    from tokenizers import Tokenizer
    width = 2 if Tokenizer.from_str(spec).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    shared = spark.sparkContext.broadcast(spec)
    fs, path = open_uri(folder)
    fs.create_dir(path, recursive=True)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    tie = F.xxhash64("t")
    ordered = rows.repartitionByRange(F.col("k").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("k").asc_nulls_first(), tie, F.col("t").asc_nulls_first())
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        encoder = held(("tokens", shared.value), lambda: Encoder(shared.value))
        keys: list[int | None] = []
        ids: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            uri = f"{folder}/{part:06d}-{seq:05d}-{uuid.uuid4().hex}.tokens"
            out, name = open_uri(uri)
            with out.open_output_stream(name) as f:
                f.write(pack(keys, ids, width))
            return pa.RecordBatch.from_pylist([{"path": uri, "part": part, "seq": seq, "n_docs": len(keys),
                                                "n_ids": size}], schema=arrow)

        for b in sliced(batches, "t", ROWS):
            encoded = encoder.encode(b.column("t").to_pylist())
            for k, x in zip(b.column("k").to_pylist(), encoded, strict=True):
                keys.append(k)
                ids.append(x + end)
                size += len(x) // 4 + 1
                if size >= file_ids:
                    yield flush()
                    keys.clear(), ids.clear()
                    size, seq = 0, seq + 1
        if keys:
            yield flush()

    arrow = pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
                       ("n_ids", pa.int64())])
    files = stored(ordered.mapInArrow(run, "path string, part int, seq int, n_docs long, n_ids long"), "token-files")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """One row per document of the manifest's files: doc_id, start, n_tokens, ids_crc32."""
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True):
                file = TokenFile(uri)
                rows: list[tuple] = []
                for key, start, ids in file.documents():
                    rows.append((key, base + start, len(ids), zlib.crc32(ids.tobytes())))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=arrow)
                        rows.clear()
                file.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=arrow)

    files = manifest.select("path", "base")
    spread = files.repartition(max(1, files.count()))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    """Write to a fresh shared folder, then one row per document from the files."""
    folder = shared_path(docs.sparkSession, "tokens")
    return read(stored(write(docs, folder, **options), "token-manifest"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_and_read(table(spark, sf_dir, "documents", "doc_id", "text"))
