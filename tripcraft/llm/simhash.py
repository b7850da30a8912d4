"""SimHash near-duplicates with pigeonring candidate filtering.

Fingerprint (64 bits): ASCII A-Z are lower-cased, words are runs without ASCII white space, the
features are the space-joined shingles of ``shingle`` consecutive words, repeats included (a text of
fewer words is one feature). Each feature votes with its XXH64 (UTF-8, seed 42); a bit is 1 if set in
more than half of the features. A text without words (null, empty, only white space) has fingerprint 0.

Linking: fingerprints link at ``max_distance`` = 3 or fewer differing bits. The 64 bits form a ring
of eight 8-bit segments. At most 3 differences on the ring leave, by the strong pigeonhole (pigeonring)
principle, a start segment from which every chain of ``l`` consecutive segments has at most
``l * 3 / 8`` differences: two equal segments, at most one difference in the next three (so two of
those three are equal), at most two in seven. The equal segments make the join key (32 of 64 bits,
8 starts x 3 choices), the chain budgets prune inside the join, and the full Hamming distance decides.

Defined results: repeated rows and exact copies share a fingerprint and so a component; a null doc_id is
never a component id unless all members of the component have none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripcraft.llm.common import components, sliced, stored, table, utf8

SHINGLE = 3
MAX_DISTANCE = 3
SEGMENTS = 8
WIDTH = 64 // SEGMENTS
CHUNK = 200_000  # features hashed at a time, bounds the memory of a very long text
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one UTF-8 text, as a signed integer."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(words) - shingle + 1)
    votes = np.zeros((8, 8), dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:at + CHUNK + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle)), strict=False) if len(words) >= shingle else [words]
        hashes = np.array([digest(join(g), 42) for g in grams], dtype="<u8").view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            votes[byte] += np.bincount(hashes[:, byte], minlength=256) @ _BITS
    return int(np.packbits((votes.ravel() * 2 > n), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one more column ``fp`` (long), all other columns unchanged."""
    schema = docs.withColumn("fp", F.lit(None).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, text):
            out = pa.array([fingerprint(t, shingle) for t in utf8(b.column(text))], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, "fp"])

    return docs.mapInArrow(run, schema)


def _keys(fps: DataFrame) -> DataFrame:
    """One row per (start segment, which of the three following segments may differ): the 32 equal bits."""
    bits = (1 << WIDTH) - 1
    rows = []
    for start in range(SEGMENTS):
        for free in range(3):
            mask = (1 << 2 * WIDTH) - 1
            for k in range(3):
                mask |= 0 if k == free else bits << (2 + k) * WIDTH
            turned = _turn(F.col("fp"), start)
            rows.append(F.struct(F.lit(start).alias("start"), F.lit(free).alias("free"),
                                 turned.bitwiseAND(F.lit(mask)).alias("bits")))
    return fps.select("fp", F.explode(F.array(*rows)).alias("k")).select("fp", "k.*")


def _turn(x: Column, start: int) -> Column:
    """The ring, rotated so that segment ``start`` holds the lowest bits."""
    return x if not start else F.shiftrightunsigned(x, WIDTH * start).bitwiseOR(F.shiftleft(x, 64 - WIDTH * start))


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs (src < dst) of distinct fingerprints at ``max_distance`` or fewer differing bits."""
    if not 0 <= max_distance <= 3:
        raise ValueError("the segment ring is laid out for at most 3 differing bits")
    keys = _keys(fps.select("fp").distinct())
    a, b = keys.alias("a"), keys.alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    turned = F.expr(f"shiftrightunsigned(a.fp ^ b.fp, {WIDTH} * a.start) | shiftleft(a.fp ^ b.fp, 64 - {WIDTH} * a.start)")
    near = F.col("a.fp") < F.col("b.fp")
    for length in range(3, SEGMENTS):  # chain budgets, shortest chain first
        mask = (1 << WIDTH * length) - 1
        near &= F.bit_count(turned.bitwiseAND(F.lit(mask))) <= length * MAX_DISTANCE // SEGMENTS
    near &= F.bit_count(x) <= max_distance
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("start", "free", "bits")]
    return a.join(b, same[0] & same[1] & same[2] & near).select(
        F.col("a.fp").alias("src"), F.col("b.fp").alias("dst")).distinct()


def groups(fps: DataFrame, key: str = "doc_id", max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``fps(key, fp)``: ``root`` names the group of
    linked fingerprints, ``component_id`` is the smallest key in it."""
    each = stored(fps.groupBy("fp").agg(F.min(key).alias("low")), "simhash-fps")
    joined = components(links(each, max_distance)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = each.join(joined, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    return rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root").select(
        "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Per row of ``docs``: key, fingerprint (16 hex digits), component_id (smallest key reachable)."""
    fps = stored(fingerprints(docs.select(key, text), text, shingle).select(key, "fp"), "simhash")
    found = fps.join(groups(fps, key, max_distance), "fp", "left")
    return found.select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _has_map(kind: T.DataType) -> bool:
    parts = [f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else [kind.elementType] if isinstance(kind, T.ArrayType) else []
    return isinstance(kind, T.MapType) or any(map(_has_map, parts))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one row per group of near-duplicates: the one of the smallest key (a null
    key only where the group has no other), ties by a hash of the row. All columns unchanged."""
    names = docs.columns
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    row = row.select("row", F.col(f"row.`{key}`").alias("id"), F.col(f"row.`{text}`").alias("body"),
                     F.xxhash64(F.to_json("row") if _has_map(docs.schema) else F.col("row")).alias("h"))  # maps have no hash
    fps = stored(fingerprints(row.select("id", "h", "body"), "body", shingle).select("id", "h", "fp"), "simhash")
    rooted = fps.join(groups(fps, "id", max_distance).select("fp", "root"), "fp")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "h")
    picks = rooted.groupBy("root").agg(F.min(order).alias("p"))
    picks = stored(picks.select(F.col("p.id").alias("pid"), F.col("p.h").alias("ph")), "simhash-picks")
    same = row["id"].eqNullSafe(picks["pid"]) & (row["h"] == picks["ph"])
    kept = row.join(picks, same, "left_semi").select("row.*")
    again = fps.join(picks, fps["id"].eqNullSafe(picks["pid"]) & (fps["h"] == picks["ph"]), "left_semi")
    repeated = not again.groupBy("id", "h").count().where("count > 1").isEmpty()
    if not repeated:
        return kept
    if not _has_map(docs.schema):
        return kept.dropDuplicates()
    return kept.withColumn("same row", F.to_json(F.struct("*"))).dropDuplicates(["same row"]).drop("same row")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
