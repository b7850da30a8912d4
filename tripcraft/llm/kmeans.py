"""Centroid clustering of whole-number vectors by scalar lookup tables.

A kept vector (``dims`` components, none null or non-finite) becomes whole numbers floor(scale * x). Vectors are stored once
in blocks: per dimension the values that occur in the block, and for every vector the place of its value
among them (16 bits). A round tabulates, per block and dimension, the squared difference of each occurring value to each centroid;
a vector's distances are the sums of the table rows its places select. Tables have at most ``ROWS`` rows a
dimension whatever the values are, and all arithmetic is exact in 64-bit integers.

A task adds up its blocks' counts and component sums per centroid, so a round shuffles one row per (task,
centroid), and the driver gets one row per centroid: numbers of clusters times dimensions, both parameters.

Defined results: equal distances go to the smaller centroid number; a centroid without vectors stays; equal
hashes (repeated keys) are taken in order of their vectors, a null key hashes as an empty text; fewer kept
vectors than ``clusters`` make as many centroids; an empty table, or one without kept vectors, has no rows.
A component of which ``scale`` times exceeds ``LARGEST`` is an error: its squared distances need not fit the
64 bits of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import stored, table

CLUSTERS, DIMS, SCALE, ROUNDS, SEED = 40, 64, 256, 5, 2
ROWS = 4096  # vectors of a block
LARGEST = 1 << 27


def kept(vectors: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """Rows (k, v) of the vectors that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("v") == dims) & F.coalesce(fine, F.lit(False)))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(values * scale)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST} / {scale}: squared distances may not fit 64 bits")
    return out.astype(np.int64)


def blocks(rows: DataFrame, dims: int, scale: int, size: int = ROWS) -> DataFrame:
    """Rows (ids, sizes, values, places): per block its keys, the number of values per dimension, those values,
    and every vector's places, dimension by dimension."""
    arrow = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("values", pa.binary()), ("places", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        waiting: list[np.ndarray] = []

        def block(matrix: np.ndarray, keys: list[int | None]) -> pa.RecordBatch:
            each = [np.unique(matrix[:, d], return_inverse=True) for d in range(dims)]
            return pa.RecordBatch.from_arrays([
                pa.array([keys], pa.list_(pa.int64())), pa.array([[len(v) for v, _ in each]], pa.list_(pa.int32())),
                pa.array([b"".join(v.astype("<i8").tobytes() for v, _ in each)], pa.binary()),
                pa.array([b"".join(p.astype("<u2").tobytes() for _, p in each)], pa.binary())], schema=arrow)

        for b in batches:
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
                waiting.append(whole(flat.reshape(part.num_rows, dims), scale))
                ids += part.column("k").to_pylist()
                while len(ids) >= size:
                    matrix = np.concatenate(waiting)
                    yield block(matrix[:size], ids[:size])
                    waiting, ids = [matrix[size:]], ids[size:]
        if ids:
            yield block(np.concatenate(waiting), ids)

    return rows.mapInArrow(run, "ids array<long>, sizes array<int>, values binary, places binary")


def nearest(block: dict, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of each vector of a block, by table look-ups."""
    n = len(block["ids"])
    values, places = np.frombuffer(block["values"], "<i8"), np.frombuffer(block["places"], "<u2").reshape(-1, n)
    total = np.zeros((n, len(centroids)), dtype=np.int64)
    at = 0
    for d, size in enumerate(block["sizes"]):
        lookup = (values[at:at + size, None] - centroids[None, :, d]) ** 2
        total += lookup[places[d]]
        at += size
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(n), cluster]


def sums(block: dict, cluster: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and component sums per cluster: occurrences per (value, cluster) times the value."""
    n = len(block["ids"])
    values, places = np.frombuffer(block["values"], "<i8"), np.frombuffer(block["places"], "<u2").reshape(-1, n)
    out = np.zeros((clusters, len(block["sizes"])), dtype=np.int64)
    at = 0
    for d, size in enumerate(block["sizes"]):
        seen = np.bincount(cluster * size + places[d], minlength=clusters * size).reshape(clusters, size)
        out[:, d] = seen @ values[at:at + size]
        at += size
    return np.bincount(cluster, minlength=clusters), out


def recentred(parts: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign, then floor(sum / count) per component of every centroid that has vectors."""
    clusters, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(clusters, dtype=np.int64), np.zeros((clusters, dims), dtype=np.int64)
        for b in batches:
            for block in b.to_pylist():
                n, s = sums(block, nearest(block, centroids)[0], clusters)
                count += n
                total += s
        hit = np.flatnonzero(count)
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(count[hit]),
                                              pa.array(total[hit].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "s"])

    partial = parts.mapInArrow(run, "cluster int, n long, s array<long>")
    wide = "decimal(38,0)"
    added = partial.groupBy("cluster").agg(F.sum(F.col("n").cast(wide)).alias("n"),
                                           *(F.sum(F.col("s")[d].cast(wide)).alias(f"s{d}") for d in range(dims)))
    out = centroids.copy()
    for r in added.collect():
        out[r["cluster"]] = [int(r[f"s{d}"]) // int(r["n"]) for d in range(dims)]
    return out


def first_centroids(rows: DataFrame, clusters: int, scale: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of ``seed:key``, in hash order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("k").cast("string"), F.lit("")))
    taken = rows.withColumn("h", F.sha2(name, 256)).orderBy("h", "v").limit(clusters).collect()
    return whole(np.array([r["v"] for r in taken], dtype=np.float64), scale)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, dims: int = DIMS,
            scale: int = SCALE, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(key, cluster, distance) per kept vector, stored, and the final centroids."""
    rows = kept(vectors, key, vector, dims)
    centroids = first_centroids(rows, clusters, scale, seed)
    parts = stored(blocks(rows, dims, scale), "vector-blocks")
    if len(centroids):
        for _ in range(rounds):
            centroids = recentred(parts, centroids)
    final = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.to_pylist():
                number, distance = nearest(block, final)
                yield pa.RecordBatch.from_arrays([pa.array(block["ids"], pa.int64()), pa.array(number.astype(np.int32)), pa.array(distance)],
                                                 names=["k", "cluster", "distance"])

    found = parts.mapInArrow(run, "k long, cluster int, distance long")
    return stored(found, "vector-clusters").withColumnRenamed("k", key), centroids


def described(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row per centroid that has vectors: cluster, cluster_inertia, inertia, centroid_sha256."""
    spark = found.sparkSession
    each = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    total = sum(each.values())
    return spark.createDataFrame([(k, d, total, hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest())
                                  for k, d in sorted(each.items())],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.join(F.broadcast(described(found, centroids)), "cluster").select(  # at most CLUSTERS rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    def nearest_of(c: str) -> str:
        far = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        return f"(select v.id, v.vec_id, v.e, arg_min(c.k, ({far}, c.k)) as k, min({far}) as d from v, {c} c group by all)"

    text = f"""
with x as materialized (
  select vec_id, list_transform(cast(embedding as double[]), lambda y: floor({SCALE} * y)::bigint) as e from embeddings
  where len(embedding) = {DIMS} and list_bool_and(list_transform(embedding, lambda y: y is not null and isfinite(y)))),
v as materialized (select row_number() over (order by vec_id, e) as id, vec_id, e from x),
c0 as materialized (
  select row_number() over (order by h, e) - 1 as k, e from (select sha256('{SEED}:' || coalesce(vec_id::varchar, '')) as h, e from v)
  order by h, e limit {CLUSTERS})"""
    for r in range(ROUNDS):
        text += f""",
a{r} as materialized {nearest_of(f'c{r}')},
m{r} as materialized (
  select k, list((s - ((s % n) + n) % n) // n order by d) as e from (
    select k, d, sum(x)::bigint as s, count(*) as n from (
      select k, unnest(e) as x, unnest(range(1, {DIMS + 1})) as d from a{r}) group by k, d) group by k),
c{r + 1} as materialized (select c.k, coalesce(m.e, c.e) as e from c{r} c left join m{r} m on m.k = c.k)"""
    return text + f""",
f as materialized {nearest_of(f'c{ROUNDS}')}
select f.vec_id, f.k::int as cluster, f.d::bigint as distance, (sum(f.d) over (partition by f.k))::bigint as cluster_inertia,
       (sum(f.d) over ())::bigint as inertia, sha256(array_to_string(c.e, ',')) as centroid_sha256
from f join c{ROUNDS} c on c.k = f.k
"""


OP13_SQL = _sql()
