"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Each usable vector is normalised, x = v / |v|, and stored as int8 codes q and a scale s with the exact norm
e = |x - s q| of what was lost. For two vectors x.y = s t (p.q) + (remainder), and by Cauchy-Schwarz
|x.y - s t (p.q)| <= e + f + e f when |x| = |y| = 1 (plus a margin for rounding). A tile product multiplies
the codes of two blocks of ``TILE`` vectors; integer sums are exact in 32-bit floats up to 2**24, so the
product runs at matrix-multiply speed. A pair below the threshold by the bound is no link, one above it by the bound
is one; only pairs in between (some hundredths of cosine around the threshold) are computed again from the original
components in double precision, and that value decides.

Every pair of blocks is one group of the shuffle (a block goes to every group it is part of, as codes, scale, error,
number and multiplicity: no doubles), so all rows meet all rows, in blocks of bounded size, and no group depends on
labels or on skew. A group returns counts per vector and a spanning forest of its sure links, not the links, so groups
of copies with n members cost n rows, not n * n. Its open pairs are one row per vector with the numbers of the
others; a second pass brings the doubles of just the vectors in open pairs to the group, once each, and returns counts
and a forest again. At most TILE * TILE pairs are open in a group, in 8 bytes each.

Exact copies (same components) are one vector with a multiplicity before the products.

Defined results: null or zero vectors, and vectors with null or non-finite components, link with nothing and
are kept; rows that repeat a vec_id count as vectors of their own and share the id's component; a null vec_id
is a vector that is never a component id unless its component has no other; vectors of different length
never link; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import components, sliced, stored, table

THRESHOLD = 0.9
TILE = 4096  # vectors per block
STRIP = 1024  # rows of a tile product in memory at a time
MARGIN = 1e-6  # covers the rounding of norms, scales and the double-precision products


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (int8), scales and error norms of unit row vectors."""
    top = np.abs(x).max(axis=1)
    scale = np.where(top > 0, top / 127.0, 1.0)
    codes = np.rint(x / scale[:, None])
    return codes.astype(np.int8), scale, np.linalg.norm(x - codes * scale[:, None], axis=1)


def encode(vectors: DataFrame) -> DataFrame:
    """``vectors(vid, v, n)`` -> (vid, n, codes, scale, error, raw (the doubles)); codes have a byte per component."""
    schema = "vid long, n long, codes binary, scale double, error double, raw binary"
    arrow = pa.schema([("vid", pa.int64()), ("n", pa.int64()), ("codes", pa.binary()), ("scale", pa.float64()),
                       ("error", pa.float64()), ("raw", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "v", 2000):
            rows = []
            for vid, n, v in zip(b.column("vid").to_pylist(), b.column("n").to_pylist(), b.column("v"), strict=True):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                unit = (x / np.abs(x).max())[None, :]  # no overflow in the norm
                unit /= np.linalg.norm(unit)
                codes, scale, error = quantise(unit)
                rows.append((vid, n, codes.tobytes(), float(scale[0]), float(error[0]), x.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)],
                                                 schema=arrow)

    return vectors.mapInArrow(run, schema)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def tile_links(a: dict, b: dict, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers (in a, in b) of all pairs that the bound does not rule out, and which of them it makes sure of; for
    a block with itself only pairs above the diagonal."""
    exact = np.float32 if a["codes"].shape[1] * 127 * 127 < 1 << 24 else np.float64
    ca, cb = a["codes"].astype(exact), b["codes"].astype(exact)
    for at in range(0, len(ca), STRIP):
        part = slice(at, min(at + STRIP, len(ca)))
        first = at + 1 if same else 0  # columns below hold only pairs seen from the other side
        if first >= len(cb):
            break
        dots = ca[part] @ cb[first:].T
        # s t (p.q) + e + f + e f >= threshold, with (1 + e)(1 + f) - 1 for the errors: first by the largest
        # scale and error of the other block, one comparison a pair, then by each pair's own
        s, t, e, f = a["scale"][part], b["scale"][first:], 1 + a["error"][part], 1 + b["error"][first:]
        least = (threshold - MARGIN + 1 - e * f.max()) / (s * t.max())
        i, j = np.nonzero(dots >= (least - 1e-5 * np.abs(least)).astype(exact)[:, None])
        likely, lost = dots[i, j] * s[i] * t[j], e[i] * f[j] - 1
        own = likely + lost >= threshold - MARGIN
        if same:
            own &= j + first > i + at
        yield i[own] + at, j[own] + first, (likely - lost)[own] >= threshold + MARGIN


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]], counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Roots of a union-find over all links (n nodes); adds each link's multiplicities to ``counts``."""
    root = np.arange(n)

    def roots(x: np.ndarray) -> np.ndarray:
        while True:
            up = root[root[x]]
            if (up == root[x]).all():
                return up
            root[x] = up

    for p, q in links:
        np.add.at(counts, p, weight[q])
        np.add.at(counts, q, weight[p])
        while True:  # hook larger roots below smaller ones until all links of the block are inside a tree
            a, b = roots(p), roots(q)
            apart = a != b
            if not apart.any():
                break
            p, q, a, b = p[apart], q[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
    return roots(np.arange(n))


# what a group returns: a vector's links so far, or (low, high and others set) its open pairs
_LINKS = pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("vid", "int64"), ("root", "Int64"), ("links", "Int64"), ("low", "Int32"),
                                                          ("high", "Int32"), ("others", "object"))})


def _rows(ids: np.ndarray, weight: np.ndarray, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """(vid, root, links) of the vectors with a link: a root of their tree and the vectors they are linked with."""
    counts = np.zeros(len(ids), dtype=np.int64)
    root = forest(len(ids), links, counts, weight)
    hit = np.flatnonzero(counts)
    return pd.DataFrame({"vid": ids[hit], "root": ids[root[hit]], "links": counts[hit]})


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """Per row: key, n_links (other vectors linked directly), component_id (smallest key reachable), kept."""
    rows = vectors.select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v"))
    usable = F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(
        F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.select("k", F.when(usable, F.transform("v", lambda x: x + F.lit(0.0))).alias("v"))  # -0.0 is 0.0
    distinct = rows.where("v is not null").groupBy("v").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("n"))
    # vid numbers the distinct vectors; stored, so that it is the same in every later read
    each = stored(distinct.withColumn("vid", F.monotonically_increasing_id()), "vectors")
    total = each.count()
    blocks = max(1, -(-total // tile))
    coded = stored(encode(each.select("vid", "v", "n")).withColumn(
        "block", F.pmod(F.xxhash64("vid"), F.lit(blocks)).cast("int")), "vector-codes")
    pairs = coded.drop("raw").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = pairs.select("vid", "n", "codes", "scale", "error", "block", F.least("block", "other").alias("low"),
                         F.greatest("block", "other").alias("high"))

    def products(part: pd.DataFrame) -> pd.DataFrame:
        low, high = int(part["low"].iloc[0]), int(part["high"].iloc[0])
        out = []
        for dim, p in part.groupby(part["codes"].str.len()):
            p = p.sort_values("block", kind="stable")
            n = len(p)
            whole = {"codes": np.frombuffer(b"".join(p["codes"]), np.int8).reshape(n, dim), "scale": p["scale"].to_numpy(),
                     "error": p["error"].to_numpy()}
            shift = 0 if low == high else int((p["block"] == low).sum())
            a = whole if low == high else {k: x[:shift] for k, x in whole.items()}
            b = {k: x[shift:] for k, x in whole.items()}
            ids, weight, unsure = p["vid"].to_numpy(), p["n"].to_numpy(), []

            def sure() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for i, j, yes in tile_links(a, b, low == high, threshold) if len(a["codes"]) and len(b["codes"]) else ():
                    unsure.append((i[~yes].astype(np.int32), (j[~yes] + shift).astype(np.int32)))
                    yield i[yes], j[yes] + shift

            out.append(_rows(ids, weight, sure()))
            i, j = (np.concatenate([u[k] for u in unsure]) if unsure else np.zeros(0, np.int32) for k in (0, 1))
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            used = np.unique(np.concatenate([i, j]))
            starts, ends = np.searchsorted(i, used), np.searchsorted(i, used, side="right")
            out.append(pd.DataFrame({"vid": ids[used], "low": low, "high": high,
                                     "others": [ids[j[x:y]] for x, y in zip(starts, ends, strict=True)]}))
        out = [x.reindex(columns=list(_LINKS.columns)) for x in out if len(x)]
        out = [x.assign(others=x["others"].astype(object).where(x["others"].notna(), None)).astype(_LINKS.dtypes.to_dict()) for x in out]
        return pd.concat(out) if out else _LINKS

    def again(part: pd.DataFrame) -> pd.DataFrame:
        """Open pairs of a group by their doubles."""
        part = part.reset_index(drop=True)
        ids, weight, out = part["vid"].to_numpy(), part["n"].to_numpy(), []
        units = np.empty(len(part), dtype=object)
        for _, at in part.groupby(part["raw"].str.len()).groups.items():
            rows = unit_rows(np.frombuffer(b"".join(part["raw"][at]), np.float64).reshape(len(at), -1))
            for k, u in zip(at, rows, strict=True):
                units[k] = u
        order = np.argsort(ids)

        def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for k, others in enumerate(part["others"]):
                if len(others):
                    q = order[np.searchsorted(ids, others, sorter=order)]
                    q = q[np.stack(units[q].tolist()) @ units[k] >= threshold]
                    if len(q):
                        out.append((np.full(len(q), k), q))
                if sum(len(x[0]) for x in out) > 1 << 18 or (out and k == len(part) - 1):
                    yield tuple(np.concatenate([x[side] for x in out]) for side in (0, 1))
                    out.clear()

        return _rows(ids, weight, links())[["vid", "root", "links"]]

    found = stored(pairs.groupBy("low", "high").applyInPandas(
        products, "vid long, root long, links long, low int, high int, others array<long>"), "vector-pairs")
    doubles = found.where("others is not null").join(coded.select("vid", "n", "raw"), "vid")
    found = stored(found.where("others is null").select("vid", "root", "links").union(
        doubles.select("low", "high", "vid", "n", "others", "raw").groupBy("low", "high").applyInPandas(
            again, "vid long, root long, links long")), "vector-links")
    rooted = components(found.select(F.col("vid").alias("src"), F.col("root").alias("dst")))
    degree = found.groupBy("vid").agg(F.sum("links").alias("links"))
    nodes = each.select("vid", "v", "k", "n").join(degree, "vid", "left").join(
        rooted.select(F.col("node").alias("vid"), F.col("component").alias("c")), "vid", "left")
    nodes = nodes.withColumn("c", F.coalesce("c", "vid"))
    named = nodes.join(nodes.groupBy("c").agg(F.min("k").alias("component_id")), "c").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.where("v is not null").join(named, "v").select("k", "n_links", "component_id").union(
        rows.where("v is null").select("k", F.lit(0).cast("long"), "k"))
    return out.select(F.col("k").alias(key), F.col("n_links").cast("long").alias("n_links"), "component_id",
                      F.col("k").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


OP9_SQL = """
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings),
u as (select vec_id, e, sqrt(list_dot_product(e, e)) as n from v
      where e is not null and len(e) > 0 and list_bool_and(list_transform(e, lambda x: x is not null and isfinite(x)))),
l as (select a.vec_id as a, b.vec_id as b from u a, u b
      where a.vec_id <> b.vec_id and a.n > 0 and b.n > 0 and len(a.e) = len(b.e)
        and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
reach as (select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join l on r.b = l.a)
select r.a as vec_id, coalesce(any_value(d.n), 0) as n_links, min(r.b) as component_id, r.a = min(r.b) as kept
from reach r left join (select a, count(*) as n from l group by a) d on d.a = r.a group by r.a
"""
