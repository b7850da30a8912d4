"""Helpers shared by the operators: table reads, shared-folder tables, Arrow text access, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.session import checkpoint_dir, ship_package

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of an input table (extra columns never reach the operator)."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends at files every executor can read."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column (null stays None)."""
    return column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()


def sliced(batches: Iterator[pa.RecordBatch], column: str, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches to at most ``rows`` rows, so that per-batch Python state stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_HELD: dict[str, object] = {}


def held(key: object, make: Callable[[], T]) -> T:
    """State that a worker process keeps between tasks (remembered words and the like). A worker holds one at a
    time: asking with another key drops the last, so operators that follow each other don't add up."""
    if _HELD.get("key") != key:
        _HELD.clear()
        _HELD.update(key=key, value=make())
    return _HELD["value"]  # type: ignore[return-value]


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components of ``edges(src, dst)`` (any orderable type): rows (node, component), where
    component is the smallest node reachable.

    Alternating large-star / small-star rounds; each round is two aggregations, and the edge table of
    each round is written to the shared folder. Nodes without an edge are not in the result.
    Hubs: the star rounds aggregate the minimum per node with map-side combining, and the one-to-many
    join of a hub's neighbours with its minimum is a plain join that adaptive execution may split.
    """

    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("src").alias("u"), F.col("dst").alias("v")).union(
            e.select(F.col("dst").alias("u"), F.col("src").alias("v"))) if large else e.select(
            F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        linked = both.join(low, "u").select("u", "v", F.least("m", "u").alias("m"))
        if large:
            return linked.where("v > u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        return linked.select(F.col("v").alias("src"), F.col("m").alias("dst")).union(
            linked.select(F.col("u").alias("src"), F.col("m").alias("dst")))

    def digest(e: DataFrame) -> tuple:
        # an order-free digest of the edge set, without collecting it
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    current = stored(edges.select("src", "dst").where("src <> dst").distinct(), "edges")
    seen = digest(current)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        big = stars(current, True).where("src <> dst").distinct()
        current = stored(stars(big, False).where("src <> dst").distinct(), "edges")
        now = digest(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.union(roots).distinct()
