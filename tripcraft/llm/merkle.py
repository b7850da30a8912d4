"""Merkle manifest of a table: a digest per row, a hash tree per group, a tree over the groups, a proof per row.

A row's leaf is the SHA-256 of its fields (``-`` for null, else UTF-8 byte count, ``:``, value). Inside a group
the leaves stand in key order; while several nodes remain, every ``fanout`` consecutive ones (the last run may
be shorter, even one) become the SHA-256 of their hex digests. The groups' subroots, in group order (null
first, bytes), become the root the same way.

Tree: rows carry their position in the group, and blocks of ``fanout ** levels`` consecutive positions are
window partitions. The node of level k stands in the row of its first leaf, so siblings are ``fanout ** k`` rows
apart: per level, lag and lead columns at fixed offsets, masked by the node's slot and the run's length, give
the siblings, and first-child rows hash the parent. All levels of a tier share one exchange and one sort; the
blocks' tops are the nodes of the next tier, a thousandth of the rows. A row's ancestor at a level is the last
node row before it, so one more window collects the row's path. Positions come from range partitions and a
small table of their row counts, so a group with most of the rows is many tasks.

Defined results: null keys come first; equal keys stand in order of their leaves, and fully equal rows are
interchangeable; null fields, empty and long texts are plain values of a leaf; a row without proof steps (one
row in one group) has an empty path, and its leaf is the root; an empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcraft.llm.common import stored, table
from tripcraft.operators.explore import join_small

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = 1024  # most rows of a window partition
TAMPERED = 7


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``pos`` (0-based position in their group by ``order``, nulls first) and ``n`` (rows of the group).

    Range partitions, so that a group may span many tasks; the positions in a partition come from its sorted
    rows, those before it from a table of one row per (partition, group)."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = stored(ranged.withColumn("_mid", F.monotonically_increasing_id()), "merkle-ranges").withColumn(
        "_part", F.shiftright("_mid", 33))
    parts = ranged.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_mid").alias("_first"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(group, "_part", F.sum("_rows").over(whole).alias("n"),
                         (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return join_small(ranged, parts, [group, "_part"]).withColumn("pos", F.col("_mid") + F.col("_shift")).drop(
        "_mid", "_part", "_shift")


def climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``levels`` levels over nodes (g, pos, n, h): adds ``path`` (siblings left and right of the row's ancestor at
    each level that still has several nodes) and, in the first row of a block, ``top`` (the block's digest)."""
    span = fanout ** levels
    block = Window.partitionBy("g", "_block").orderBy("pos")
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    out = nodes.withColumns({"top": F.col("h"), "_block": F.floor(F.col("pos") / span)})
    for k in range(levels):
        step = fanout ** k
        at, here = F.floor(F.col("pos") / step), F.ceil(F.col("n") / step)  # node number, nodes of this level
        slot = at % fanout
        run = F.least(F.lit(fanout), here - at + slot)
        node, several = F.col("pos") % step == 0, here > 1
        left = [F.when(slot >= j, F.lag("top", j * step).over(block)).otherwise("") for j in range(fanout - 1, 0, -1)]
        right = [F.when(slot + j < run, F.lead("top", j * step).over(block)).otherwise("") for j in range(1, fanout)]
        out = out.withColumns({"_left": F.concat(*left), "_right": F.concat(*right)})
        first = F.col("pos") % (step * fanout) == 0
        out = out.withColumns({
            f"_s{k}": F.when(node & several, F.struct(F.col("_left").alias("left"), F.col("_right").alias("right"))),
            "top": F.when(first, F.when(several, digest(F.col("top"), F.col("_right"))).otherwise(F.col("top")))})
    steps = F.array(*(F.last(f"_s{k}", ignorenulls=True).over(so_far) for k in range(levels)))
    return out.withColumn("path", F.filter(steps, lambda s: s.isNotNull())).drop(
        "_left", "_right", "_block", *(f"_s{k}" for k in range(levels)))


def tree(nodes: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Trees over nodes (g, pos, n, h and more): the nodes with their paths, and (g, top) per group."""
    span = fanout ** levels
    tier = stored(climb(nodes, fanout, levels), "merkle-tier")
    most = tier.agg(F.max("n")).first()[0]
    if most is None or most <= span:
        return tier.drop("top"), tier.where("pos = 0").select("g", "top")
    above = tier.where(F.col("pos") % span == 0).select(
        "g", F.floor(F.col("pos") / span).alias("pos"), F.ceil(F.col("n") / span).alias("n"), F.col("top").alias("h"))
    upper, tops = tree(above, fanout, levels)
    upper = upper.select("g", F.col("pos").alias("_block"), F.col("path").alias("_more"))
    joined = tier.drop("top").withColumn("_block", F.floor(F.col("pos") / span)).join(upper, ["g", "_block"])
    return joined.withColumn("path", F.concat("path", "_more")).drop("_block", "_more"), tops


def manifest(leaves: DataFrame, fanout: int = 2) -> DataFrame:
    """From rows (grp, key, leaf and more): adds subroot, root and path (the proof's steps, leaf to root)."""
    levels = max(k for k in range(1, 64) if fanout ** k <= max(BLOCK, fanout))
    # a group name without null that sorts like the group, nulls first
    named = leaves.withColumns({"g": F.coalesce(F.concat(F.lit("="), "grp"), F.lit("")),
                                "tie": F.monotonically_increasing_id(), "h": F.col("leaf")})
    rows = numbered(stored(named, "merkle-leaves"), "g", ["key", "leaf", "tie"]).drop("tie")
    inside, tops = tree(rows, fanout, levels)
    groups = numbered(tops.select(F.lit("").alias("all"), F.col("g").alias("h0"), "top"), "all", ["h0"])
    over, root = tree(groups.select(F.col("all").alias("g"), "pos", "n", F.col("top").alias("h"), "h0"), fanout, levels)
    found = root.first()
    over = over.select(F.col("h0").alias("g"), F.col("h").alias("subroot"), F.col("path").alias("_over"))
    return join_small(inside, over, ["g"]).withColumns({
        "root": F.lit(found["top"] if found else None).cast("string"), "path": F.concat("path", "_over")}).drop("g", "pos", "n", "h", "_over")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of the path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    return digest(*(encoded(f) for f in fields))


def prove(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = FIELDS, changed: dict[str, Column] | None = None,
          where: Column | None = None, fanout: int = 2) -> DataFrame:
    """Manifest of a table with a check of claimed rows: per row key, leaf, subroot, root, path, proof_sha256,
    folded_root (from the claimed row's leaf and the manifest's path) and verified. The claimed rows are the
    rows themselves, but with the columns ``changed`` in the rows that meet ``where``."""
    claimed = leaf_of([(changed or {}).get(f, F.col(f)) for f in fields])
    rows = docs.select(F.col(group).alias("grp"), F.col(key).alias("key"), leaf_of([F.col(f) for f in fields]).alias("leaf"),
                       F.when(F.coalesce(where, F.lit(False)), claimed).alias("claim") if where is not None
                       else F.lit(None).cast("string").alias("claim"))
    out = manifest(rows, fanout).withColumns({
        "proof_sha256": proof_digest(F.col("path")), "folded_root": folded(F.coalesce("claim", "leaf"), F.col("path"))})
    return out.select(F.col("key").alias(key), "leaf", "subroot", "root", "path", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return prove(docs, changed={"n_chars": F.try_add(F.col("n_chars"), F.lit(1))}, where=hit).drop("path")


def _sql() -> str:
    def leaf(n_chars: str) -> str:
        fields = ["doc_id::varchar", "source", "lang", f"({n_chars})::varchar", "text"]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    def levels(name: str, base: str) -> str:
        # level k of every group: its nodes in order, and the nodes of the level
        return f"""{name} as (
  select g, 0 as level, pos, n, h from {base}
  union all
  select g, level + 1, pos // 2, (n + 1) // 2, sha256(h || coalesce(next, ''))
  from (select *, lead(h) over (partition by g order by pos) as next from {name} where n > 1) where pos % 2 = 0)"""

    def steps(name: str, base: str, nodes: str) -> str:
        return f"""{name} as (
  select b.id, list({{'l': case when (b.pos >> k.level) & 1 = 1 then s.h else '' end,
                      'r': case when (b.pos >> k.level) & 1 = 0 then coalesce(s.h, '') else '' end}} order by k.level) as path
  from {base} b join (select distinct g, level from {nodes} where n > 1) k on k.g = b.g
  left join {nodes} s on s.g = b.g and s.level = k.level and s.pos = xor(b.pos >> k.level, 1)
  group by b.id)"""

    low = "xor(c, b)"  # one bit of the CRC: a byte is its value and seven zeros
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
      string_split(doc_id::varchar, ''), lambda x: [ord(x)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, b: xor({low} >> 1, 3988292384 * ({low} & 1))))"""
    return f"""
with recursive leaves as materialized (
  select doc_id, coalesce('=' || lang, '') as g, {leaf('n_chars')} as h,
         case when {crc} % 7 = 0 then {leaf('n_chars + 1')} else {leaf('n_chars')} end as claim from documents),
base as materialized (
  select *, row_number() over (partition by g order by doc_id nulls first, h) - 1 as pos, count(*) over (partition by g) as n,
         row_number() over (order by g, doc_id nulls first, h) as id from leaves),
{levels('nodes', 'base')},
subroots as materialized (
  select '' as g, g as id, h, row_number() over (order by g) - 1 as pos, count(*) over () as n from nodes where n = 1),
{levels('tops', 'subroots')},
{steps('inside', 'base', 'nodes')},
{steps('over_', 'subroots', 'tops')},
whole as (
  select b.doc_id, b.h as leaf, b.claim, s.h as subroot, (select h from tops where n = 1) as root,
         list_concat(coalesce(i.path, []), coalesce(o.path, [])) as path
  from base b join subroots s on s.id = b.g left join inside i on i.id = b.id left join over_ o on o.id = b.g),
folds as (
  select *, list_reduce(list_prepend({{'l': claim, 'r': ''}}, path), lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l as folded_root
  from whole)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) as proof_sha256,
       folded_root, folded_root = root as verified from folds
"""


OP12_SQL = _sql()
