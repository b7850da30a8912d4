"""Mixing sources to target weights by hierarchical budgets.

The leaves of a domain / language / source tree hold ``avail`` tokens each and can give ``avail * max_epochs``
(their capacity; an inner node's capacity is the sum of its leaves'). The total budget goes down the tree:
among siblings it is divided by weight, a child that would get more than its capacity is filled to it, and
what it cannot take goes to its siblings by their weights. A node's shortage leaves the node only when
all its children are full, and then shows in the capacity its own siblings compete with: shortages move to
siblings before ancestors. Budgets are whole tokens; a remainder of the division stays unspent.

A leaf of budget T = e * avail + r takes e whole epochs and then the longest prefix of at most r tokens
of epoch e's order, which is by md5 of (seed, epoch, key). The cut of a leaf is found by narrowing: token
sums of 4096 hash buckets give the bucket with the cut, which is divided by the next digits in the same way while one
holds more than CUT_ROWS rows of different keys; only the last bucket's rows are put in order, summed per key first. So
no window sees more than 4096 buckets or CUT_ROWS keys, however large one source is.

Defined results: null labels form a node of their own (label ""); a null key is ordered by the md5 of the
text; rows with equal keys in a leaf are taken together; a zero weight takes nothing; documents without
tokens belong to the prefix if their place in the order does; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcraft.llm.common import stored, table

SEED = 17
MAX_EPOCHS = 2
BUCKET_HEX = 3  # 16**3 hash buckets per leaf and pass
CUT_ROWS = 4096  # rows of a bucket that are put in order
LEAVES_BROADCAST = 100_000  # cut table rows; above that the cuts are joined, not broadcast
LEVELS = ("domain", "lang", "source")
WEIGHTS: tuple[Mapping[str, int], ...] = (
    {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 4, "de": 2, "fr": 2, "es": 2}, {})


def domain_of(source: Column) -> Column:
    """Domain of a source: its trailing number modulo 4 (``d0`` to ``d3``), else ``other``."""
    digits = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.coalesce(F.when(digits != "", F.concat(F.lit("d"), (digits.cast("int") % 4).cast("string"))), F.lit("other"))


def word_count(text: Column) -> Column:
    """Tokens of a text: runs without ASCII white space (null has none)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _weight(level: int, weights: Sequence[Mapping[str, int]], label: Column) -> Column:
    given = [F.lit(x) for kv in weights[level].items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*given), label), F.lit(1)).cast("long") if given else F.lit(1).cast("long")


def _fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Divide ``given`` (the parent's budget) among siblings by weight ``w``, at most ``cap`` each: ``budget``."""
    keys = parent or [F.lit(0)]
    order = Window.partitionBy(*keys).orderBy(F.col("cap") / F.col("w"), name)
    whole = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = nodes.where("w > 0").select("*", F.row_number().over(order).alias("rn"),
                                      F.greatest(F.col("given") - before, F.lit(0)).alias("left"),
                                      F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("rest"))
    out = out.withColumn("first", F.min(F.when(F.expr("cap > left * w div rest"), F.col("rn"))).over(whole))
    at = F.col("rn") == F.col("first")
    out = out.select("*", F.max(F.when(at, F.col("left"))).over(whole).alias("l"),
                     F.max(F.when(at, F.col("rest"))).over(whole).alias("r"))
    budget = F.when(F.col("first").isNull() | (F.col("rn") < F.col("first")), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.expr("l * w div r")))
    return out.select(*parent, name, budget.cast("long").alias("budget"))


def budgets(leaves: DataFrame, total: Column | int | None = None, weights: Sequence[Mapping[str, int]] = WEIGHTS,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves(domain, lang, source, avail)`` plus ``budget``. ``total``: tokens to spend, all available by default."""
    cap = leaves.withColumn("cap", F.col("avail") * max_epochs)
    given = leaves.agg(F.coalesce(F.sum("avail"), F.lit(0)).alias("given")) if total is None else \
        leaves.sparkSession.range(1).select(F.lit(total).cast("long").alias("given"))
    above = None
    for k, name in enumerate(LEVELS):
        parent = list(LEVELS[:k])
        nodes = cap.groupBy(*parent, name).agg(F.sum("cap").alias("cap")).withColumn(
            "w", _weight(k, weights, F.col(name)))
        if above is None:  # one row of the total, read as a scalar
            nodes = nodes.withColumn("given", F.lit(given.first()[0]).cast("long"))
        else:
            nodes = nodes.join(above.withColumnRenamed("budget", "given"), parent)
        above = _fill(nodes, parent, name)
    return leaves.join(above, list(LEVELS))


def _rank(epoch: Column, key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), key))


def cuts(rows: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """Per leaf of ``rows(domain, lang, source, key, tokens)``: budget, ``epochs`` (whole ones) and the last
    (rank, key) of the prefix taken from the next epoch (null: none)."""
    on = list(LEVELS)
    leaves = stored(rows.groupBy(*on).agg(F.sum("tokens").alias("avail")), "mix-leaves")
    plan = budgets(leaves, **options).select(
        *on, "avail", "budget", F.expr("if(avail > 0, budget div avail, 0)").alias("epochs"),
        F.expr("if(avail > 0, budget % avail, 0)").alias("rest"))
    plan = stored(plan, "mix-plan")
    ranked = with_leaf(rows, plan.select(*on, "epochs", "rest")).select(
        *on, "rest", "key", "tokens", _rank(F.col("epochs"), F.col("key"), seed).alias("rank"))
    order = Window.partitionBy(*on).orderBy("bucket")
    inside, size = ranked.withColumn("before", F.lit(0).cast("long")), 0
    while True:
        size += BUCKET_HEX
        sums = inside.groupBy(*on, "rest", "before", F.substring("rank", 1, size).alias("bucket")).agg(
            F.sum("tokens").alias("n"), F.when(F.min("rank") < F.max("rank"), F.count(F.lit(1))).otherwise(0).alias("rows"))
        sums = sums.select(*on, "bucket", "rest", "rows", (F.col("before") + F.sum("n").over(order) - F.col("n")).alias("before"),
                           (F.col("before") + F.sum("n").over(order)).alias("upto"))
        # the bucket of the cut: the first whose sum passes the budget; leaves without one take all (rest = 0 if full)
        cut = sums.where("upto > rest").groupBy(*on).agg(F.min(F.struct("bucket", "before", "rows")).alias("b"))
        cut = stored(cut.select(*on, "b.bucket", "b.before", "b.rows"), "mix-buckets")
        inside = with_leaf(ranked, cut.select(*on, "before", F.col("bucket").alias("at"))).where(F.substring("rank", 1, size) == F.col("at"))
        if size >= 30 or (cut.agg(F.max("rows")).first()[0] or 0) <= CUT_ROWS:
            break
    inside = inside.groupBy(*on, "rest", "before", "rank", "key").agg(F.sum("tokens").alias("n"))
    line = Window.partitionBy(*on).orderBy("rank", "key")
    last = inside.select(*on, "rank", "key", (F.col("before") + F.sum("n").over(line)).alias("upto"), "rest").where(
        "upto <= rest").groupBy(*on).agg(F.max(F.struct("rank", "key")).alias("last"))
    return stored(plan.join(cut, on, "left").join(last, on, "left").select(
        *on, "budget", "epochs", F.col("bucket").alias("cut_bucket"), F.col("last.rank").alias("last_rank"),
        F.col("last.key").alias("last_key")), "mix-cuts")


def with_leaf(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """Join a row per leaf to the rows: broadcast if its checked size allows, else a join that may be split."""
    small = leaves.limit(LEAVES_BROADCAST + 1).count() <= LEAVES_BROADCAST
    return rows.join(F.broadcast(leaves) if small else leaves, list(LEVELS))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
        domain: Column | None = None, tokens: Column | None = None, seed: int = SEED, **options) -> DataFrame:
    """The taken rows of ``docs`` as a column ``row``, with domain, lang, source (labels), ``tokens``, ``budget`` of
    the leaf and ``n_epochs`` (how often the row is taken, 1 or more)."""
    def of(name: str) -> Column:
        return F.col(f"row.`{name}`")

    body = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    label = F.coalesce(of(source).cast("string"), F.lit(""))
    body = body.select("row", (domain_of(label) if domain is None else domain).alias("domain"),
                       F.coalesce(of(lang).cast("string"), F.lit("")).alias("lang"), label.alias("source"),
                       F.coalesce(of(key).cast("string"), F.md5(of(text)), F.lit("")).alias("key"),
                       (word_count(of(text)) if tokens is None else tokens).alias("tokens"))
    rows = stored(body.select(*LEVELS, "key", "tokens"), "mix-rows")
    found = with_leaf(body, cuts(rows, seed, **options))
    rank = _rank(F.col("epochs"), F.col("key"), seed)
    head = F.substr(rank, F.lit(1), F.length("cut_bucket"))
    prefix = F.when(F.col("cut_bucket").isNull(), F.lit(True)).otherwise(
        (head < F.col("cut_bucket")) | ((head == F.col("cut_bucket")) & F.coalesce(
            F.struct(rank, F.col("key")) <= F.struct("last_rank", "last_key"), F.lit(False))))
    times = F.col("epochs") + prefix.cast("long")
    return found.withColumn("n_epochs", times).where("n_epochs > 0").select(
        "row", *LEVELS, "tokens", "budget", "n_epochs")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as their leaf's epochs take them."""
    return mix(docs, **options).select("row", F.explode(F.sequence(F.lit(1), F.col("n_epochs")))).select("row.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    found = mix(docs)
    return found.select(F.col("row.doc_id").alias("doc_id"), *LEVELS, F.col("tokens").alias("n_tokens"), "budget", "n_epochs")


def _sql_level(k: int) -> str:
    """One level of the budget division as SQL: tables fill_k(labels..., budget)."""
    on, name = list(LEVELS[:k + 1]), LEVELS[k]
    parent = ", ".join(LEVELS[:k]) or "1"
    case = " ".join(f"when '{a}' then {b}" for a, b in WEIGHTS[k].items())
    weight = f"case {name} {case} else 1 end" if case else "1"
    given = ("(select sum(avail) from leaves)" if k == 0 else "budget")
    source = "leaves" if k == 0 else f"leaves join f{k - 1} using ({parent})"
    extra = "" if k == 0 else ", any_value(budget) as budget"
    labels = ", ".join(on)
    return f"""
n{k} as (select *, {given} as given, {weight} as w
         from (select {labels}, sum(avail) * {MAX_EPOCHS} as cap{extra} from {source} group by {labels})),
o{k} as (select *, row_number() over o as rn,
           greatest(given - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0), 0) as left_,
           sum(w) over (o rows between current row and unbounded following) as rest
         from n{k} where w > 0 window o as (partition by {parent} order by cast(cap as double) / w, {name})),
p{k} as (select *, min(case when cap > left_ * w // rest then rn end) over (partition by {parent}) as first_ from o{k}),
q{k} as (select *, max(case when rn = first_ then left_ end) over (partition by {parent}) as l,
           max(case when rn = first_ then rest end) over (partition by {parent}) as r from p{k}),
f{k} as (select {labels}, case when first_ is null or rn < first_ then cap else least(cap, l * w // r) end as budget
         from q{k})"""


OP7_SQL = rf"""
with d as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         coalesce(cast(doc_id as varchar), md5(text), '') as key,
         len(coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])) as tokens,
         case when regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' then 'other'
              else 'd' || (cast(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) as int) % 4) end as domain
  from documents),
leaves as (select domain, lang, source, cast(sum(tokens) as bigint) as avail from d group by all),
{",".join(_sql_level(k) for k in range(3))},
plan as (select domain, lang, source, budget, case when avail > 0 then budget // avail else 0 end as epochs,
                case when avail > 0 then budget % avail else 0 end as rest
         from leaves join f2 using (domain, lang, source)),
taken as (select d.*, budget, epochs, rest, sum(tokens) over (partition by domain, lang, source
            order by md5('{SEED}:' || epochs || ':' || key), key range between unbounded preceding and current row) as upto
          from d join plan using (domain, lang, source))
select doc_id, domain, lang, source, cast(tokens as bigint) as n_tokens, cast(budget as bigint) as budget,
       cast(epochs + case when upto <= rest then 1 else 0 end as bigint) as n_epochs
from taken where epochs + case when upto <= rest then 1 else 0 end > 0
"""
