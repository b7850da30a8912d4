"""Personal data: base patterns, then bootstrapped contextual extraction. DataFrame and SQL functions only.

Base spans (leftmost, non-overlapping per kind; failing matches are dropped, not retried):
email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip: four dotted numbers, each at most 255; card:
13 to 19 digits, single spaces or hyphens between, passing Luhn; phone: ``+``, 9 to 15 digits. The patterns
below say the same with possessive repeats and start anchors, so that no text makes them backtrack or
overflow the matcher's stack. Positions come from the lengths of the pieces between matches.

Bootstrapping: base values are seeds. A mention has two lexical patterns, lower-cased and with digits as 9: the two
tokens that end right before it (the last one a word), and the word before it with the word after it. A mention
without a second token on its left and a word on its right has none. Candidate instances are all tokens of six or more characters with a
digit (punctuation that ends them left out), and series: two to ten tokens with a digit and capitals at most,
single spaces between, the first shorter than six characters (national phone numbers, spaced card and account
numbers). What overlaps a base span is no candidate. The graph of distinct (pattern, instance) edges is scored in
``ROUNDS`` rounds, by aggregations only: a pattern's confidence for a kind is the mean score of its instances, so those
that are no instances of the kind count against it, and it is trusted from MIN_CONFIDENCE and MIN_SUPPORT instances; an
instance's score is the noisy-or of its trusted patterns, and seeds stay at 1. An instance's shape (each capital A,
small letter a, digit 9) has to agree: of all distinct instances of the shape, wherever they stand, SHAPE_SHARE or more
have to reach MIN_SCORE in the kind, or the instance scores 0. So dates and counts, which stand in many contexts, are
not taken for identifiers where one of them stands in a trusted one. Candidates that reach MIN_SCORE in a kind become
spans of that kind (of several: the one of highest score, ties: the last by name), unless they lie in
a longer one. Found instances support patterns in the next round, so patterns without seeds can be learned.

Defined results: null and empty texts have no spans; repeated rows repeat (an instance counts once per
pattern, however often it occurs, so copies add no evidence); a null doc_id is an ordinary row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import stored, table

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_CONFIDENCE = 0.9
MIN_SUPPORT = 5
MIN_SCORE = 0.9
SHAPE_SHARE = 0.5
CONTEXT = 64  # characters on either side of a mention that may hold its patterns
BLOCK = 64  # positions are summed in blocks of this many matches
_TOKEN = r"[A-Z]{0,4}+-?+[0-9][A-Z0-9./-]*+(?![A-Za-z0-9_@]|[%+][A-Za-z0-9])"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "candidate": r"(?<![A-Za-z0-9._/+@%-])(?=[A-Za-z0-9._/+@%-]{6})[A-Za-z._/+@%-]*+[0-9][A-Za-z0-9._/+@%-]*+",
    "series": rf"(?<![A-Za-z0-9._/+@%-])(?:\([0-9]{{1,5}}\)\x20?{_TOKEN}(?:\x20{_TOKEN}){{0,8}}+"
              rf"|(?![A-Z0-9./-]{{6}}){_TOKEN}(?:\x20{_TOKEN}){{1,9}}+)",
}
CANDIDATES = ("candidate", "series")
# what a text must contain for a pattern to be tried at all
NEEDS = {"email": "text like '%@%'", "ip": "text rlike '[0-9][.][0-9]'", "card": "text rlike '[0-9]'",
         "phone": "text like '%+%'", "candidate": "text rlike '[0-9]'", "series": "text rlike '[0-9][)]? ?[A-Z-]*[0-9]'"}
_BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
_LUHN = """aggregate(sequence(1, length(d)), 0, (s, i) -> s + if(i % 2 = 1, cast(substring(d, length(d) - i + 1, 1) as int),
    if(substring(d, length(d) - i + 1, 1) >= '5', 2 * cast(substring(d, length(d) - i + 1, 1) as int) - 9,
       2 * cast(substring(d, length(d) - i + 1, 1) as int)))) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": rf"s.value rlike r'^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$'",
    "card": f"exists(array(regexp_replace(s.value, '[ -]', '')), d -> {_LUHN})",
    "phone": "length(regexp_replace(s.value, '[^0-9]', '')) between 9 and 15",
    "candidate": "length(s.value) >= 6",
    "series": "length(regexp_replace(s.value, '[^A-Z0-9]', '')) >= 6",
}
_TRIMMED = "regexp_replace(m, '(?<![._/+@%-])[._/+@%-]++$', '')"
_LEFT = r"((?:(?<!\\S)\\S++\\s++)?+(?<!\\S)[^\\p{L}\\s]*+\\p{L}[\\p{L}_-]*+[^\\p{L}\\s]*+\\s*+[^\\p{L}\\s]*+)$"
_RIGHT = r"^[^\\p{L}\\s]*+\\s*+[^\\p{L}\\s]*+(\\p{L}[\\p{L}_-]*+)"


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as a column ``row`` plus one array per kind (and ``CANDIDATES``) of (start, end, value, left, right)."""
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("row"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kinds = (*KINDS, *CANDIDATES)
    for k in kinds:  # matches, then the pieces between them
        out = out.withColumn(f"m_{k}", F.when(F.expr(NEEDS[k]), F.regexp_extract_all("text", F.lit(PATTERNS[k]), 0)))
        out = out.withColumn(f"m_{k}", F.coalesce(f"m_{k}", F.array().cast("array<string>")))
    out = out.select("row", *(f"m_{k}" for k in kinds), *(
        F.when(F.size(f"m_{k}") > 0, F.split("text", PATTERNS[k], -1)).alias(f"g_{k}") for k in kinds))
    out = out.select("*", *(F.expr(
        f"if(g_{k} is null, null, transform(m_{k}, (m, i) -> cast(length(g_{k}[i]) + length(m) as int)))").alias(f"l_{k}")
        for k in kinds))
    out = out.select("*", *(F.expr(  # sums of whole blocks
        f"""if(l_{k} is null, null, transform(sequence(0, size(l_{k}) div {BLOCK}),
        c -> aggregate(slice(l_{k}, cast(c * {BLOCK} + 1 as int), {BLOCK}), 0, (a, x) -> a + x)))""").alias(f"s_{k}") for k in kinds))
    out = out.select("*", *(F.expr(  # what lies before each block
        f"if(s_{k} is null, null, transform(s_{k}, (x, c) -> aggregate(slice(s_{k}, 1, c), 0, (a, y) -> a + y)))").alias(f"b_{k}")
        for k in kinds))
    out = out.select("row", *(F.expr(f"""
        if(b_{k} is null, array(), transform(m_{k}, (m, i) -> struct(
            b_{k}[cast(i div {BLOCK} as int)] + aggregate(slice(l_{k}, cast(i div {BLOCK} as int) * {BLOCK} + 1, i % {BLOCK}), 0, (a, x) -> a + x)
                + length(g_{k}[i]) as start, {_TRIMMED if k in CANDIDATES else "m"} as value,
            regexp_extract(lower(substring(g_{k}[i], -{CONTEXT}, {CONTEXT})), '{_LEFT}', 1) as left,
            regexp_extract(lower(substring(g_{k}[i + 1], 1, {CONTEXT})), '{_RIGHT}', 1) as right)))""").cast(
        "array<struct<start:int,value:string,left:string,right:string>>").alias(k) for k in kinds))
    out = out.select("row", *(F.expr(
        f"""transform(filter({k}, s -> {VALID[k]}), s -> struct(s.start as start, s.start + length(s.value) as end,
        s.value as value, regexp_replace(regexp_replace(s.left, '\\\\s+', ' '), '[0-9]+', '9') as left, s.right as right))""").alias(k) for k in kinds))
    free = " and ".join(f"not exists({k}, s -> s.start < c.end and c.start < s.end)" for k in KINDS)
    return out.select("row", *KINDS, *(F.expr(f"filter({k}, c -> {free})").alias(k) for k in CANDIDATES))


def _edges(found: DataFrame) -> DataFrame:
    """Distinct (pattern, instance) edges of all mentions; a mention without a pattern keeps its instance with a null one."""
    mentions = found.select(F.explode(F.concat(*KINDS, *CANDIDATES)).alias("s")).select(
        F.col("s.value").alias("value"), F.col("s.left").alias("left"), F.col("s.right").alias("right"))
    two = F.when(F.trim("left").contains(" "), F.concat(F.lit("before "), "left"))
    last = F.regexp_extract("left", r"(\S+\s*)$", 1)
    around = F.when((last != "") & (F.col("right") != ""), F.concat(F.lit("around "), last, F.lit("|"), "right"))
    return mentions.select("value", F.explode_outer(F.array_compact(F.array(two, around))).alias("pattern")).distinct()


def _shape(value: str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "9")


def _seeds(found: DataFrame) -> DataFrame:
    """Distinct (instance, kind) of the base spans."""
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["value"].alias("value"), F.lit(kind).alias("kind")))

    return found.select(F.explode(F.concat(*map(named, KINDS))).alias("s")).select("s.value", "s.kind").distinct()


def bootstrap(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind, score) of instances that trusted patterns find."""
    edges, seeds = stored(edges, "pii-edges"), stored(seeds.withColumn("score", F.lit(1.0)), "pii-seeds")
    shapes = edges.select("value").distinct().groupBy(_shape("value").alias("shape")).agg(F.count(F.lit(1)).alias("all"))
    edges = edges.where("pattern is not null")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    instances = seeds
    for _ in range(rounds):
        weight = edges.join(instances, "value").groupBy("pattern", "kind").agg(
            F.sum("score").alias("sum"), F.sum((F.col("score") >= MIN_SCORE).cast("long")).alias("support"))
        trusted = weight.join(sizes, "pattern").where(
            (F.col("sum") >= MIN_CONFIDENCE * F.col("n")) & (F.col("support") >= MIN_SUPPORT)).select(
            "pattern", "kind", (F.col("sum") / F.col("n")).alias("confidence"))
        missed = F.log(F.lit(1.0) - F.least(F.col("confidence"), F.lit(1 - 1e-9)))
        grown = edges.join(trusted, "pattern").groupBy("value", "kind").agg(
            (F.lit(1.0) - F.exp(F.sum(missed))).alias("score"))
        grown = grown.join(seeds.select("value").distinct(), "value", "left_anti").withColumn("shape", _shape("value"))
        grown = stored(grown, "pii-grown")
        agreed = grown.where(F.col("score") >= MIN_SCORE).groupBy("shape", "kind").agg(F.count(F.lit(1)).alias("in")).join(
            shapes, "shape").where(F.col("in") >= SHAPE_SHARE * F.col("all")).select("shape", "kind")
        grown = grown.join(agreed, ["shape", "kind"], "left_semi")
        instances = stored(seeds.union(grown.select("value", "kind", "score")), "pii-instances")
    best = instances.join(seeds.select("value").distinct(), "value", "left_anti").where(F.col("score") >= MIN_SCORE)
    return best.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("b")).select("value", "b.kind", "b.score")


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the other columns of docs), an array of base spans per kind, and ``discovered``: further spans
    (kind, start, end) found by context."""
    found = stored(spans(docs, text).withColumn("rid", F.monotonically_increasing_id()), "pii-spans")
    learned = bootstrap(_edges(found), _seeds(found))
    mentions = found.select("rid", F.explode(F.concat(*CANDIDATES)).alias("s")).select(
        "rid", F.col("s.value").alias("value"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    extra = mentions.join(learned, "value").groupBy("rid").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("discovered"))
    joined = found.drop(*CANDIDATES).join(extra, "rid", "left")
    longest = "not exists(discovered, e -> e.start <= d.start and d.end <= e.end and e.end - e.start > d.end - d.start)"
    return joined.select("row", *KINDS, F.expr(
        f"if(discovered is null, array(), filter(discovered, d -> {longest}))").cast(
        "array<struct<kind:string,start:int,end:int>>").alias("discovered"))


def _digest(with_discovered: bool) -> Column:
    """kind:start:end of the spans by kind, then start, comma-joined."""
    def listed(kind: str) -> Column:
        own = F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        if with_discovered:
            more = F.filter("discovered", lambda d: d["kind"] == kind)
            own = F.array_sort(F.concat(own, F.transform(more, lambda d: F.struct(d["start"].alias("start"), d["end"].alias("end")))))
        return F.transform(own, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))

    return F.array_join(F.concat(*map(listed, KINDS)), ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("row.doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
                        F.sha2(_digest(False), 256).alias("base_sha256"), _digest(True).alias("spans"))
