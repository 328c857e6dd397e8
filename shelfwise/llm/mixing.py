"""Mixing sources to target weights with hash-threshold histograms.

Each document gets a hash. Words are summed by source and hash bucket; running sums over the buckets
find, for each source and budget, the bucket in which the budget is reached. Only the documents of that bucket are
counted again by the next bits of their hash, until one hash value is left. The mix is then a filter
`hash < threshold`: no sort, and a smaller budget's documents are always among a larger one's.
Whole passes over a source (repeats) come on top of the threshold. DataFrame functions only.

Nulls: a null text has size 0; a null source is a source of its own, the last; null ids are hashed by their text.
Rows with equal id and text share a hash and are taken together. A source without words has target 0. An empty table gives an empty mix.
Only the named columns are read. The per-source tables have one row per source and budget. A very long text is one document that is
taken or left whole; its size may be more than what is left of a small budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import table, words, written

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
#: Shares of the targets for which nested thresholds are found; the last is the mix itself.
BUDGETS = (0.25, 0.5, 1.0)
HASH_BITS, LEVEL_BITS = 60, 12
#: Rows of a table by source up to which it is broadcast: some 10 MB.
BROADCAST_ROWS = 100_000


def _hash() -> Column:
    """60 bits from MD5, which any SQL engine can repeat."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\t"), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: its size and target. Where equal shares would pass a source's cap, the source stays at the
    cap and the rest is shared anew; with sources ordered by cap per weight this is one pass of running sums."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(WEIGHTS)
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = total.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", F.element_at(weights, (F.col("rank") - 1) % n + 1))
    ranked = ranked.withColumn("cap", MAX_REPEAT * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = ranked.withColumn("level", level).withColumn("free", F.col("cap") > F.col("weight") * F.col("level"))
    first = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * first, F.lit(0.0)))
    return levels.withColumn("target", F.when(F.col("free"), target).otherwise(F.col("cap").cast("double"))).select("source", "source_size", "weight", "target")


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _small(per_source: DataFrame) -> DataFrame:
    """A table of a few rows per source, broadcast while it is small, so that a hot source is not dealt to one task. With more
    sources than that none of them is many tasks' work, and Spark joins by source, splitting what is skewed."""
    return F.broadcast(per_source) if per_source.count() <= BROADCAST_ROWS else per_source


def thresholds(sizes: DataFrame, goals: DataFrame, budgets: tuple[float, ...] = BUDGETS) -> DataFrame:
    """Per source and budget: whole passes `copies` and the hash `limit` below which one more copy is taken."""
    wanted = F.explode(F.array(*(F.struct(F.lit(i).alias("budget"), F.lit(float(b)).alias("share")) for i, b in enumerate(budgets))))
    state = goals.filter("source_size > 0").select("source", "source_size", "target", wanted.alias("w"))
    state = state.select("source", "w.budget", (F.col("target") * F.col("w.share")).alias("goal"), "source_size")
    copies = F.floor(F.col("goal") / F.col("source_size"))
    state = state.select(
        "source", "budget", copies.alias("copies"), (F.col("goal") - copies * F.col("source_size")).alias("rest"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("prefix")
    )
    rows = sizes.select("source", "size", "hash")
    for done in range(0, HASH_BITS, LEVEL_BITS):
        left = HASH_BITS - done
        inside = rows.alias("d").join(_small(state).alias("s"), _same_source("d", "s") & (F.shiftright("d.hash", left) == F.col("s.prefix")))
        bucket = F.shiftright("d.hash", left - LEVEL_BITS)
        counted = inside.groupBy("s.source", "s.budget", bucket.alias("bucket")).agg(
            F.sum("d.size").alias("words"), *(F.first(f"s.{c}").alias(c) for c in ("copies", "rest", "before"))
        )
        run = Window.partitionBy("source", "budget").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("start", F.col("before") + F.coalesce(F.sum("words").over(run), F.lit(0).cast("long")))
        # the boundary: the last bucket that starts within the budget
        edge = F.max_by(F.struct("copies", "rest", F.col("start").alias("before"), F.col("bucket").alias("prefix"), "words"), F.when(F.col("start") <= F.col("rest"), F.col("bucket")))
        state = placed.groupBy("source", "budget").agg(edge.alias("e")).select("source", "budget", "e.*").checkpoint()
        # only the boundary buckets' rows are read again
        edges = state.select("source", "prefix").distinct()
        rows = rows.alias("d").join(_small(edges).alias("s"), _same_source("d", "s") & (F.shiftright("d.hash", left - LEVEL_BITS) == F.col("s.prefix"))).select("d.*")
        if not done:
            rows = written(rows, "mix-boundary")
    # one hash value is left at the boundary: it is taken if that comes nearer to the goal
    take = 2 * (F.col("rest") - F.col("before")) >= F.col("words")
    return state.select("source", "budget", "copies", (F.col("prefix") + F.when(take, 1).otherwise(0)).alias("limit"))


def mix(docs: DataFrame, budgets: tuple[float, ...] = BUDGETS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: Column | None = None) -> DataFrame:
    """Per document: size, its source's size and target, copies taken and words taken for the last budget,
    and `first_budget`, the smallest budget that takes it (null: none). `carry`: one more column, named row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"), *([carry.alias("row")] if carry is not None else []))
    more = ["row"] if carry is not None else []
    sizes = written(rows.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), _hash().alias("hash"), *more), "mix-sizes")
    goals = written(targets(sizes), "mix-targets")
    limits = thresholds(sizes.drop("row"), goals, budgets)
    by_source = limits.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("budget", "copies", "limit"))).alias("limits"))
    plan = written(goals.alias("g").join(by_source.alias("l"), _same_source("g", "l"), "left").select("g.*", "l.limits"), "mix-plan")
    # where the boundary falls behind the last words, a document without words would come once more than the most
    taken = F.transform(F.coalesce("limits", F.array()), lambda x: F.least(x["copies"] + F.when(F.col("hash") < x["limit"], 1).otherwise(0), F.lit(MAX_REPEAT)))
    mixed = sizes.alias("d").join(_small(plan).alias("p"), _same_source("d", "p")).select("d.*", "p.source_size", "p.target", taken.alias("each"))
    copies = F.coalesce(F.get("each", F.lit(len(budgets) - 1)), F.lit(0)).cast("long")
    shares = F.array(*(F.lit(float(b)) for b in budgets))
    first = F.get(F.filter(F.transform("each", lambda x, i: F.when(x > 0, F.get(shares, i))), lambda x: x.isNotNull()), F.lit(0))
    return mixed.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), first.alias("first_budget"), *more)


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it."""
    rows = mix(docs, carry=F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    return rows.withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(9) || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS rank, 3 * source_size AS cap FROM s),
v AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
      FROM r WINDOW w AS (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN cap > weight * level
        THEN least(cap::DOUBLE, weight * (SELECT level FROM v WHERE cap > weight * level ORDER BY cap::DOUBLE / weight, rank LIMIT 1)) ELSE cap::DOUBLE END AS target FROM v),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM t),
g AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
b AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS start FROM g),
e AS (SELECT b.source, b.h, b.words, b.start, q.copies, q.target - q.copies * q.source_size AS rest FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source WHERE q.source_size > 0),
l AS (SELECT source, max_by(h + CASE WHEN 2 * (rest - start) >= words THEN 1 ELSE 0 END, h) AS lim FROM e WHERE start <= rest GROUP BY source)
SELECT d.doc_id, d.size, q.source_size, q.target, (d.size * (q.copies + CASE WHEN d.h < coalesce(l.lim, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN l ON l.source IS NOT DISTINCT FROM d.source
"""
