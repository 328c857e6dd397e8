"""Quality rules as a ledger of bits.

Every rule is evaluated once for each document. The ledger keeps the measurements and one bit for each
rule that failed; policies are versioned bit masks over it, and ablations are bitwise aggregations of it.
Changing a policy, or asking what one rule costs, never reads a text again. DataFrame functions only.

Nulls: a null text has no words and fails the base rules. Repeated rows each get their own ledger row.
An empty table gives an empty ledger. Only the named columns are read, so others may clash freely.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import SPACE, table, written

#: Rule -> failure condition over the measurements. The position is the bit; append only, never reorder.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "upper_case": "2 * n_upper > word_chars",
    "repeated_windows_strict": "100 * n_repeat_words > 20 * n_words",
}
BASE = ("few_words", "repeated_windows")
#: Policy version -> the rules that reject. The strict window rule is measured for ablations only.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "upper_case"),
    "v2": (*BASE, "symbols", "short_words", "long_words", "repeated_lines", "upper_case"),
}


def mask(rules: Iterable[str]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _repeats(hashes: str, bits: str, at: str | None = None) -> Column:
    """Positions whose window hash occurs again, judged by the hash bits that fit beside a position in a long.

    Upper bits of the hash first; with `at`, the lower bits of the positions given. Together they are all 64.
    """
    if at is None:
        keyed = f"transform({hashes}, (x, i) -> shiftleft(shiftright(x, {bits}), {bits}) | cast(i as bigint))"
    else:
        keyed = f"transform({at}, p -> shiftleft({hashes}[cast(p as int)], {bits}) | p)"
    mask_ = f"(shiftleft(1L, {bits}) - 1)"
    return F.expr(f"""aggregate(array(sort_array({keyed})), cast(array() as array<bigint>), (acc, s) ->
        array_distinct(flatten(filter(zip_with(slice(s, 1, greatest(size(s) - 1, 0)), slice(s, 2, greatest(size(s) - 1, 0)), (u, v) ->
            if(shiftrightunsigned(u ^ v, {bits}) = 0, array(u & {mask_}, v & {mask_}), null)), x -> x is not null))))""")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with all measurements."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"), F.array_remove(F.split(text, SPACE), "").alias("w"))
    lines = F.expr(r"filter(split(t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')")
    counted = split.select(
        "doc_id",
        "w",
        F.size("w").alias("n"),
        F.length(F.array_join("w", "")).alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]+", ""))).alias("n_symbols"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}+", ""))).alias("n_upper"),
        lines.alias("l"),
    )
    hashed = counted.select(
        "doc_id", "n", "word_chars", "n_symbols", "n_upper",
        F.size("l").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        F.length(F.bin("n")).alias("bits"),
        F.expr("if(n >= 3, transform(sequence(0, n - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])), cast(array() as array<bigint>))").alias("h"),
    )
    rest = ["doc_id", "n", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines"]
    first = hashed.select(*rest, "bits", "h", _repeats("h", "bits").alias("f"))
    both = first.select(*rest, F.when(F.size("f") > 0, F.sort_array(_repeats("h", "bits", "f"))).otherwise(F.expr("cast(array() as array<bigint>)")).alias("p"))
    covered = F.expr("if(size(p) = 0, 0L, 3L + aggregate(zip_with(slice(p, 1, size(p) - 1), slice(p, 2, size(p) - 1), (x, y) -> least(3L, y - x)), 0L, (s, x) -> s + x))")
    as_long = [F.col(c).cast("long").alias("n_words" if c == "n" else c) for c in rest[1:]]
    return both.select("doc_id", *as_long, covered.alias("n_repeat_words"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and `failed`, the bits of the rules that the document fails."""
    bits = " | ".join(f"if({rule}, {1 << i}L, 0L)" for i, rule in enumerate(RULES.values()))
    return measure(docs, id_col, text_col).withColumn("failed", F.expr(bits))


def apply_policy(rows: DataFrame, version: str = "v2") -> DataFrame:
    """`kept`: no rule of the policy failed."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablations(rows: DataFrame, version: str = "v2") -> DataFrame:
    """For each rule of the policy: documents that fail it, and that no other rule of the policy rejects."""
    names, whole = list(RULES), mask(POLICIES[version])
    counts = rows.groupBy(F.col("failed").bitwiseAND(F.lit(whole)).alias("bits")).count()
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[version])))
    return (
        counts.select("bits", "count", each.alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(F.expr("bits & r.bit != 0"), F.col("count")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.expr("bits = r.bit"), F.col("count")).otherwise(0)).alias("n_only_this"),
        )
    )


def filter_documents(docs: DataFrame, version: str = "v2") -> DataFrame:
    """The documents that the policy keeps, with all their columns.

    The ledger is evaluated beside each row, so that repeated doc_ids are judged one by one.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = ledger(docs.select(whole.alias("doc_id"), F.col("text")))
    # the id keeps the optimizer from moving the filter below, where it would evaluate each rule's inputs over and over
    return apply_policy(rows, version).withColumn("place", F.monotonically_increasing_id()).filter("kept and place >= 0").select("doc_id.*")


def stored_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger as a table in shared storage: texts are read once, whatever policies and ablations then ask of it."""
    return written(ledger(docs, id_col, text_col), "ledger")


def quality_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each policy version over one stored ledger: documents that it keeps, and those that the version before would have judged otherwise."""
    rows = stored_ledger(table(spark, sf_dir, "documents"))
    versions = list(POLICIES)
    kept = {v: F.col("failed").bitwiseAND(F.lit(mask(POLICIES[v]))) == 0 for v in versions}
    sums = [F.count_if(kept[v]).alias(f"kept_{v}") for v in versions] + [F.count_if(kept[v] != kept[u]).alias(f"moved_{v}") for u, v in zip(versions, versions[1:], strict=False)]
    one = rows.agg(F.count(F.lit(1)).alias("n_docs"), *sums)
    each = [F.struct(F.lit(v).alias("version"), F.col(f"kept_{v}").alias("n_kept"), (F.col(f"moved_{v}") if k else F.lit(0)).cast("long").alias("n_moved")) for k, v in enumerate(versions)]
    return one.select("n_docs", F.explode(F.array(*each)).alias("p")).select("p.version", "n_docs", "p.n_kept", "p.n_moved")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each policy version and rule of one stored ledger: documents that fail it, and that it alone rejects."""
    rows = stored_ledger(table(spark, sf_dir, "documents"))
    parts = [ablations(rows, v).select(F.lit(v).alias("version"), "rule", "n_failed", "n_only_this") for v in POLICIES]
    return reduce(DataFrame.union, parts)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed")


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
f AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM f) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')))::BIGINT AS n_upper,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, (""" + " | ".join(f"(CASE WHEN {rule} THEN {1 << i} ELSE 0 END)" for i, rule in enumerate(RULES.values())) + rf""")::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {mask(BASE)}) <> 0 AS base_failed,
       (failed & {mask(POLICIES["v2"])}) = 0 AS kept, failed FROM b
"""
_LEDGER_SQL = OP5_SQL[: OP5_SQL.rindex("SELECT doc_id, n_words")]
POLICIES_SQL = _LEDGER_SQL + " UNION ALL ".join(
    f"SELECT '{v}' AS version, count(*) AS n_docs, count(*) FILTER (WHERE failed & {mask(POLICIES[v])} = 0) AS n_kept, count(*) FILTER (WHERE (failed & {mask(POLICIES[v])} = 0) <> (failed & {mask(POLICIES[u])} = 0)) AS n_moved FROM b"
    for u, v in zip([next(iter(POLICIES)), *POLICIES], POLICIES, strict=False)
)
ABLATIONS_SQL = _LEDGER_SQL + " UNION ALL ".join(
    f"SELECT '{v}' AS version, '{r}' AS rule, count(*) FILTER (WHERE failed & {mask([r])} <> 0) AS n_failed, count(*) FILTER (WHERE failed & {mask(POLICIES[v])} = {mask([r])}) AS n_only_this FROM b" for v in POLICIES for r in POLICIES[v]
)
