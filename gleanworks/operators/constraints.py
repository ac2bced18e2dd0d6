"""Declared rules of a table, checked in one pass over it.

Each row gives facts (rule, key, role); one aggregation of the facts tells every rule, whether it is about
rows, values or the whole table. Facts are added up where they arise, so that a common value costs a row a
task. Rows that break a rule about themselves are counted by an observation of the same pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

VIOLATION = ("rule", "who", "n")
#: Rows whose facts one task adds up, at about.
ROWS = 100_000


@dataclass(frozen=True)
class Count:
    """So many rows (of those in `where`) there must be; who is the number there is."""

    rule: str
    expected: int
    where: str = "true"


@dataclass(frozen=True)
class Among:
    """A column's values must be of these, and not null; who is the value, or null."""

    rule: str
    column: str
    values: tuple


@dataclass(frozen=True)
class Unique:
    """A column's values that aren't blank must differ; who is the value."""

    rule: str
    column: str


@dataclass(frozen=True)
class Known:
    """The elements of an array column must be values of another column of the table; who is the element."""

    rule: str
    column: str
    of: str


@dataclass(frozen=True)
class Last:
    """The row of the greatest `order` must have this value; who is the value it has."""

    rule: str
    order: str
    column: str
    expected: str


def _facts(rule) -> Column:
    """array<struct<rule, key, role, place>> of a row."""
    fact = lambda key, role, place=None: F.struct(F.lit(rule.rule).alias("rule"), key.cast("string").alias("key"), F.lit(role).alias("role"), (F.lit(None) if place is None else place).cast("double").alias("place"))
    some = lambda when, *facts: F.when(when, F.array(*facts)).otherwise(F.array().cast("array<struct<rule:string,key:string,role:string,place:double>>"))
    if isinstance(rule, Count):
        return some(F.coalesce(F.expr(rule.where), F.lit(False)), fact(F.lit(None), "own"))
    if isinstance(rule, Among):
        return some(~F.coalesce(F.col(rule.column).isin(*rule.values), F.lit(False)), fact(F.col(rule.column), "bad"))
    if isinstance(rule, Unique):
        return some(F.coalesce(F.trim(rule.column) != "", F.lit(False)), fact(F.col(rule.column), "own"))
    if isinstance(rule, Last):
        return some(F.col(rule.order).isNotNull(), fact(F.lit(None), "own", F.col(rule.order)))
    children = F.transform(F.coalesce(F.col(rule.column), F.array().cast("array<string>")), lambda x: fact(x, "child"))
    return F.concat(F.array(fact(F.col(rule.of), "parent")), children)


def violations(df: DataFrame, rules: list) -> tuple[DataFrame, Observation]:
    """((rule, who, n), observation): what breaks the rules, n rows or values each; empty where all hold.

    The observation holds `rows` and, for each Among rule, its count of bad rows under the rule's name, once the
    violations have been read."""
    seen = Observation("constraints")
    bad = [F.count_if(~F.coalesce(F.col(r.column).isin(*r.values), F.lit(False))).alias(r.rule) for r in rules if isinstance(r, Among)]
    rows = df.observe(seen, F.count("*").alias("rows"), *bad)
    # A row is several facts, most of keys of their own, and a file of many rows may be one task: facts arise after rows are dealt.
    if (parts := -(-df.count() // ROWS)) > 1:
        rows = rows.repartition(parts, F.xxhash64(*(F.col(f"`{c}`").cast("string") for c in df.columns)))
    last = {r.rule: r for r in rules if isinstance(r, Last)}
    facts = rows.select(F.explode(F.concat(*(_facts(r) for r in rules))).alias("f"), *(F.col(c) for c in {r.column for r in last.values()} - {"f"}))
    of = lambda role: F.count_if(F.col("f.role") == role)
    tops = [F.max_by(F.col(r.column).cast("string"), F.when(F.col("f.rule") == r.rule, F.col("f.place"))).alias(f"_top{i}") for i, r in enumerate(last.values())]
    sums = facts.groupBy(F.col("f.rule").alias("rule"), F.col("f.key").alias("key")).agg(of("own").alias("own"), of("bad").alias("bad"), of("parent").alias("parent"), of("child").alias("child"), *tops)
    # A rule about the whole table has a row even over no rows.
    whole = [r for r in rules if isinstance(r, (Count, Last))]
    if whole:
        blank = df.sparkSession.range(1).select(F.explode(F.array(*(F.lit(r.rule) for r in whole))).alias("rule"), F.lit(None).cast("string").alias("key"))
        sums = sums.unionByName(blank, allowMissingColumns=True).groupBy("rule", "key").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("own", "bad", "parent", "child")), *(F.max(f"_top{i}").alias(f"_top{i}") for i in range(len(last))))
    cases = []
    for r in rules:
        own = F.col("rule") == r.rule
        if isinstance(r, Count):
            cases.append((own & (F.col("own") != r.expected), F.col("own").cast("string"), F.col("own")))
        elif isinstance(r, Among):
            cases.append((own & (F.col("bad") > 0), F.col("key"), F.col("bad")))
        elif isinstance(r, Unique):
            cases.append((own & (F.col("own") > 1), F.col("key"), F.col("own")))
        elif isinstance(r, Known):
            cases.append((own & (F.col("child") > 0) & (F.col("parent") == 0), F.col("key"), F.col("child")))
        else:
            top = F.col(f"_top{list(last).index(r.rule)}")
            cases.append((own & ~F.coalesce(top == r.expected, F.lit(False)), top, F.lit(1).cast("long")))
    who, n = F.lit(None).cast("string"), F.lit(None).cast("long")
    for when, name, many in cases:
        who, n = F.when(when, name).otherwise(who), F.when(when, many).otherwise(n)
    return sums.select("rule", who.alias("who"), n.alias("n")).where("n IS NOT NULL"), seen
