"""What each filter of a chain removes, in every order of the chain, from one pass over the texts.

Five failure flags a document are counted to cells (part, flags, labels), 32 x 4 a part at most.
A SQL CUBE over the flags and the part then holds, in the rows of a grouping set whose selected
flags are all false, the survivors of that subset of filters. A step of an order lies between two
subsets, so joining pairs of subsets gives the steps of all 120 orders. Only the cells are cubed, so
the 64 grouping sets multiply a table that doesn't grow with the documents.

Flag E (a copy of an earlier text) compares SHA-256 digests; the least id of a digest is found by
partial minima and joined back; Spark splits the hot partitions of that join.

A null text is empty, a null part is the empty string. A null id is neither smaller nor larger than
any, and has no labels. Repeated rows of one id count each, and are no copies of one another; of
repeated labels a 1 wins. Ties can't arise. Other columns are ignored; an empty table has no parts
and so gives no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gleanworks.llm.common import durable, literal_table, text_or_empty
from gleanworks.session import table

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failures(text: Column) -> dict[str, Column]:
    """Flags A to D of a text that isn't null."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": F.lit(100).cast("long") * F.size(F.array_distinct(words)) < F.lit(LEAST_DISTINCT).cast("long") * F.size(words),
        "C": F.lit(100).cast("long") * capitals > F.lit(MOST_CAPITALS).cast("long") * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def flagged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, A..E, good, toxic) a row of docs; labels(key, quality, toxic)."""
    own = text_or_empty(text)
    narrow = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(own, 256)).alias("digest"), *(f.alias(k) for k, f in failures(own).items()))
    narrow = durable(narrow)  # read twice, so that the texts are read once
    # Only texts that two ids hold have copies. Written apart, as Spark splits hot partitions only between two shuffles of a join's own.
    first = durable(narrow.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first"))
    marks = labels.groupBy(F.col(key).alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = narrow.join(first, "digest", "left").withColumn("E", F.coalesce(F.col("id") > F.col("first"), F.lit(False))).drop("digest", "first")
    rows = rows.join(marks, "id", "left")
    return rows.select("part", *FILTERS, F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def survivors(rows: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) for every part and subset of the filters, bit i standing for filter i; zeros included."""
    cells = durable(rows.groupBy("part", *FILTERS).agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")))
    cube = cells.cube("part", *FILTERS).agg(F.grouping_id().alias("gid"), *(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    # grouping_id has a 1 for each column that is summed over, the part's first, filter A's next.
    chosen = lambda i: F.getbit("gid", F.lit(len(FILTERS) - 1 - i)) == 0
    passed = [~F.coalesce(F.col(f), F.lit(False)) for f in FILTERS]
    kept = cube.where(F.getbit("gid", F.lit(len(FILTERS))) == 0)
    for p in passed:
        kept = kept.where(p)
    mask = sum((chosen(i).cast("int") * (1 << i) for i in range(len(FILTERS))), F.lit(0))
    found = kept.select("part", mask.alias("mask"), "n", "good", "toxic")
    every = cells.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit(2 ** len(FILTERS) - 1))).alias("mask"))
    return durable(every.join(found, ["part", "mask"], "left").na.fill(0, ["n", "good", "toxic"]))


def steps(filters: str = FILTERS) -> list[dict]:
    """The steps of all orders: the subsets before and after, and the filter between."""
    out = []
    for order in itertools.permutations(filters):
        before = 0
        for k, f in enumerate(order):
            after = before | 1 << filters.index(f)
            out.append({"filter_order": "".join(order), "step": k + 1, "filter": f, "before": before, "after": after})
            before = after
    return out


def audited(rows: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from rows of `flagged`."""
    alive = survivors(rows)
    spark, everyone = rows.sparkSession, 2 ** len(FILTERS) - 1
    # 32 subsets x 5 filters x 2 at most, and the 600 steps: fixed tables.
    pairs = [{"filter": f, "before": m, "after": m | 1 << i} for i, f in enumerate(FILTERS) for m in range(everyone + 1) if not m >> i & 1]
    named = lambda suffix, key: alive.select("part", F.col("mask").alias(key), *(F.col(c).alias(c + suffix) for c in ("n", "good", "toxic")))
    pair = named("_before", "before").join(F.broadcast(literal_table(spark, pairs, "filter string, before int, after int")), "before").join(named("_after", "after"), ["part", "after"])
    lost = pair.select("part", "filter", "before", F.col("n_after").alias("kept"), *((F.col(f"{c}_before") - F.col(f"{c}_after")).alias(to) for c, to in (("n", "removed"), ("good", "good_lost"), ("toxic", "toxic_lost"))), "after")
    # A filter's own failures are what it removes first, its unique ones what it removes last.
    alone = lost.groupBy("part", "filter").agg(F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"), F.sum(F.when(F.col("after") == everyone, F.col("removed"))).alias("unique_fails"))
    orders = literal_table(spark, steps(), "filter_order string, step int, filter string, before int, after int")
    out = lost.join(alone, ["part", "filter"]).join(F.broadcast(orders.drop("after")), ["filter", "before"])
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return out.select(
        "part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley")
    )


def op13_filter_audit(spark, sf_dir):
    """Five filters over all documents, in all orders, by source."""
    return audited(flagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failing AS (
    SELECT t.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, list_filter([
        CASE WHEN len(words) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' END,
        CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' END,
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
        CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 'E' END], lambda f: f IS NOT NULL) AS fails
    FROM texts t LEFT JOIN marks m ON m.doc_id = t.doc_id),
orders(o) AS (SELECT '' UNION ALL SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(f) WHERE NOT contains(o, f)),
stages AS (SELECT o AS filter_order, step::INTEGER AS step, substring(o, step, 1) AS f, string_split(substring(o, 1, step - 1), '') AS earlier FROM orders, range(1, 6) AS r(step) WHERE length(o) = 5),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY part, fails),
told AS (
    SELECT part, filter_order, step, f, n, good, toxic, list_contains(fails, f) AS bad, list_has_any(fails, earlier) AS gone, len(fails) AS k
    FROM cells, stages),
counted AS (
    SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (bad AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (bad AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (bad AND k = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (bad AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (bad AND NOT gone), 0)::BIGINT AS toxic_lost
    FROM told GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counted
"""
