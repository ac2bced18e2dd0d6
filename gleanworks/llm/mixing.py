"""Mixes sources to token targets by entropy balancing.

Document rates r minimise their relative entropy to 1 under one token constraint per source and
r <= 3. The convex dual has one multiplier per source, and r = min(3, exp(multiplier * tokens)).
Newton steps, kept inside a bracket, solve the dual over counts of (source, tokens), for all
sources at once where their rows are. Rates become copies by systematic rounding: within a source the
documents stand from the longest to the shortest, and a document's copies are the whole numbers that the running
sum of rates passes. The rounding's offset is, per source, the one of OFFSETS candidates whose
words come nearest to the target. Rates are whole multiples of 2^-20, so that sums are exact and
reruns agree.

Nulls: a null source is a source of its own, last in order; a null text has no words. Documents
without words have rate 1. Ties and repeated rows are ordered by a hash of doc_id and text;
identical rows are interchangeable. Empty input: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanworks.llm.common import durable, hot_limit, ranked, text_or_empty
from gleanworks.session import table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
UNIT = 1 << 20
OFFSETS = 32
#: Newton steps at most; a source that is not solved by then is an error.
MOST_STEPS = 400


def word_count(text: Column) -> Column:
    """Number of maximal runs of other than space and the controls 9 to 13."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame) -> DataFrame:
    """sources(source, source_size) with target: weights share the total; none exceeds CAP x its size.

    Sources in order of code point, null last, weigh WEIGHTS in turn. A source's target is
    least(CAP * size, weight * level); the level is found over the sources in order of the level at
    which each is full. There is a row per source here, not per document.
    """
    spot = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), (spot % len(WEIGHTS) + 1).cast("int")).cast("double")
    df = sources.withColumn("weight", w).withColumn("most", F.col("source_size").cast("double") * CAP)
    df = df.withColumn("full_at", F.col("most") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # The first source that is not full at the level that the sources from it on would share.
    df = df.withColumn("level", left / weights)
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(every)["level"]
    return df.withColumn("target", F.least("most", F.col("weight") * level)).select("source", "source_size", "target")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def newton_step(state: Column) -> Column:
    """The next (lam, lo, hi, off) of a source, from the moments of its histogram `hist` at the multiplier lam."""
    lam = state["lam"]
    rate = lambda x: F.least(F.lit(float(CAP)), F.exp(F.least(F.lit(50.0), lam * x)))

    def add(held, cell):
        x = cell["size"] / F.col("mean")
        words = cell["n"] * rate(x) * x
        return F.struct((held["got"] + words).alias("got"), (held["slope"] + F.when(rate(x) < CAP, words * x).otherwise(0.0)).alias("slope"))

    def moved(m):
        g = m["got"] - F.col("goal")
        # The lower end is unknown below 0: it doubles until the rates fall short of the goal.
        lo = F.when(g < 0, lam).when(state["lo"] >= lam, state["lo"] * 2 - 1).otherwise(state["lo"])
        hi = F.when(g > 0, lam).otherwise(state["hi"])
        newton = F.coalesce(lam - F.try_divide(g, m["slope"]), F.lit(float("inf")))
        inside = (newton > lo) & (newton < hi)
        near = F.abs(g) <= F.col("goal") * 1e-10
        new = F.when(near, lam).when(inside, newton).otherwise((lo + hi) / 2)
        return F.struct(new.alias("lam"), lo.alias("lo"), hi.alias("hi"), (F.abs(g) / F.col("goal")).alias("off"))

    moments = F.aggregate("hist", F.struct(F.lit(0.0).alias("got"), F.lit(0.0).alias("slope")), add)
    return F.when(state["off"] <= 1e-10, state).otherwise(bound(moments, moved))


def rates(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source_key, multiplier, mean): solves the dual. counts: (source_key, size, n).

    The dual falls apart by source: Newton steps run for all sources at once, a row each, over the
    source's histogram of sizes in order of size, so a sum does not depend on the layout. A
    histogram has as many cells as a source has different sizes, however many documents."""
    mean = F.sum(F.col("size") * F.col("n")) / F.sum("n")
    about = counts.groupBy("source_key").agg(
        mean.alias("mean"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"), F.sort_array(F.collect_list(F.struct("size", "n"))).alias("hist")
    )
    tall = F.lit(1.0001 * math.log(CAP))
    # At the bracket's upper end all documents with words have the rate CAP; at 0 all have 1.
    up = F.col("target") > F.col("source_size")
    lo, hi = F.when(up, F.lit(0.0)).otherwise(F.lit(-1.0)), F.when(up, tall * F.col("mean") / F.col("least")).otherwise(F.lit(0.0))
    start = F.struct(F.lit(0.0).alias("lam"), lo.alias("lo"), hi.alias("hi"), F.lit(1.0).alias("off"))
    df = about.join(targets, "source_key").where("source_size > 0").withColumn("goal", F.col("target") / F.col("mean"))
    solved = F.aggregate(F.sequence(F.lit(1), F.lit(MOST_STEPS)), start, lambda state, _: newton_step(state))
    out = durable(df.select("source_key", "mean", solved.alias("s")))
    worst = out.agg(F.max("s.off").alias("worst")).first()["worst"]
    if worst is not None and not worst < 1e-9:
        raise RuntimeError(f"the dual is not solved after {MOST_STEPS} steps: off by {worst} of a target")
    return out.select("source_key", F.round("s.lam", 9).alias("multiplier"), "mean")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for each row."""
    text = text_or_empty(text_col)
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    slim = durable(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), key.alias("source_key"),
            word_count(text).alias("size"), F.xxhash64(F.col(id_col), text, F.col(source_col)).alias("tie"),
        )
    )
    counts = durable(slim.groupBy("source_key", "source", "size").agg(F.count("*").alias("n")))
    sources = counts.groupBy("source_key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = durable(source_targets(sources.drop("source_key")).withColumn("source_key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))).drop("source"))
    n_rows = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    solved = rates(counts.select("source_key", "size", "n"), targets)

    rate = F.least(F.lit(float(CAP)), F.exp(F.least(F.lit(50.0), F.coalesce("multiplier", F.lit(0.0)) * F.col("size") / F.coalesce("mean", F.lit(1.0)))))
    cells = counts.select("source_key", "size", "n").join(solved, "source_key", "left").withColumn("rate", F.round(rate * UNIT).cast("long"))
    before = Window.partitionBy("source_key").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cells = durable(cells.withColumn("base", F.coalesce(F.sum(F.col("rate") * F.col("n")).over(before), F.lit(0))).drop("multiplier", "mean"))

    tries = cells.withColumn("offset", F.explode(F.array(*(F.lit(UNIT * k // OFFSETS).cast("long") for k in range(OFFSETS)))))
    words = tries.groupBy("source_key", "offset").agg(F.sum((_whole(F.col("base") + F.col("rate") * F.col("n") + F.col("offset")) - _whole(F.col("base") + F.col("offset"))) * F.col("size")).alias("words"))
    best = (
        words.join(targets, "source_key")
        .groupBy("source_key", "target", "source_size")
        .agg(F.min(F.struct(F.abs(F.col("words") - F.col("target")).alias("off"), "offset"))["offset"].alias("offset"))
    )
    cells = cells.join(best, "source_key")
    hot = [r.asDict() for r in counts.where(F.col("n") > hot_limit(n_rows)).select("source_key", "size", "n").collect()]
    rows = ranked(slim.drop("source"), ["source_key", "size"], ["tie", "doc_id"], hot, n_rows)
    start = F.col("base") + F.col("rate") * F.col("rank") + F.col("offset")
    out = rows.join(cells, ["source_key", "size"]).withColumn("copies", _whole(start + F.col("rate")) - _whole(start))
    return out.select("doc_id", "tie", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _whole(total: Column) -> Column:
    """Whole units in a non-negative sum of rates."""
    return F.shiftright(total, UNIT.bit_length() - 1)


def op9_entropy_mix(spark, sf_dir):
    """All documents mixed to 5:2:1 shares of the sources in turn, none above 3 times its size."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs with each row repeated by its copies; rows without copies go. Same columns as docs, whatever their names.

    Rows are paired with their copies by doc_id and a hash of doc_id, text and source. Rows that
    agree in all three take their counts of copies in order of a hash of the whole row. There are at
    most CAP + 1 different counts, so a key's counts are a few runs, and keys of very many rows are
    ranked in pieces.
    """
    keys, mark = ["_id", "_tie"], lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    made = durable(mix(docs).groupBy(mark(F.col("doc_id")).alias("_id"), F.col("tie").alias("_tie"), "copies").agg(F.count("*").alias("n")))
    n_rows = made.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = made.groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") > hot_limit(n_rows)).collect()
    runs = made.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("copies", "n"))).alias("_runs"))
    # The caller's columns go along in a struct, so that none of their names can clash.
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    tied = docs.select(own.alias("_row"), mark(F.col("doc_id")).alias("_id"), F.xxhash64(F.col("doc_id"), text_or_empty(), F.col("source")).alias("_tie"))
    # Ranks and runs go by the same keys: the texts are shuffled once.
    rows = ranked(tied.withColumn("_order", F.xxhash64("_row")), keys, ["_order"], [r.asDict() for r in hot], n_rows, "_rank").join(runs, keys)
    start = F.struct(F.col("_rank").alias("left"), F.lit(-1).cast("long").alias("copies"))
    spot = F.aggregate("_runs", start, lambda at, r: F.when(at["copies"] >= 0, at).otherwise(F.struct((at["left"] - r["n"]).alias("left"), F.when(at["left"] < r["n"], r["copies"]).otherwise(F.lit(-1).cast("long")).alias("copies"))))
    times = F.when(F.size("_runs") == 1, F.element_at("_runs", 1)["copies"]).otherwise(spot["copies"]).cast("int")
    return rows.withColumn("_times", times).where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")
