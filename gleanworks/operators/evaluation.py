"""Classifier evaluation over a hub table preds(id, y, p, ord, pred, conf), p an array<double>.

Shares are left unrounded. Zero denominators give what each metric defines: 0 per class and in the
serving sweep, NaN in accuracies and curves, NULL for a share of no `other` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanworks.functions.arrays import argmax, largest_difference, ranked_classes, rounded, softmax
from gleanworks.functions.scalars import source_of

NAN = float("nan")


def class_dim(spark: SparkSession, n: int) -> DataFrame:
    """classes(class): 0..n-1."""
    return spark.range(n).select(F.col("id").cast("int").alias("class"))


def predictions(df: DataFrame, id_col: str, label_col: str, logits: Column) -> DataFrame:
    """preds: softmax probabilities, the class order, the first class and its probability."""
    return with_ranks(df.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"), softmax(logits).alias("p")))


def with_ranks(df: DataFrame) -> DataFrame:
    """Adds ord (classes by probability, ties to the lower index), pred and conf."""
    return df.withColumn("ord", ranked_classes(F.col("p"))).withColumn("pred", F.element_at("ord", 1)).withColumn("conf", F.array_max("p"))


def hit(k: int, order: str = "ord") -> Column:
    return F.array_contains(F.slice(order, 1, k), F.col("y")).cast("double")


def share(a: Column, b: Column) -> Column:
    """a / b, and 0 over nothing."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def topk_accuracy(preds: DataFrame, ks: tuple[int, ...] = (1, 3)) -> DataFrame:
    """Share of rows whose label is among the first k classes; NaN over no rows."""
    return preds.agg(F.count("*").alias("n"), *(F.coalesce(F.avg(hit(k)), F.lit(NAN)).alias(f"top{k}") for k in ks))


def per_class(preds: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, support, precision, recall, f1, top3_recall) for every class, also unseen ones."""
    # One pass over the predictions; the cells are at most the square of the classes.
    cells = preds.groupBy("y", "pred").agg(F.count("*").alias("n"), F.sum(hit(3).cast("long")).alias("h3"))
    zero, same = F.lit(0).cast("long"), F.col("pred") == F.col("y")
    true = F.struct(F.col("y").alias("class"), F.col("n").alias("s"), F.when(same, F.col("n")).otherwise(zero).alias("tp"), F.col("h3").alias("h3"), zero.alias("pn"))
    said = F.struct(F.col("pred").alias("class"), zero.alias("s"), zero.alias("tp"), zero.alias("h3"), F.col("n").alias("pn"))
    sums = cells.select(F.inline(F.array(true, said))).groupBy("class").agg(*(F.sum(c).alias(c) for c in ("s", "tp", "h3", "pn")))
    df = classes.join(sums, "class", "left").na.fill(0)
    precision, recall = share(F.col("tp"), F.col("pn")), share(F.col("tp"), F.col("s"))
    df = df.select("class", F.col("s").alias("support"), precision.alias("precision"), recall.alias("recall"), share(F.col("h3"), F.col("s")).alias("top3_recall"))
    f1 = share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return df.withColumn("f1", f1)


def confusion(preds: DataFrame, classes: DataFrame) -> DataFrame:
    """(y, pred, n) for every pair of classes, zero cells too."""
    cells = classes.select(F.col("class").alias("y")).crossJoin(classes.select(F.col("class").alias("pred")))
    counts = preds.groupBy("y", "pred").agg(F.count("*").alias("n"))
    return cells.join(counts, ["y", "pred"], "left").na.fill(0)


def confusion_shares(preds: DataFrame, classes: DataFrame) -> DataFrame:
    """(y, pred, n, share): cells over their row's sum; rows of unseen classes are 0."""
    total = F.sum("n").over(Window.partitionBy("y"))
    return confusion(preds, classes).withColumn("share", share(F.col("n"), total))


def confusable_pairs(preds: DataFrame, classes: DataFrame, groups: list[list[int]]) -> DataFrame:
    """(a, b, ab, ba, a_out, b_out, kind, source) for pairs within a group of which 5 % or more go one way.

    Symmetric if both ways are used and differ by less than a factor of 2; else asymmetric, and
    source is the class that loses more (of equal ones the second). a_out and b_out: the
    percentage of a's and of b's rows that go to classes outside the group.
    """
    pairs = [(a, b, k) for k, g in enumerate(groups) for i, a in enumerate(g) for b in g[i + 1 :]]
    members = [(a, k) for k, g in enumerate(groups) for a in g]
    spark = preds.sparkSession
    rows = lambda names, values: spark.range(1).select(F.inline(F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(names, v))) for v in values))))
    dim, group_of = rows(("a", "b", "g"), pairs), rows(("class", "g"), members)
    cells = confusion_shares(preds, classes)
    one = cells.select(F.col("y").alias("a"), F.col("pred").alias("b"), (F.col("share") * 100).alias("ab"))
    two = cells.select(F.col("y").alias("b"), F.col("pred").alias("a"), (F.col("share") * 100).alias("ba"))
    to = group_of.select(F.col("class").alias("pred"), F.col("g").alias("_to"))
    out = cells.join(to, "pred", "left").join(group_of.select(F.col("class").alias("y"), "g"), "y")
    out = out.groupBy("y", "g").agg((F.sum(F.when(F.col("_to") == F.col("g"), 0.0).otherwise(F.col("share"))) * 100).alias("out"))
    side = lambda c: out.select(F.col("y").alias(c), "g", F.col("out").alias(f"{c}_out"))
    df = F.broadcast(dim).join(one, ["a", "b"]).join(two, ["a", "b"]).where(F.greatest("ab", "ba") >= 5)
    df = df.join(side("a"), ["a", "g"]).join(side("b"), ["b", "g"]).select("a", "b", "ab", "ba", "a_out", "b_out")
    low, high = F.least("ab", "ba"), F.greatest("ab", "ba")
    even = (low > 0) & (F.try_divide(high, low) < 2)
    kind = F.when(even, "symmetric").otherwise("asymmetric")
    return df.withColumn("kind", kind).withColumn("source", F.when(even, F.lit(None)).otherwise(F.when(F.col("ab") > F.col("ba"), F.col("a")).otherwise(F.col("b"))))


def macro_and_ood(preds: DataFrame, classes: DataFrame, other: int) -> DataFrame:
    """Mean recall over all classes, and the share of other classes' rows predicted as `other`."""
    macro = per_class(preds, classes).agg(F.avg("recall").alias("macro_recall"))
    wrong = preds.where(F.col("y") != other).agg(F.coalesce(F.avg((F.col("pred") == other).cast("double")), F.lit(0.0)).alias("other_fp"))
    return macro.crossJoin(wrong)


def reached(df: DataFrame, score: str, values: list[float], sums: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """(by, t, n, n_all, <sum>, <sum>_all): rows and sums with score >= t, and of all rows with a score.

    A row is counted in one bin, by how many thresholds it reaches, and only the bins meet the
    thresholds; a sum over no row is null, a count 0.
    """
    by, ts = by or [], sorted(set(values))
    bins = sum(((F.col(score) >= t).cast("int") for t in ts), F.lit(0))
    cells = df.groupBy(*by, bins.alias("_bin")).agg(F.count("*").alias("n"), *(c.alias(name) for name, c in sums.items()))
    cells = cells.select("*", F.posexplode(F.array(*map(F.lit, ts))).alias("_at", "t"))
    kept, told = F.col("_at") < F.col("_bin"), F.col("_bin").isNotNull()
    total = lambda c, when: F.sum(F.when(when, F.col(c)))
    more = [x for c in sums for x in (total(c, kept).alias(c), total(c, told).alias(f"{c}_all"))]
    return cells.groupBy(*by, "t").agg(F.coalesce(total("n", kept), F.lit(0)).alias("n"), F.coalesce(total("n", told), F.lit(0)).alias("n_all"), *more)


def threshold_curve(preds: DataFrame, values: list[float]) -> DataFrame:
    """(t, reject_rate, top1, top3) where conf >= t keeps a row; accuracies of the kept, NaN if none."""
    out = reached(preds, "conf", values, {"h1": F.sum(hit(1)), "h3": F.sum(hit(3))})
    mean = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("n")), F.lit(NAN))
    return out.select("t", F.try_divide((F.col("n_all") - F.col("n")).cast("double"), F.col("n_all")).alias("reject_rate"), mean("h1").alias("top1"), mean("h3").alias("top3"))


def serving_sweep(preds: DataFrame, values: list[float], other: int) -> DataFrame:
    """As threshold_curve by the serving rule: uncertain below t or where `other` is first; ranks without `other`."""
    rows = preds.withColumn("fish_ord", F.filter("ord", lambda i: i != other))
    # A row whose first class is `other` reaches no threshold.
    rows = rows.select(F.when(F.col("pred") == other, float("-inf")).otherwise(F.col("conf")).alias("sure"), (F.col("y") != other).alias("fish"), hit(1, "fish_ord").alias("h1"), hit(3, "fish_ord").alias("h3"))
    of = lambda c: F.sum(F.when(F.col("fish"), c))
    out = reached(rows, "sure", values, {"f": F.count_if("fish"), "o": F.count_if(~F.col("fish")), "h1": of(F.col("h1")), "h3": of(F.col("h3"))})
    kept = F.coalesce("f", F.lit(0))
    return out.select(
        "t", F.coalesce(F.try_divide((F.col("f_all") - kept).cast("double"), F.col("f_all")), F.lit(NAN)).alias("fish_reject_rate"),
        share(F.coalesce("h3", F.lit(0)), kept).alias("top3_on_kept"), share(F.coalesce("h1", F.lit(0)), kept).alias("top1_on_kept"),
        F.try_divide((F.col("o_all") - F.coalesce("o", F.lit(0))).cast("double"), F.col("o_all")).alias("other_caught"), kept.alias("kept_n"),
    )


def choose_threshold(sweep: DataFrame, cap: float = 0.10) -> DataFrame:
    """The row of best top3_on_kept within the cap, ties to the lower rejection; without one the least rejection."""
    ok = F.col("fish_reject_rate") <= cap
    order = [ok.desc(), F.when(ok, F.col("top3_on_kept")).desc(), F.col("fish_reject_rate"), F.col("t")]
    return sweep.orderBy(*order).limit(1)


def worst_cases(preds: DataFrame, n: int = 50) -> DataFrame:
    """The n surest mistakes."""
    return preds.where("pred <> y").orderBy(F.col("conf").desc(), "id").limit(n).select("id", "y", "pred", "conf")


def bottom_classes(preds: DataFrame, classes: DataFrame, n: int = 8, floor: float = 0.60) -> DataFrame:
    """The n classes of least recall, flagged below the floor."""
    df = per_class(preds, classes).orderBy("recall", "class").limit(n)
    return df.select("class", "recall", "support", (F.col("recall") < floor).alias("below"))


def source_metrics(preds: DataFrame, by: str) -> DataFrame:
    """Accuracy by a column of the predictions."""
    return preds.groupBy(by).agg(F.count("*").alias("n"), F.avg(hit(1)).alias("top1"), F.avg(hit(3)).alias("top3"))


def served_rows(preds: DataFrame, t: float, other: int, k: int = 3) -> DataFrame:
    """(id, rank, class, confidence, uncertain, top1_confidence, other_confidence): k candidates without `other`, not renormalised."""
    rows = preds.withColumn("c", F.slice(F.filter("ord", lambda i: i != other), 1, k))
    unsure = (F.col("conf") < t) | (F.col("pred") == other)
    rows = rows.select("id", unsure.alias("uncertain"), F.col("conf").alias("top1_confidence"), F.element_at("p", other + 1).alias("other_confidence"), "p", F.posexplode("c").alias("at", "class"))
    return rows.select("id", (F.col("at") + 1).alias("rank"), "class", F.element_at("p", F.col("class") + 1).alias("confidence"), "uncertain", "top1_confidence", "other_confidence")


def served_json(preds: DataFrame, t: float, other: int, version: str, k: int = 3) -> DataFrame:
    """(id, response): the response document of each row as JSON."""
    candidates = F.transform(F.slice(F.filter("ord", lambda i: i != other), 1, k), lambda c, i: F.struct((i + 1).alias("rank"), c.alias("class"), F.element_at("p", c + 1).alias("confidence")))
    unsure = (F.col("conf") < t) | (F.col("pred") == other)
    body = F.struct(unsure.alias("uncertain"), F.lit(version).alias("model_version"), candidates.alias("predictions"), F.element_at("p", other + 1).alias("other_confidence"), F.col("conf").alias("top1_confidence"))
    return preds.select("id", F.to_json(body).alias("response"))


def field_summary(preds: DataFrame, t: float, other: int) -> DataFrame:
    """Uncertain share, accuracies and, where there is a column latency, its mean; an `other` row succeeds if it is uncertain."""
    rows = preds.withColumn("c", F.filter("ord", lambda i: i != other)).withColumn("unsure", (F.col("conf") < t) | (F.col("pred") == other))
    ok = lambda k: F.when(F.col("y") == other, F.col("unsure").cast("double")).otherwise(hit(k, "c"))
    latency = [F.avg("latency").alias("mean_latency")] if "latency" in preds.columns else []
    return rows.agg(F.count("*").alias("n"), F.avg(F.col("unsure").cast("double")).alias("uncertain_rate"), F.avg(ok(1)).alias("top1"), F.avg(ok(3)).alias("top3"), *latency)


def prediction_table(preds: DataFrame, names: DataFrame, path: Column) -> DataFrame:
    """(path, filename, source, true, pred, confidence, correct_top1, correct_top3): a row an image; names(class, name)."""
    said, true = names.select(F.col("class").alias("pred"), F.col("name").alias("_said")), names.select(F.col("class").alias("y"), F.col("name").alias("_true"))
    df = preds.withColumn("path", path).join(F.broadcast(said), "pred").join(F.broadcast(true), "y")
    filename = F.element_at(F.split("path", "/"), -1)
    return df.select(
        "path", filename.alias("filename"), source_of(filename).alias("source"), F.col("_true").alias("true"), F.col("_said").alias("pred"),
        rounded(F.col("conf"), 4).alias("confidence"), hit(1).cast("int").alias("correct_top1"), hit(3).cast("int").alias("correct_top3"),
    )


def metrics_document(preds: DataFrame, classes: DataFrame, values: list[float], worst: int = 50) -> DataFrame:
    """(document): one JSON document of overall accuracies, metrics by class, the threshold curve and the surest mistakes.

    Its arrays are as long as there are classes, thresholds and listed mistakes, at any number of rows."""
    gather = lambda df, order, name: df.agg(F.sort_array(F.collect_list(F.struct(order, *(c for c in df.columns if c != order)))).alias(name))
    cases = preds.where("pred <> y").select((-F.col("conf")).alias("minus"), "id", "y", "pred").orderBy("minus", "id").limit(worst)
    per = per_class(preds, classes)
    by_class = per.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("class").cast("string"), F.struct(*(c for c in per.columns if c != "class")))))).alias("per_class"))
    df = topk_accuracy(preds).select(F.struct("n", "top1", "top3").alias("overall"))
    for part in (by_class, gather(threshold_curve(preds, values), "t", "threshold_curve"), gather(cases, "minus", "worst_cases")):
        df = df.crossJoin(part)  # one row each
    cases = F.transform("worst_cases", lambda c: F.struct(c["id"].alias("id"), c["y"].alias("y"), c["pred"].alias("pred"), (-c["minus"]).alias("conf")))
    return df.select(F.to_json(F.struct("overall", "per_class", "threshold_curve", cases.alias("worst_cases"))).alias("document"))


def batch_totals(batches: DataFrame) -> DataFrame:
    """(n, loss, top1, top3) of an epoch from its batches(loss, size, hits1, hits3); over nothing all are 0."""
    total = F.coalesce(F.sum("size"), F.lit(0))
    mean = lambda c: share(F.coalesce(F.sum(c), F.lit(0)), F.greatest(total, F.lit(1)))
    return batches.agg(total.alias("n"), mean(F.col("loss") * F.col("size")).alias("loss"), mean(F.col("hits1")).alias("top1"), mean(F.col("hits3")).alias("top3"))


def difference_summary(df: DataFrame, by: str, difference: Column) -> DataFrame:
    """(by, n, largest, mean, zeros): absolute differences by a class of rows."""
    d = F.abs(difference)
    return df.groupBy(by).agg(F.count("*").alias("n"), F.max(d).alias("largest"), F.avg(d).alias("mean"), F.count_if(d == 0).alias("zeros"))


def parity(df: DataFrame, a: str, b: str, tolerance: float) -> DataFrame:
    """(n, largest, over, same_top1): two outputs array<double> of each row compared; NaN is over any tolerance."""
    rows = df.select(largest_difference(F.col(a), F.col(b)).alias("d"), (argmax(F.col(a)) == argmax(F.col(b))).alias("same"))
    over = F.isnan("d") | (F.col("d") > tolerance)
    return rows.agg(F.count("*").alias("n"), F.max("d").alias("largest"), F.count_if(over).alias("over"), F.count_if("same").alias("same_top1"))
