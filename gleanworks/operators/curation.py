"""Dataset curation: counts, filters by key tables, duplicates, conflicts, splits."""

from __future__ import annotations

import random
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanworks.operators.near import hamming_pairs, leader_clusters  # noqa: F401  part of this operator set
from gleanworks.operators.places import placed

KEY = ["class", "filename"]
SPLITS = ("train", "val", "test")
#: Groups that group_split walks between two copies to its arrays.
WALKED_GROUPS = 1 << 16


def counts_by_class(df: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, n) for every class, 0 for absent ones."""
    return classes.join(df.groupBy("class").agg(F.count("*").alias("n")), "class", "left").na.fill(0, ["n"])


def split_table(df: DataFrame, splits: list[str]) -> DataFrame:
    """Counts by class and split, with a row total and a grand total (class null)."""
    cells = [F.count_if(F.col("split") == s).alias(s) for s in splits]
    return df.rollup("class").agg(*cells, F.count("*").alias("total"))


def split_flags(df: DataFrame, targets: DataFrame, splits: list[str]) -> DataFrame:
    """split_table's rows for every class of targets(class, target), with low (under half its target) and empty, and the grand total."""
    counts = split_table(df, splits)
    rows = F.broadcast(targets).join(counts, "class", "left").na.fill(0, [*splits, "total"])
    rows = rows.withColumn("low", F.col("total") < F.col("target") * 0.5).withColumn("empty", F.col("total") == 0)
    grand = counts.where("class IS NULL").withColumns({"target": F.lit(None).cast("long"), "low": F.lit(None).cast("boolean"), "empty": F.lit(None).cast("boolean")})
    return rows.select("class", *splits, "total", "low", "empty").unionByName(grand.select("class", *splits, "total", "low", "empty"))


def with_default(df: DataFrame, scores: DataFrame, keys: list[str], score: str, default: float) -> DataFrame:
    """df with its score, or the default where it has none."""
    return df.join(scores, keys, "left").withColumn(score, F.coalesce(score, F.lit(default)))


def without(df: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(keys_of, keys, "left_anti")


def first_copies(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def best_copies(df: DataFrame, by: list[str], area: Column, name: str) -> DataFrame:
    """The best row of each group: observations first, then the largest, then by name."""
    order = [(~F.col(name).startswith("inat_")).cast("int"), area.desc(), F.col(name)]
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def label_conflicts(df: DataFrame, key: str, label: str) -> DataFrame:
    """(key, labels, n) of the keys that stand under more than one label."""
    groups = df.groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("labels"), F.count("*").alias("n"))
    return groups.where(F.size("labels") > 1)


def without_conflicts(df: DataFrame, key: str, label: str) -> DataFrame:
    """df without any copy of a conflicting key."""
    bad = df.groupBy(key).agg(F.count_distinct(label).alias("k")).where("k > 1")
    return df.join(bad, key, "left_anti")


def funnel(df: DataFrame, stage: str, names: tuple[str, ...] = ("rejected", "broken", "exact", "kept")) -> DataFrame:
    """Counts of (raw, rejected, broken, exact, kept) by class and over all (class null); near too, where that stage is among names."""
    of = lambda s: F.count_if(F.col(stage) == s)
    return df.rollup("class").agg(F.count("*").alias("raw"), *(of(s).alias(s) for s in names))


def near_stage(df: DataFrame, most: int, area: Column, name: str) -> DataFrame:
    """(class, id, stage): `kept` for the best row of each leader group of its class, `near` for its others. df(class, id, h, ...)."""
    groups = leader_clusters(df.select("class", "id", "h"), most)
    best = best_copies(df.join(groups, ["class", "id"]), ["class", "leader"], area, name).select("class", "id", F.lit("kept").alias("stage"))
    return df.select("class", "id").join(best, ["class", "id"], "left").withColumn("stage", F.coalesce("stage", F.lit("near")))


def group_split(df: DataFrame, ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 42) -> DataFrame:
    """(class, name, split): whole groups in seeded order, each to the split with the most room.

    df(class, name, grp[, stratum]). Groups are shuffled in order of their first name by the generator
    seeded "seed:class"; ties of room go to train, then val, then test. Where there is a column
    stratum, a class with strata is split by them in order, one generator for all; a null stratum
    is one of its own, first, and so is a null class. Sequential by definition: a class is a task. It is
    sorted in the JVM and read as a stream of a row a group (key and number of files, never the files), of
    which the task keeps one stratum's keys, counts, order and places as arrays: a key and 21 bytes a group.
    """
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")
    if "stratum" not in df.columns:
        df = df.withColumn("stratum", F.lit(None).cast("string"))
    df = df.withColumn("stratum", F.coalesce(F.concat(F.lit("s"), F.col("stratum")), F.lit("")))
    sizes = df.groupBy("class", "stratum", "grp").agg(F.min("name").alias("first"), F.count("*").alias("n"))

    def finished(key, held, rng):
        if held:
            places = pa.array(split_places(np.concatenate([n for _, n in held]), ratios, rng))
            at = 0
            for groups, n in held:
                own = places.slice(at, len(n))
                at += len(n)
                yield pa.RecordBatch.from_arrays([pa.repeat(key[0], len(n)), pa.repeat(key[1], len(n)), groups, pa.array(list(SPLITS)).take(own)], ["_class", "_stratum", "_grp", "split"])

    def split(batches):
        key, held, rng = None, [], None
        for batch in batches:
            names = [batch.column(c) for c in ("class", "stratum")]
            ends = np.unique(np.concatenate([pc.run_end_encode(c).run_ends.to_numpy() for c in names])) if len(batch) else []
            for a, b in zip([0, *ends[:-1]], ends):
                new = tuple(c[int(a)] for c in names)
                if key is None or new != key:
                    yield from finished(key, held, rng)
                    if key is None or new[0] != key[0]:
                        rng = random.Random(f"{seed}:{new[0].as_py()}")
                    key, held = new, []
                # Copies, as a slice would keep all of its batch.
                rows = pa.array(np.arange(a, b))
                held.append((batch.column("grp").take(rows), batch.column("n").take(rows).to_numpy()))
        yield from finished(key, held, rng)

    kinds = dict(df.dtypes)
    by_class = sizes.repartition("class").sortWithinPartitions("class", "stratum", "first", "grp").select("class", "stratum", "grp", "n")
    splits = by_class.mapInArrow(split, f"_class {kinds['class']}, _stratum string, _grp {kinds['grp']}, split string")
    same = F.col("class").eqNullSafe(F.col("_class")) & (F.col("stratum") == F.col("_stratum")) & F.col("grp").eqNullSafe(F.col("_grp"))
    return df.join(splits, same).select("class", "name", "split")


def split_places(sizes: np.ndarray, ratios: tuple[float, float, float], rng: random.Random) -> np.ndarray:
    """The place in SPLITS of each group of so many files: in shuffled order, each to the split with the most room."""
    order = array("i", range(len(sizes)))
    rng.shuffle(order)
    order, places, total = np.frombuffer(order, np.int32), np.zeros(len(sizes), np.int8), int(sizes.sum())
    room = [round(total * ratios[0]), round(total * ratios[1])]
    room.append(total - sum(room))
    for at in range(0, len(order), WALKED_GROUPS):
        own, told = order[at : at + WALKED_GROUPS], []
        for n in sizes[own].tolist():
            s = room.index(max(room))
            room[s] -= n
            told.append(s)
        places[own] = told
    return places


def hashed_split(group: Column, class_: Column, ratios: tuple[int, int] = (70, 85), seed: int = 42) -> Column:
    """The scalable split: a group's split by a hash of seed, class and group; about the ratios."""
    text = F.concat_ws(":", F.lit(str(seed)), class_.cast("string"), group.cast("string"))
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100
    return F.when(bucket < ratios[0], "train").when(bucket < ratios[1], "val").otherwise("test")


def class_weights(df: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, n, weight): n / (classes present * n of the class), 0 for absent ones; sampler weight 1 / n."""
    counts = counts_by_class(df, classes)
    total, present = F.sum("n").over(Window.partitionBy()), F.sum((F.col("n") > 0).cast("int")).over(Window.partitionBy())
    weight = F.coalesce(F.try_divide(total.cast("double"), present * F.col("n")), F.lit(0.0))
    return counts.withColumn("weight", weight).withColumn("sampler", F.coalesce(F.try_divide(F.lit(1.0), F.col("n")), F.lit(0.0)))


def round_robin(df: DataFrame, bucket: str, order: list[str]) -> DataFrame:
    """Adds nth and turn: the place of each row when the buckets emit a row each in turn, from 1.

    A row's turn is its place by (nth, bucket) over the whole table. Buckets are in ascending order, a null one last.
    """
    nth = placed(df, [bucket], order, "nth").withColumn("nth", (F.col("nth") + 1).cast("int"))
    return placed(nth, [], ["nth", F.col(bucket).asc_nulls_last()], "turn").withColumn("turn", F.col("turn") + 1)


def append_first(log: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of new to append to a log: the first of each key that the log has not."""
    return first_copies(new, keys, order).join(log.select(*keys), keys, "left_anti")


def append_new(log: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new to append to a log: all whose key the log has not, repeated ones too."""
    return new.join(log.select(*keys).distinct(), keys, "left_anti")


def expand_selectors(args: list[str], classes: DataFrame, aliases: DataFrame, only: Column | None = None, strict: bool = True) -> DataFrame:
    """(name, place): names and aliases to classes, in order of argument and then of class; a class stands where it first occurs.

    classes(idx, name), aliases(alias, idx). A word that is neither raises ValueError, unless not strict. `only` keeps some classes."""
    spark = classes.sparkSession
    named = classes.select(F.col("name").alias("arg"), "idx", "name")
    members = aliases.select(F.col("alias").alias("arg"), "idx").join(classes, "idx").select("arg", "idx", "name").unionByName(named)
    words = spark.range(1).select(F.posexplode(F.array(*map(F.lit, args))).alias("pos", "arg"))
    unknown = [r["arg"] for r in words.join(members, "arg", "left_anti").collect()] if strict else []
    if unknown:
        raise ValueError(f"no such class or alias: {sorted(unknown)}")
    found = words.join(members if only is None else members.where(only), "arg").groupBy("name", "idx").agg(F.min("pos").alias("pos"))
    # As many rows as there are classes.
    return found.select("name", F.row_number().over(Window.orderBy("pos", "idx")).cast("long").alias("place"))


def first_contained(text: Column, names: list[str]) -> Column:
    """The first of the names, in order, that the lower-cased text contains; null without one."""
    return F.coalesce(*(F.when(F.contains(F.lower(text), F.lit(n)), n) for n in names))


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str, rule: str, who: str) -> DataFrame:
    """(rule, who): rows whose key no parent has; a null key is none either."""
    return df.withColumn("_key", F.col(key)).join(parents.select(F.col(parent_key).alias("_key")), "_key", "left_anti").select(F.lit(rule).alias("rule"), F.col(who).alias("who"))


def repeated(df: DataFrame, key: str, rule: str) -> DataFrame:
    """(rule, who): values that stand more than once."""
    return df.groupBy(key).count().where("count > 1").select(F.lit(rule).alias("rule"), F.col(key).alias("who"))


def blank(df: DataFrame, column: str, rule: str) -> DataFrame:
    """(rule, who): values that are empty but for spaces."""
    return df.where(F.trim(column) == "").select(F.lit(rule).alias("rule"), F.col(column).alias("who"))
