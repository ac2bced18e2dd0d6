"""Whole groups to splits, against the plain walk."""

import random
from collections import Counter, defaultdict

import pytest

from gleanworks.operators import curation as cu


def walked(rows, seed=42, ratios=(0.7, 0.15, 0.15)):
    first, n = {}, Counter()
    for c, name, g, s in rows:
        k = (c, "" if s is None else "s" + s, g)
        first[k] = min(name, first.get(k, name))
        n[k] += 1
    classes = defaultdict(lambda: defaultdict(list))
    for k in first:
        classes[k[0]][k[1]].append(k)
    split = {}
    for c, strata in classes.items():
        rng = random.Random(f"{seed}:{c}")
        for s in sorted(strata):
            own = sorted(strata[s], key=lambda k: first[k])
            rng.shuffle(own)
            total = sum(n[k] for k in own)
            room = [round(total * ratios[0]), round(total * ratios[1])]
            room.append(total - sum(room))
            for k in own:
                at = room.index(max(room))
                room[at] -= n[k]
                split[k] = ("train", "val", "test")[at]
    return sorted(((c, name, split[c, "" if s is None else "s" + s, g]) for c, name, g, s in rows), key=str)


@pytest.mark.parametrize("batch, chunk", ((10_000, 1 << 16), (7, 5)))
def test_splits_as_walked(spark, monkeypatch, batch, chunk):
    """Null classes, groups and strata too; small batches cut classes and strata anywhere."""
    rnd = random.Random(batch)
    rows = [(rnd.choice(["a", "b", None]), f"f{i:04}", rnd.choice([None, *map(str, range(60))]), rnd.choice([None, "x", "y"])) for i in range(600)]
    monkeypatch.setattr(cu, "WALKED_GROUPS", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "class string, name string, grp string, stratum string").repartition(5)
        assert sorted(map(tuple, cu.group_split(df).collect()), key=str) == walked(rows)
        assert cu.group_split(df.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
