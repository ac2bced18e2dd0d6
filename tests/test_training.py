"""Two-stage training on planted classes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanworks.operators import audit as au
from gleanworks.operators import training as tr
from gleanworks.sources import files


def planted(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(9).normal(0, 1, (5, 6))
    y = rng.integers(0, 5, n)
    x = centres[y] + rng.normal(0, 0.4, (n, 6))
    rows = [(int(i), [float(v) for v in x[i]], int(y[i])) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, 1), (n + 1, rows[0][1], None)], "id long, v array<double>, y int")


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    plan = tr.Plan(hidden=4)
    params = tr.fresh(3, 4, plan)
    x, y, w = rng.normal(0, 1, (7, 3)), rng.integers(0, 4, 7), rng.uniform(0.5, 2, 7)
    _, grads = tr.gradients(x, y, w, params, 0.1)
    for name, p in params.items():
        for at in np.ndindex(p.shape):
            moved = {k: v.copy() for k, v in params.items()}
            moved[name][at] += 1e-6
            up = tr.gradients(x, y, w, moved, 0.1)[0]
            moved[name][at] -= 2e-6
            assert grads[name][at] == pytest.approx((up - tr.gradients(x, y, w, moved, 0.1)[0]) / 2e-6, abs=1e-5)


def test_rates():
    plan = tr.Plan(epochs=7, freeze_epochs=2, warmup_epochs=2, head_lr=1.0, lr=0.5, min_lr=0.1)
    got = tr.schedule(plan)
    assert [s for s, _ in got] == [1, 1, 2, 2, 2, 2, 2]
    cosine = lambda top, i, n: 0.1 + (top - 0.1) * (1 + math.cos(math.pi * i / n)) / 2
    assert [r for _, r in got] == pytest.approx([1.0, cosine(1.0, 1, 2), 0.05, 0.275, 0.5, cosine(0.5, 1, 3), cosine(0.5, 2, 3)])
    assert tr.schedule(tr.Plan(epochs=2, freeze_epochs=0, warmup_epochs=5, lr=0.5)) == [(2, 0.05), (2, 0.5)]
    assert tr.groups(tr.fresh(2, 2, plan), 1) == {"head.weight": 1.0, "head.bias": 0.0}


def test_stages_learn_and_stop(spark, tmp_path):
    plan = tr.Plan(epochs=7, freeze_epochs=2, batches=3, hidden=8, patience=2, head_lr=0.1, lr=0.05)
    train, val = planted(spark), planted(spark, 90, 2)
    kept, history = tr.train_stages(train, val, "v", "y", 5, plan)
    assert history[-1]["train_loss"] < 0.8 * history[0]["train_loss"] and kept["metrics"]["val_top3"] > 0.9
    table = files.append_history(tr.history_table(spark, history), str(tmp_path / "history"))
    trace = au.early_stop(table, "epoch", "val_top3", 2).orderBy("epoch").collect()
    assert len(trace) == len(history) and not any(r["stopped"] for r in trace)
    assert len(history) == 7 or trace[-1]["bad"] == 2  # it ends where the trace would stop
    assert kept["epoch"] + 1 == max(r["epoch"] for r in trace if r["improved"])
    again, other = tr.train_stages(train.repartition(7), val, "v", "y", 5, plan)
    assert [h["val_top3"] for h in other] == [h["val_top3"] for h in history]
    tr.save_checkpoint(spark, kept, list("abcde"), str(tmp_path / "model"))
    back = tr.load_checkpoint(spark, list("abcde"), str(tmp_path / "model"))
    assert all(np.array_equal(back["params"][k], kept["params"][k]) for k in kept["params"]) and back["epoch"] == kept["epoch"]
    with pytest.raises(ValueError):
        tr.load_checkpoint(spark, list("abced"), str(tmp_path / "model"))
    _, more = tr.train_stages(train, val, "v", "y", 5, tr.Plan(**{**back["plan"], "epochs": back["epoch"] + 3}), resume=back)
    assert more[0]["epoch"] == back["epoch"] + 2
    p = tr.trained_scores(val, "v", kept["params"]).where("v IS NOT NULL").select(F.aggregate("p", F.lit(0.0), lambda a, b: a + b).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert p[0] == pytest.approx(1) and p[1] == pytest.approx(1)


def test_the_frozen_backbone_stays(spark):
    plan = tr.Plan(epochs=1, freeze_epochs=1, batches=2, hidden=4)
    kept, _ = tr.train_stages(planted(spark, 60), planted(spark, 30, 2), "v", "y", 5, plan)
    start = tr.fresh(6, 5, plan)
    assert np.array_equal(kept["params"]["backbone.weight"], start["backbone.weight"]) and not np.array_equal(kept["params"]["head.weight"], start["head.weight"])


def test_gradients_as_a_tree(spark, monkeypatch):
    rows = tr._rows(planted(spark), "v", "y").repartition(11)
    params = tr.fresh(6, 5, tr.Plan(hidden=8))
    whole = tr.step_sums(rows, params, 0.1)
    monkeypatch.setattr(tr, "FAN_IN", 3)
    parts = tr.step_sums(rows, params, 0.1)
    assert whole[:2] == parts[:2] == (240.0, 240.0) and whole[3] == parts[3] and np.allclose(whole[4], parts[4])


def test_training_on_nothing(spark):
    empty = planted(spark).limit(0)
    kept, history = tr.train_stages(empty, empty, "v", "y", 5, tr.Plan(epochs=2, freeze_epochs=1, batches=2))
    assert [h["train_loss"] for h in history] == [0.0, 0.0] and kept["epoch"] == 1
