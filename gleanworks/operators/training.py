"""Two-stage training by minibatches over a table: a frozen backbone first, then all of the network.

The network is a layer of rectified units (the backbone) and a linear head, small enough for every
task. Rows are dealt to minibatches by a hash of seed and id and written so once, partitioned by
batch; a step reads its own batch only, each of its tasks streams its rows and gives one gradient, and
gradients are added as a tree, so that neither a task nor the driver holds more than a few of them. The
order of the batches is drawn anew for each epoch from (seed, epoch).
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.operators.learning import balanced_weights
from gleanworks.operators.sampling import seeded_key
from gleanworks.session import checkpoint_root

#: Gradients that are added at a time.
FAN_IN = 32
HISTORY = ("epoch", "stage", "lr", "train_loss", "train_top1", "val_loss", "val_top1", "val_top3")


@dataclass(frozen=True)
class Plan:
    """epochs counts both stages; rates hold for an epoch; monitor is loss-free: top1 or top3 of the validation rows."""

    epochs: int = 8
    freeze_epochs: int = 2
    warmup_epochs: int = 1
    batches: int = 4
    hidden: int = 32
    head_lr: float = 0.02
    lr: float = 0.01
    min_lr: float = 1e-4
    weight_decay: float = 1e-2
    label_smoothing: float = 0.1
    clip: float = 1.0
    patience: int = 4
    monitor: str = "top3"
    balanced: bool = True
    seed: int = 42


def schedule(plan: Plan) -> list[tuple[int, float]]:
    """(stage, rate) of each epoch: a cosine a stage, the second one after a linear warm-up from a tenth."""
    cosine = lambda top, i, n: plan.min_lr + (top - plan.min_lr) * (1 + math.cos(math.pi * i / max(n, 1))) / 2
    first = min(max(plan.freeze_epochs, 0), plan.epochs)
    out = [(1, cosine(plan.head_lr, i, first)) for i in range(first)]
    rest = max(plan.epochs - first, 1)
    warm = min(plan.warmup_epochs, max(rest - 1, 0))
    for i in range(plan.epochs - first):
        out.append((2, plan.lr * (0.1 + 0.9 * i / warm) if i < warm else cosine(plan.lr, i - warm, rest - warm)))
    return out


def fresh(inputs: int, classes: int, plan: Plan) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(plan.seed)
    return {
        "backbone.weight": rng.normal(0, math.sqrt(2 / inputs), (inputs, plan.hidden)), "backbone.bias": np.zeros(plan.hidden),
        "head.weight": rng.normal(0, math.sqrt(1 / plan.hidden), (plan.hidden, classes)), "head.bias": np.zeros(classes),
    }


def groups(params: dict[str, np.ndarray], stage: int) -> dict[str, float]:
    """The parameters that a stage trains, with 1 for those that decay: matrices do, biases do not."""
    return {k: float(v.ndim > 1) for k, v in params.items() if stage == 2 or k.startswith("head.")}


def scores(x: np.ndarray, params: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(hidden layer, log probabilities) of rows x."""
    hidden = np.maximum(x @ params["backbone.weight"] + params["backbone.bias"], 0)
    z = hidden @ params["head.weight"] + params["head.bias"]
    z = z - z.max(1, keepdims=True)
    return hidden, z - np.log(np.exp(z).sum(1, keepdims=True))


def gradients(x: np.ndarray, y: np.ndarray, w: np.ndarray, params: dict[str, np.ndarray], smoothing: float) -> tuple[float, dict[str, np.ndarray]]:
    """(loss, gradient by parameter) summed over rows, of weighted cross-entropy with smoothed labels."""
    hidden, logs = scores(x, params)
    k = logs.shape[1]
    want = np.full(logs.shape, smoothing / k)
    want[np.arange(len(y)), y] += 1 - smoothing
    off = (np.exp(logs) - want) * w[:, None]
    back = off @ params["head.weight"].T * (hidden > 0)
    grads = {"backbone.weight": x.T @ back, "backbone.bias": back.sum(0), "head.weight": hidden.T @ off, "head.bias": off.sum(0)}
    return float(-(want * logs).sum(1) @ w), grads


def _hits(logs: np.ndarray, y: np.ndarray, k: int) -> int:
    """Rows whose class is among the first k; equal scores go to the lower class."""
    own = logs[np.arange(len(y)), y][:, None]
    ahead = (logs > own).sum(1) + ((logs == own) & (np.arange(logs.shape[1]) < y[:, None])).sum(1)
    return int((ahead < k).sum())


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = batch.column("x")
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
    return x, batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64), batch.column("w").to_numpy(zero_copy_only=False)


def _flat(grads: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([grads[k].ravel() for k in sorted(grads)])


def _shaped(flat: np.ndarray, params: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(params):
        out[k] = flat[at : at + params[k].size].reshape(params[k].shape)
        at += params[k].size
    return out


STEP = "part int, n double, weight double, loss double, hits long, grad binary"


def step_sums(rows: DataFrame, params: dict[str, np.ndarray], smoothing: float) -> tuple[float, float, float, int, np.ndarray]:
    """(rows, weight, loss, hits, flat gradient) over rows(x, y, w): a gradient a task, added FAN_IN at a time."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n = weight = loss = 0.0
        hits, total = 0, np.zeros(sum(p.size for p in params.values()))
        for batch in batches:
            if len(batch):
                x, y, w = _arrays(batch)
                more, grads = gradients(x, y, w, params, smoothing)
                n, weight, loss, hits, total = n + len(y), weight + w.sum(), loss + more, hits + _hits(scores(x, params)[1], y, 1), total + _flat(grads)
        row = {"part": [TaskContext.get().partitionId()], "n": [n], "weight": [weight], "loss": [loss], "hits": [hits], "grad": [total.tobytes()]}
        yield pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("n", pa.float64()), ("weight", pa.float64()), ("loss", pa.float64()), ("hits", pa.int64()), ("grad", pa.binary())]))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        total = np.sum([np.frombuffer(g) for g in pdf["grad"]], axis=0)
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], **{c: [pdf[c].sum()] for c in ("n", "weight", "loss", "hits")}, "grad": [total.tobytes()]})

    sums = rows.select("x", "y", "w").mapInArrow(partial, STEP)
    parts, width = rows.rdd.getNumPartitions(), 1
    while parts > FAN_IN:
        width *= FAN_IN
        sums, parts = sums.groupBy(F.floor(F.col("part") / width).alias("_g")).applyInPandas(add, STEP), -(-parts // FAN_IN)
    own = sorted(sums.collect(), key=lambda r: r["part"])
    grad = np.sum([np.frombuffer(r["grad"]) for r in own], axis=0) if own else np.zeros(sum(p.size for p in params.values()))
    return sum(r["n"] for r in own), sum(r["weight"] for r in own), sum(r["loss"] for r in own), sum(r["hits"] for r in own), grad


def validation(rows: DataFrame, params: dict[str, np.ndarray]) -> dict[str, float]:
    """loss, top1 and top3 over rows(x, y, w), unweighted and without smoothing; 0 over no rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x, y, _ = _arrays(batch)
                logs = scores(x, params)[1]
                row = {"n": [len(y)], "loss": [float(-logs[np.arange(len(y)), y].sum())], "top1": [_hits(logs, y, 1)], "top3": [_hits(logs, y, 3)]}
                yield pa.RecordBatch.from_pydict(row, pa.schema([("n", pa.int64()), ("loss", pa.float64()), ("top1", pa.int64()), ("top3", pa.int64())]))

    sums = rows.select("x", "y", "w").mapInArrow(partial, "n long, loss double, top1 long, top3 long")
    r = sums.agg(*(F.sum(c).alias(c) for c in ("n", "loss", "top1", "top3"))).first()
    return {c: (r[c] or 0) / max(r["n"] or 0, 1) for c in ("loss", "top1", "top3")}


class AdamW:
    """Adam with decoupled weight decay over one stage's parameters."""

    def __init__(self, decays: dict[str, float]) -> None:
        self.decays, self.steps, self.first, self.second = decays, 0, {}, {}

    def step(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray], lr: float, plan: Plan) -> dict[str, np.ndarray]:
        norm = math.sqrt(sum(float((grads[k] ** 2).sum()) for k in self.decays))
        scale, out = min(1.0, plan.clip / (norm + 1e-6)), dict(params)
        self.steps += 1
        for k, decay in self.decays.items():
            g = grads[k] * scale
            self.first[k] = 0.9 * self.first.get(k, 0.0) + 0.1 * g
            self.second[k] = 0.999 * self.second.get(k, 0.0) + 0.001 * g * g
            m, v = self.first[k] / (1 - 0.9**self.steps), self.second[k] / (1 - 0.999**self.steps)
            out[k] = params[k] * (1 - lr * plan.weight_decay * decay) - lr * m / (np.sqrt(v) + 1e-8)
        return out


def _rows(df: DataFrame, vec: str, label: str) -> DataFrame:
    """(id, x, y, w) of rows with a vector and a label."""
    return df.where(F.col(vec).isNotNull() & F.col(label).isNotNull()).select(F.col("id"), F.col(vec).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"), F.lit(1.0).alias("w"))


def dealt(df: DataFrame, vec: str, label: str, plan: Plan) -> DataFrame:
    """(id, x, y, w, batch) of df(id, vec, label), written by batch; balanced weights make the classes count alike."""
    rows = _rows(df, vec, label)
    if plan.balanced:
        weights = balanced_weights(rows.select("y"), "y").select("y", F.col("weight").alias("w")).distinct()
        rows = rows.drop("w").join(weights, "y").select("id", "x", "y", "w")
    rows = rows.withColumn("batch", (seeded_key(plan.seed, "id") % plan.batches).cast("int"))
    path = f"{checkpoint_root(df.sparkSession)}/batches-{uuid.uuid4().hex}"
    rows.write.partitionBy("batch").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def train_stages(train: DataFrame, val: DataFrame, vec: str, label: str, classes: int, plan: Plan, resume: dict | None = None) -> tuple[dict, list[dict]]:
    """(checkpoint of the best epoch, history): df(id, vec, label) each; stops after `patience` epochs without a strictly better monitor.

    A checkpoint is {"params", "epoch", "metrics", "plan"}; resume takes one up after its epoch, with its best. Without an epoch that
    beats 0 the last one's parameters are returned."""
    batches, held = dealt(train, vec, label, plan), _rows(val, vec, label)
    first = train.where(F.col(vec).isNotNull()).select(F.size(vec).alias("n")).first()
    params = resume["params"] if resume else fresh(first["n"] if first else 1, classes, plan)
    best, start = (resume["metrics"][f"val_{plan.monitor}"], resume["epoch"] + 1) if resume else (0.0, 0)
    kept = resume or {"params": params, "epoch": -1, "metrics": {}, "plan": asdict(plan)}
    history, bad, stage, adam = [], 0, 0, None
    for epoch, (now, lr) in list(enumerate(schedule(plan)))[start:]:
        if now != stage:
            stage, adam = now, AdamW(groups(params, now))
        n = loss = hits = weight = 0.0
        for b in np.random.default_rng([plan.seed, epoch]).permutation(plan.batches).tolist():
            rows, heavy, more, good, grad = step_sums(batches.where(F.col("batch") == b), params, plan.label_smoothing)
            if rows:
                params = adam.step(params, _shaped(grad / max(heavy, 1e-12), params), lr, plan)
                n, weight, loss, hits = n + rows, weight + heavy, loss + more, hits + good
        found = validation(held, params)
        history.append(dict(zip(HISTORY, (epoch + 1, stage, round(lr, 8), round(loss / max(weight, 1e-12), 4), round(hits / max(n, 1), 4), *(round(found[c], 4) for c in ("loss", "top1", "top3"))))))
        if found[plan.monitor] > best or (kept["epoch"] < 0 and epoch == plan.epochs - 1):
            best, bad = max(best, found[plan.monitor]), 0
            kept = {"params": params, "epoch": epoch, "metrics": {f"val_{k}": v for k, v in found.items()}, "plan": asdict(plan)}
        else:
            bad += 1
            if bad >= plan.patience:
                break
    return kept, history


def history_table(spark: SparkSession, history: list[dict]) -> DataFrame:
    """A row an epoch."""
    kinds = "epoch int, stage int, lr double, train_loss double, train_top1 double, val_loss double, val_top1 double, val_top3 double"
    return spark.createDataFrame([tuple(h[c] for c in HISTORY) for h in history], kinds)


def save_checkpoint(spark: SparkSession, checkpoint: dict, classes: list[str], path: str) -> None:
    """A row a parameter, and one of what else a checkpoint tells, with the classes in order."""
    rows = [(k, list(v.shape), v.ravel().tolist()) for k, v in checkpoint["params"].items()]
    told = json.dumps({"epoch": checkpoint["epoch"], "metrics": checkpoint["metrics"], "plan": checkpoint["plan"], "classes": list(classes)})
    spark.createDataFrame(rows, "name string, shape array<int>, data array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
    spark.createDataFrame([(told,)], "told string").write.mode("overwrite").parquet(f"{path}/told")


def load_checkpoint(spark: SparkSession, classes: list[str], path: str) -> dict:
    """A saved checkpoint; refused unless its classes are these, in this order."""
    told = json.loads(spark.read.parquet(f"{path}/told").first()["told"])
    if told["classes"] != list(classes):
        raise ValueError(f"the model's classes are {told['classes']}")
    params = {r["name"]: np.array(r["data"]).reshape(r["shape"]) for r in spark.read.parquet(f"{path}/params").collect()}
    return {"params": params, "epoch": told["epoch"], "metrics": told["metrics"], "plan": told["plan"]}


def trained_scores(df: DataFrame, vec: str, params: dict[str, np.ndarray], out: str = "p") -> DataFrame:
    """df with the class probabilities of a checkpoint's parameters, null for a null vector."""

    @F.pandas_udf("array<double>")
    def score(v: pd.Series) -> pd.Series:
        some = [i for i, x in enumerate(v) if x is not None]
        found: list = [None] * len(v)
        if some:
            logs = scores(np.stack([v.iloc[i] for i in some]).astype(np.float64), params)[1]
            for i, row in zip(some, np.exp(logs)):
                found[i] = row
        return pd.Series(found, dtype=object)

    return df.withColumn(out, score(F.col(vec)))
