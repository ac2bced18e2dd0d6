"""Exact top-k by inner product: a Voronoi join.

Equal vectors are one candidate that keeps its k + 1 least ids. Candidates and queries go to the
cell of their nearest pivot; pivots are a sample of candidates whose number grows with the square
root of theirs, within PIVOTS. From each cell's pivot, radius and count alone, all inner products
between a query cell and a data cell lie in an interval. The lower ends give each query cell a value
that at least k + 1 candidates reach; data cells whose upper end is below it cannot matter to it.
Cells in order are cut by bytes: queries into groups, data into chunks. A data block goes to the
groups that hold a query cell which needs its cell, a query block to the chunks that hold a cell
which it needs; a task multiplies one group by one chunk, block by block, and the best of the tasks
are merged. Only the cells' summaries reach the driver.

Nulls: vectors that are null or hold a null, NaN or infinity take no part, neither do null ids.
Vectors of different lengths: missing components count as 0. Ties go to the smaller id; rows that
repeat an id are candidates and queries each. Vectors are told apart by 64-bit hashes. Empty input: an empty result. Extra columns are ignored. Products are
exact for components under 2^53 after scaling; one beyond 64 bits, which no score can hold, is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanworks.llm.common import durable, literal_table
from gleanworks.session import table

PIVOTS = (64, 512)
#: Bytes of vectors in a block, and in a task's share of the data and of the queries.
BLOCK_BYTES, CHUNK_BYTES, GROUP_BYTES = 1 << 20, 4 << 20, 4 << 20
#: Queries multiplied at once.
ROWS = 1024


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float = 64.0) -> DataFrame:
    """(id, vec): floor(scale * x) of each usable vector's components, as longs."""
    odd = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~odd)
    return usable.select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale)).alias("vec"))


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, through floating point where it is exact."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2**24:
        return (q.astype(np.float32) @ x.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return q @ x.T
    whole = q.astype(object) @ x.astype(object).T
    if any(not -(2**63) <= v < 2**63 for row in whole for v in row):
        raise ValueError("an inner product is beyond 64 bits")
    return whole.astype(np.int64)


def assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vectors(vid, vec, ...) with the cell of the nearest pivot, the distance to it and the norm."""
    centres, dim = pivots.astype(np.float64), pivots.shape[1]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema) + ", cell int, far double, norm double"

    def nearest(frames):
        for pdf in frames:
            x = _matrix(pdf["vec"], dim).astype(np.float64)
            d = (x**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * x @ centres.T
            cell = d.argmin(1)
            far = np.sqrt(((x - centres[cell]) ** 2).sum(1))
            yield pdf.assign(cell=cell.astype(np.int32), far=far, norm=np.sqrt((x**2).sum(1)))

    return vectors.mapInPandas(nearest, schema)


def cell_plan(data: list, queries: list, pivots: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(cell, goal): the data cells that each query cell needs."""
    p = pivots.astype(np.float64)
    size = np.sqrt((p**2).sum(1))
    cells, n = np.array([r["cell"] for r in data], int), np.array([r["n"] for r in data])
    radius, out = np.array([r["radius"] for r in data]), []
    for r in queries:
        g, rho = r["cell"], r["radius"]
        middle = p[cells] @ p[g]
        spread = size[g] * radius + rho * size[cells] + rho * radius
        slack = 1e-6 * (1 + np.abs(middle) + spread)  # more than the rounding of these sums
        low, high = middle - spread - slack, middle + spread + slack
        order = np.argsort(-low)
        enough = np.flatnonzero(np.cumsum(n[order]) >= k + 1)
        least = low[order[enough[0]]] if enough.size else -np.inf
        out += [(int(c), int(g)) for c in cells[high >= least]]
    return out


def cut_cells(cells: list, block: int, share: int) -> dict[int, dict]:
    """For each cell, in order: how many blocks it has, the row at which it starts, and the shares (of so many rows) that hold its blocks."""
    out, start = {}, 0
    for r in sorted(cells, key=lambda r: r["cell"]):
        parts = -(-r["rows"] // block)
        out[r["cell"]] = {"cell": r["cell"], "parts": parts, "start": start, "first": start // share, "last": (start + (parts - 1) * block) // share}
        start += r["rows"]
    return out


def spans(pairs: list[tuple[int, int]], held: dict[int, dict]) -> list[dict]:
    """(cell, spans): for each first member of pairs, the disjoint intervals of shares that hold its second members."""
    by, out = {}, []
    for x, y in pairs:
        by.setdefault(x, []).append((held[y]["first"], held[y]["last"]))
    for x, own in by.items():
        merged = []
        for first, last in sorted(own):
            if merged and first <= merged[-1]["b"] + 1:
                merged[-1]["b"] = max(merged[-1]["b"], last)
            else:
                merged.append({"a": first, "b": last})
        out.append({"cell": x, "spans": merged})
    return out


def _packed(df: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each block: its vectors' ids and components as 64-bit numbers."""

    def pack(pdf):
        dim = max(map(len, pdf["vec"]))
        head = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame(head | {"dim": [dim], "vids": [pdf["vid"].to_numpy(np.int64).tobytes()], "keys": [pdf["key"].to_numpy(np.int64).tobytes()], "data": [_matrix(pdf["vec"], dim).tobytes()]})

    schema = ", ".join(f"{k} int" for k in keys) + ", dim int, vids binary, keys binary, data binary"
    return df.groupBy(*keys).applyInPandas(pack, schema)


def _unpacked(pdf: pd.DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = []
    for d, data in zip(pdf["dim"], pdf["data"]):
        x = np.frombuffer(data, np.int64).reshape(-1, d)
        parts.append(np.pad(x, ((0, 0), (0, dim - d))))
    return *(np.frombuffer(b"".join(pdf[c]), np.int64) for c in ("vids", "keys")), np.concatenate(parts)


def best_of(scores: np.ndarray, names: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's `most` largest scores, ties to the smaller name; as many for each row."""
    if scores.shape[1] > most:
        least = np.partition(scores, scores.shape[1] - most, axis=1)[:, -most]
        row, at = np.nonzero(scores >= least[:, None])
    else:
        row, at = (x.ravel() for x in np.indices(scores.shape))
    order = np.lexsort((names[row, at], -scores[row, at], row))
    row, at = row[order], at[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    keep = np.arange(len(row)) - first[row] < most
    return row[keep], at[keep]


def nearest_join(candidates: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for candidates(id, vec) and queries(id, vec); a query's own id is no candidate."""
    spark = candidates.sparkSession
    candidates, queries = candidates.select("id", "vec"), queries.select("id", "vec")
    # The row limit a vector is applied by each task before the shuffle.
    by_vec = Window.partitionBy("vec").orderBy("id")
    least = candidates.withColumn("nth", F.row_number().over(by_vec)).where(F.col("nth") <= k + 1)
    distinct = durable(least.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumns({"vid": F.element_at("ids", 1), "key": F.xxhash64("vec")}))
    asked = queries.select("vec", F.xxhash64("vec").alias("key"), F.xxhash64("vec").alias("vid")).distinct()
    facts = distinct.agg(F.max(F.size("vec")).alias("d"), F.count("*").alias("n")).first()
    dim, few = max(facts["d"] or 1, 1), min(max(int(facts["n"] ** 0.5) // 4, PIVOTS[0]), PIVOTS[1])
    sample = [r["vec"] for r in distinct.orderBy(F.xxhash64("vid"), "vid").limit(few).collect()]
    pivots = _matrix(sample or [[0]], dim)

    data = durable(assign(distinct.select("vid", "key", "vec", F.size("ids").alias("n")), pivots))
    goals = durable(assign(asked, pivots))
    data_cells = data.groupBy("cell").agg(F.sum("n").alias("n"), F.count("*").alias("rows"), F.max("far").alias("radius")).collect()
    goal_cells = goals.groupBy("cell").agg(F.count("*").alias("rows"), F.max("far").alias("radius")).collect()
    pairs = cell_plan(data_cells, goal_cells, pivots, k)
    rows_of = lambda size: max(1, size // (8 * dim))
    block, chunk, group = rows_of(BLOCK_BYTES), rows_of(CHUNK_BYTES), rows_of(GROUP_BYTES)
    held, asking = cut_cells(data_cells, block, chunk), cut_cells(goal_cells, block, group)

    def blocks(df, cells, share, needs):
        """Packed blocks with the share that each is of, and a row for each share of the other side that needs it."""
        # At most PIVOTS rows, of at most PIVOTS spans.
        plan = literal_table(spark, [cells[r["cell"]] | r for r in needs], "cell int, parts int, start long, spans array<struct<a: int, b: int>>")
        part = F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int").alias("part")
        own = df.join(F.broadcast(plan.select("cell", "parts")), "cell").select("cell", part, "vid", "key", "vec")
        packed = _packed(own, ["cell", "part"]).join(F.broadcast(plan), "cell")
        at = F.floor((F.col("start") + F.col("part") * block) / share).cast("int").alias("own")
        to = F.flatten(F.transform("spans", lambda r: F.sequence(r["a"], r["b"])))
        return packed.select(at, F.explode(to).alias("other"), "dim", "vids", "keys", "data")

    sent = blocks(data, held, chunk, spans(pairs, asking)).withColumnsRenamed({"own": "chunk", "other": "group"})
    asked_blocks = blocks(goals, asking, group, spans([(g, c) for c, g in pairs], held)).withColumnsRenamed({"own": "group", "other": "chunk"})

    def solve(left, right):
        empty = pd.DataFrame({"qid": [], "vid": [], "key": [], "score": []})
        if not len(left) or not len(right):
            return empty
        dim = int(max(left["dim"].max(), right["dim"].max()))
        _, qids, q = _unpacked(right, dim)
        parts = [_unpacked(left.iloc[i : i + 1], dim) for i in range(len(left))]
        out = []
        for a in range(0, len(q), ROWS):
            own = q[a : a + ROWS]
            held = [np.zeros((len(own), 0), np.int64)] * 3  # scores, ids, keys
            for vids, keys, x in parts:
                new = products(own, x)
                every = [np.concatenate([h, np.broadcast_to(n, new.shape)], 1) for h, n in zip(held, (new, vids, keys))]
                spot = best_of(every[0], every[1], k + 1)
                held = [e[spot].reshape(len(own), -1) for e in every]
            scores, vids, keys = held
            out.append(pd.DataFrame({"qid": np.repeat(qids[a : a + ROWS], scores.shape[1]), "vid": vids.ravel(), "key": keys.ravel(), "score": scores.ravel()}))
        return pd.concat(out)

    tasks = sent.groupBy("group", "chunk").cogroup(asked_blocks.groupBy("group", "chunk"))
    best = tasks.applyInPandas(solve, "qid long, vid long, key long, score long")
    top = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "vid"))).where(F.col("nth") <= k + 1).drop("nth")
    ids = top(best).drop("vid").join(distinct.select("key", "ids"), "key").select("qid", "score", F.explode("ids").alias("vid"))
    answers = top(ids).groupBy("qid").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vid"))).alias("found"))
    named = queries.join(goals.select("vec", F.col("key").alias("qid")), "vec").select("id", "qid")
    rows = named.join(answers, "qid").select("id", F.slice(F.filter("found", lambda f: f["vid"] != F.col("id")), 1, k).alias("found"))
    out = rows.select(F.col("id").alias("query_id"), F.posexplode("found").alias("at", "f"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.vid").alias("vec_id"), (-F.col("f.minus")).alias("score"))


def op6_voronoi_knn(spark, sf_dir):
    """The 20 nearest vectors of every 20th, by integer inner product."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest_join(vectors, vectors.where("id % 20 = 0"))


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
