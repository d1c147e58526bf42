"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts; a small
classifier (one hidden layer, numpy) learns to name the part of a vector from
the parts of its neighbours. Every row of the table is indexed under its most
probable part. A query is routed to its most probable parts, and their rows are
reranked by the exact inner product in double precision. The number of parts
to open is the smallest that finds the wanted share of the neighbours of
held-out sample rows, so it follows the data.

Bounds: the sample (``sample_rows``) and the classifier live on the driver and
are broadcast. Index parts and query lists are split into blocks of at most
about ``BLOCK`` rows, every block of queries meets every block of rows of a
part, and each such pair sends one list of ``k`` rows a query to the last merge,
so a part that holds a third of all rows is spread over many tasks.

Cases: rows whose vector is null, empty, zero, or has null or non-finite
components, or another length than most vectors, take no part. A row without
id is never a query; as a neighbour it ranks behind equal scores. Equal scores
go to the smaller id. Repeated rows are rows of their own. Fewer than ``k``
other rows: all found are returned. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.tables import saved

SAMPLE = 8192
HOLDOUT = 512
ROWS_PER_PART = 4096
MIN_PARTS = 16
MAX_PARTS = 256
WANTED = 0.95
BLOCK = 8192
NO_ID = (1 << 63) - 1


# --- balanced partitioning of the sample's neighbour graph -------------------
def top_inner(queries: np.ndarray, rows: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Positions of the ``k`` rows with the largest inner products."""
    out = []
    for at in range(0, len(queries), 512):
        s = queries[at:at + 512] @ rows.T
        if own is not None:
            s[np.arange(len(s)), own[at:at + 512]] = -np.inf
        out.append(np.argpartition(-s, min(k, s.shape[1]) - 1, 1)[:, :k])
    return np.concatenate(out)


def halve(x: np.ndarray, rows: np.ndarray, parts: int, label: int, out: np.ndarray) -> None:
    """First cut: split along the direction of most variance, by halves."""
    if parts == 1:
        out[rows] = label
        return
    centred = x[rows] - x[rows].mean(0)
    direction = np.linalg.svd(centred[:2048], full_matrices=False)[2][0]
    order = rows[np.argsort(centred @ direction, kind="stable")]
    half = len(order) // 2
    halve(x, order[:half], parts // 2, label, out)
    halve(x, order[half:], parts // 2, label + parts // 2, out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 0.1) -> np.ndarray:
    """Part of each sample row: label propagation over the neighbour graph in
    which no part grows over (1 + slack) or shrinks under (1 - slack) of the mean."""
    n = len(x)
    label = np.zeros(n, np.int64)
    halve(x, np.arange(n), parts, 0, label)
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])  # an edge counts for both ends
    size, high, low = np.bincount(label, minlength=parts), math.ceil((1 + slack) * n / parts), math.floor((1 - slack) * n / parts)
    for _ in range(rounds):
        votes = np.bincount(a * parts + label[b], minlength=n * parts).reshape(n, parts)
        wish = votes.argmax(1)
        gain = votes[np.arange(n), wish] - votes[np.arange(n), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable")[:int((gain > 0).sum())]:
            if size[wish[i]] < high and size[label[i]] > low:
                size[wish[i]] += 1
                size[label[i]] -= 1
                label[i] = wish[i]
                moved += 1
        if not moved:
            break
    return label


# --- classifier --------------------------------------------------------------
def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    """Log-probability of each part, up to a constant a row."""
    return np.maximum((x * model["scale"]) @ model["w1"] + model["b1"], 0) @ model["w2"] + model["b2"]


def train_classifier(x: np.ndarray, target: np.ndarray, hidden: int = 64, epochs: int = 40, seed: int = 1) -> dict:
    """Softmax classifier with one hidden layer; ``target`` rows are the shares
    of parts among a row and its neighbours."""
    rng, parts = np.random.default_rng(seed), target.shape[1]
    scale = np.float32(math.sqrt(x.shape[1]) / max(1e-30, float(np.sqrt((x.astype(np.float64) ** 2).sum(1).mean()))))
    net = {"w1": rng.normal(0, math.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), "b1": np.zeros(hidden),
           "w2": rng.normal(0, math.sqrt(1 / hidden), (hidden, parts)), "b2": np.zeros(parts)}
    net = {k: v.astype(np.float32) for k, v in net.items()}
    m, v, t = {k: np.zeros_like(w) for k, w in net.items()}, {k: np.zeros_like(w) for k, w in net.items()}, 0
    for epoch in range(epochs):
        rate = 3e-3 if epoch < epochs * 2 // 3 else 5e-4
        order = rng.permutation(len(x))
        for at in range(0, len(order), 128):
            rows = order[at:at + 128]
            xb = x[rows] * scale
            h = np.maximum(xb @ net["w1"] + net["b1"], 0)
            z = h @ net["w2"] + net["b2"]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = (p - target[rows]) / len(rows)
            dh = (d @ net["w2"].T) * (h > 0)
            t += 1
            for k, g in {"w1": xb.T @ dh, "b1": dh.sum(0), "w2": h.T @ d, "b2": d.sum(0)}.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                net[k] -= np.float32(rate * math.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)) * m[k] / (np.sqrt(v[k]) + 1e-8)
    return net | {"scale": scale}


def fit(sample: np.ndarray, parts: int, k: int, wanted: float) -> dict:
    """Classifier over balanced parts, and how many parts to open."""
    x = np.ascontiguousarray(sample, np.float32)
    with np.errstate(all="ignore"):
        x = x / np.float32(max(1e-30, np.abs(x).max()))  # a common factor changes no order
    held = x[:min(HOLDOUT, len(x) // 8)]
    rows = x[len(held):]
    graph = top_inner(rows, rows, min(10, max(1, len(rows) - 1)), np.arange(len(rows)))
    label = balanced_parts(rows, graph, parts)
    target = np.zeros((len(rows), parts), np.float32)
    np.add.at(target, (np.arange(len(rows)), label), 1)
    for column in graph.T:
        np.add.at(target, (np.arange(len(rows)), label[column]), 1)
    model = train_classifier(rows, target / target.sum(1, keepdims=True))
    model["scale"] = np.float32(model["scale"] / max(1e-30, np.abs(sample).max()))
    probes = parts
    if len(held):
        index = probabilities(model, sample[len(held):].astype(np.float32)).argmax(1)
        near = top_inner(held, rows, min(k, len(rows)))
        order = np.argsort(-probabilities(model, sample[:len(held)].astype(np.float32)), 1)
        place = np.argsort(order, 1)  # how many parts are opened before each part
        needed = np.take_along_axis(place, index[near], 1)
        recall = [(needed < p).mean() for p in range(1, parts + 1)]
        probes = 1 + int(np.argmax(np.array(recall) >= wanted))
    return model | {"probes": probes}


# --- search ------------------------------------------------------------------
def vectors_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an Arrow list column without nulls as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def best_of(queries: np.ndarray, q_row: np.ndarray, rows: np.ndarray, row: np.ndarray, ids: np.ndarray, k: int):
    """Exact best ``k`` rows of a block for each query: (query, row, score)."""
    out = []
    scaled = rows.astype(np.float64)
    scaled /= max(np.abs(scaled).max(initial=0), 1e-300)  # a common factor changes no order, and products stay finite
    r32 = scaled.astype(np.float32)
    norms = np.sqrt((scaled ** 2).sum(1)).max(initial=0)
    for at in range(0, len(queries), 128):
        q = queries[at:at + 128]
        q64 = q.astype(np.float64)
        q64 /= np.maximum(np.abs(q64).max(1, keepdims=True), 1e-300)
        s = q64.astype(np.float32) @ r32.T
        s[q_row[at:at + 128][:, None] == row] = -np.inf  # the only score that isn't finite
        # rows that may be among the best k in double precision
        kth = np.partition(s, -k, 1)[:, -k] if s.shape[1] > k else np.full(len(q), -np.inf, np.float32)
        margin = 1e-5 * norms * np.sqrt((q64 ** 2).sum(1))
        qi, ri = np.nonzero((s >= (kth - margin)[:, None]) & np.isfinite(s))
        score = np.empty(len(qi))
        for b in range(0, len(qi), 50_000):
            part = slice(b, b + 50_000)
            score[part] = (q[qi[part]].astype(np.float64) * rows[ri[part]].astype(np.float64)).sum(1)
        own = q_row[at:at + 128][qi] == row[ri]
        qi, ri, score = qi[~own], ri[~own], score[~own]
        order = np.lexsort((row[ri], ids[ri], -score, qi))
        qi, ri, score = qi[order], ri[order], score[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = rank < k
        out.append((qi[keep] + at, ri[keep], score[keep]))
    return [np.concatenate(c) for c in zip(*out)]


def valid(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    v = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(table: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", sample_rows: int = SAMPLE,
            rows_per_part: int = ROWS_PER_PART, wanted: float = WANTED) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for each row
    of ``table`` for which ``is_query`` (over its columns) holds."""
    spark = table.sparkSession
    rows = (table.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vector_col).alias("v"), (F.coalesce(is_query, F.lit(False)) & F.col(id_col).isNotNull()).alias("asks"))
            .where(valid(F.col("v"))))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dims, n = sizes
    rows = rows.where(F.size("v") == dims)
    parts = min(MAX_PARTS, max(MIN_PARTS, 1 << max(0, round(math.log2(n / rows_per_part)))))
    share = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < math.ceil((1 << 30) * min(1, (sample_rows + HOLDOUT) / n))
    sample = np.array([r["v"] for r in rows.where(share).select("row", "v").limit(2 * (sample_rows + HOLDOUT)).collect()], np.float64).reshape(-1, dims)
    model = fit(sample, parts, k, wanted) if len(sample) >= 4 * parts else None
    probes = model["probes"] if model else 1
    held = spark.sparkContext.broadcast(model)
    kind = dict(rows.dtypes)["v"]

    def route(batches):
        for batch in batches:
            x = vectors_of(batch.column(2)).astype(np.float32)
            order = np.zeros((len(x), 1), np.int32) if held.value is None else np.argsort(-probabilities(held.value, x), 1, kind="stable")[:, :probes].astype(np.int32)
            flat = pa.array(order.ravel(), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, order.size + 1, order.shape[1]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["row", "vec_id", "v", "asks", "parts"])

    # read three times: counted, searched in and searched for
    index = saved(rows.mapInArrow(route, f"row long, vec_id long, v {kind}, asks boolean, parts array<int>"))
    size = {r["p"]: r["n"] for r in index.groupBy(F.col("parts")[0].alias("p")).agg(F.count("*").alias("n")).collect()}  # at most MAX_PARTS rows
    asked = {r["p"]: r["n"] for r in index.where("asks").select(F.explode("parts").alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()}
    block = lambda counts: F.create_map(*[F.lit(x) for p in range(parts) for x in (p, -(-counts.get(p, 0) // BLOCK) or 1)])
    row_blocks, query_blocks = block(size), block(asked)
    # every block of a part's rows meets every block of its queries
    base = (index.select("row", "vec_id", "v", F.col("parts")[0].alias("part"))
            .withColumn("rb", F.pmod(F.hash("row"), row_blocks[F.col("part")]))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), query_blocks[F.col("part")] - 1))))
    asks = (index.where("asks").select("row", "vec_id", "v", F.explode("parts").alias("part"))
            .withColumn("qb", F.pmod(F.hash("row"), query_blocks[F.col("part")]))
            .withColumn("rb", F.explode(F.sequence(F.lit(0), row_blocks[F.col("part")] - 1))))
    found = "q_row long, query_id long, best array<struct<minus:double,vec_id:long,row:long>>"

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        """One row per query: its best rows of the block, best first."""
        if not left.num_rows or not right.num_rows:
            q_row, row = left.column("row").to_numpy()[:0], np.zeros(0, np.int64)
            qi, ri, score, ids = row, row, np.zeros(0), row
        else:
            q_row, row = left.column("row").to_numpy(), right.column("row").to_numpy()
            ids = right.column("vec_id").fill_null(NO_ID).to_numpy()
            qi, ri, score = best_of(vectors_of(left.column("v")), q_row, vectors_of(right.column("v")), row, ids, k)
        first = np.flatnonzero(np.diff(qi, prepend=-1))
        best = pa.StructArray.from_arrays([pa.array(-score), pa.array(ids[ri], pa.int64()), pa.array(row[ri], pa.int64())], ["minus", "vec_id", "row"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(qi)), pa.int32()), best)
        return pa.table([pa.array(q_row[qi[first]], pa.int64()), left.column("vec_id").combine_chunks().take(pa.array(qi[first])), lists], ["q_row", "query_id", "best"])

    keys = ["part", "rb", "qb"]
    near = asks.groupBy(keys).cogroup(base.groupBy(keys)).applyInArrow(search, found)
    best = near.groupBy("q_row", "query_id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return (best.select("query_id", F.posexplode("best").alias("rank", "b"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.nullif(F.col("b.vec_id"), F.lit(NO_ID)).alias("vec_id"), (-F.col("b.minus")).alias("score")))


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for each embedding whose id is divisible by 20."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(table, F.col("vec_id") % 20 == 0, 20)


QUERIES = {"op1_learned_partitions": op1_learned_partitions}
ORACLE: dict[str, str] = {}
