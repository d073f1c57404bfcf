"""Exact top-k inner-product search with a KD-tree for each shard.

Vectors are dealt into shards of bounded size. A shard's tree splits at the
median of the widest dimension and keeps the tight box of every node; a box
bounds the score of a query from above by its best corner. Each query first
searches one shard, which gives a lower bound of its k-th score; the bound
travels with the query to all other shards and rises along the way, and nodes
are visited best bound first until no bound reaches it. Equal scores are
settled by the smaller vec_id, so nodes whose bound equals the k-th score are
still opened.

Queries meet rows as blocks meet shards: the joined rows are pairs of a block
and a shard, each a few hundred kB, and what leaves a pair is at most k rows for
each query.

Defined cases: a vector that is null or holds null or a non-finite component
takes no part, nor does a null vec_id. Of rows that share a vec_id the smallest
vector (in array order) takes part. Only vectors of equal length meet. Scores
are 64-bit integers, exact while every sum stays below 2^53. Ties: above. Fewer
candidates than k: all of them. Further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import column, map_arrow, stage

SHARD_ROWS = 4096
BLOCK_ROWS = 512
LEAF_ROWS = 128


def quantized(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, floor(64 x) as doubles) of the rows that take part, by length."""
    col = batch.column(1)
    ids = np.array(batch.column(0).to_pylist(), np.int64)
    lengths = np.diff(col.offsets.to_numpy()) if col.null_count == 0 else None
    if lengths is not None and len(lengths) and col.values.null_count == 0 and (lengths == lengths[0]).all():
        x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), int(lengths[0]))
        groups = [(ids, x)]
    else:
        rows: dict[int, list] = {}
        for i, v in zip(ids.tolist(), col.to_pylist()):
            if v is not None and None not in v:
                rows.setdefault(len(v), []).append((i, v))
        groups = [
            (np.array([i for i, _ in g], np.int64), np.array([v for _, v in g], np.float64).reshape(len(g), d))
            for d, g in rows.items()
        ]
    out = []
    for i, x in groups:
        ok = np.isfinite(x).all(1)
        out.append((i[ok], np.floor(64 * x[ok])))
    return [(i, x) for i, x in out if len(i)]


class Tree:
    """A KD-tree over rows of integers held as floats."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.arange(len(ids))
        self.children: list[tuple[int, int] | None] = []
        self.spans: list[tuple[int, int]] = []
        lows, highs = [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            node = len(self.spans)
            part = x[order[lo:hi]]
            low, high = part.min(0), part.max(0)
            self.spans.append((lo, hi))
            self.children.append(None)
            lows.append(low)
            highs.append(high)
            if parent >= 0:
                a, b = self.children[parent] or (-1, -1)
                self.children[parent] = (node, b) if side == 0 else (a, node)
            if hi - lo > leaf and x.shape[1] and (high > low).any():
                mid = (hi - lo) // 2
                dim = int((high - low).argmax())
                order[lo:hi] = order[lo:hi][np.argpartition(part[:, dim], mid)]
                todo += [(lo, lo + mid, node, 0), (lo + mid, hi, node, 1)]
        self.ids, self.x = ids[order], np.ascontiguousarray(x[order])
        self.low, self.high = np.array(lows).T, np.array(highs).T

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The largest score that any point of each node's box can reach."""
        return np.maximum(q, 0) @ self.high + np.minimum(q, 0) @ self.low

    def leaf_order(self, bounds: np.ndarray, kth: float) -> list[int]:
        """Leaves in the order of a best-first traversal, while they reach kth."""
        heap, out = [(-bounds[0], 0)], []
        while heap:
            b, node = heapq.heappop(heap)
            if -b < kth:
                break
            kids = self.children[node]
            if kids is None:
                out.append(node)
                continue
            for c in kids:
                if bounds[c] >= kth:
                    heapq.heappush(heap, (-bounds[c], c))
        return out


class Best:
    """The k best (score, id) of each query so far, over a floor."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.kth = k, floor.astype(np.float64).copy()
        self.scores: list[np.ndarray] = [np.zeros(0)] * n
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * n

    def add(self, row: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[row], scores]), np.concatenate([self.ids[row], ids])
        if len(scores) > self.k:
            top = np.lexsort((ids, -scores))[: self.k]
            scores, ids = scores[top], ids[top]
        self.scores[row], self.ids[row] = scores, ids
        if len(scores) == self.k:
            self.kth[row] = max(self.kth[row], scores.min())


def search(tree: Tree, query_ids: np.ndarray, q: np.ndarray, best: Best) -> None:
    """Add the shard's candidates to ``best``. The j-th leaves of all queries
    are opened together, so each leaf is multiplied with a block of queries."""
    bounds = tree.bounds(q)
    plans = [tree.leaf_order(bounds[i], best.kth[i]) for i in range(len(q))]
    for step in range(max(map(len, plans), default=0)):
        by_leaf: dict[int, list[int]] = {}
        for i, plan in enumerate(plans):
            if step < len(plan) and bounds[i, plan[step]] >= best.kth[i]:
                by_leaf.setdefault(plan[step], []).append(i)
        for leaf, rows in by_leaf.items():
            lo, hi = tree.spans[leaf]
            scores, ids = q[rows] @ tree.x[lo:hi].T, tree.ids[lo:hi]
            near = (scores >= best.kth[rows][:, None]) & (ids[None, :] != query_ids[rows][:, None])
            for j in np.flatnonzero(near.any(1)).tolist():
                best.add(rows[j], scores[j][near[j]], ids[near[j]])


def _exact(*matrices: np.ndarray) -> list[np.ndarray]:
    """The matrices in single precision where every score is exact in it."""
    most = [np.abs(m).max(initial=0) for m in matrices]
    small = most[0] * most[-1] * max(1, matrices[0].shape[1]) < 2**24
    return [m.astype(np.float32) for m in matrices] if small else list(matrices)


def top_k(embeddings: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that satisfies the condition
    ``is_query`` on vec_id, its k highest scores among all other rows. Rows whose
    vector is null or holds null or non-finite components go first; of the rest,
    rows that share a vec_id count as one, the one with the smallest vector."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    spark = embeddings.sparkSession
    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = (
        embeddings.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite)
        .repartition(parts, "vec_id").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
        .withColumn("is_query", is_query)
    )

    def cut(batches):
        """Shards, then blocks of the task's queries with the bound that its
        first shard gives."""
        part, shards, asked, held = TaskContext.get().partitionId(), 0, [], {}
        first: dict[int, Tree] = {}

        def shard(d):
            nonlocal shards
            ids, x = (np.concatenate(v) for v in zip(*held.pop(d)))
            if d not in first:
                first[d] = Tree(ids, x)
            shards += 1
            return row("shard", shards, d, ids, x, np.zeros(0))

        def row(kind, n, d, ids, x, floor):
            return {
                "kind": [kind], "number": [part * 1_000_000 + n], "width": [d], "ids": [ids.astype("<i8").tobytes()],
                "x": [x.astype("<f8").tobytes()], "floor": [floor.astype("<f8").tobytes()],
            }

        for b in batches:
            marks = dict(zip(column(b, "vec_id"), column(b, "is_query")))
            for ids, x in quantized(b):
                d = x.shape[1]
                held.setdefault(d, []).append((ids, x))
                wanted = np.array([bool(marks[i]) for i in ids.tolist()])
                if wanted.any():
                    asked.append((d, ids[wanted], x[wanted]))
                if sum(len(i) for i, _ in held[d]) >= SHARD_ROWS:
                    yield shard(d)
        for d in list(held):
            yield shard(d)
        for d in first:
            ids = np.concatenate([i for w, i, _ in asked if w == d] or [np.zeros(0, np.int64)])
            x = np.concatenate([v for w, _, v in asked if w == d] or [np.zeros((0, d))])
            for lo in range(0, len(ids), BLOCK_ROWS):
                shards += 1
                block, qs = ids[lo : lo + BLOCK_ROWS], x[lo : lo + BLOCK_ROWS]
                best = Best(len(block), k, np.full(len(block), -np.inf))
                search(first[d], block, qs, best)
                yield row("block", shards, d, block, qs, best.kth)

    before = spark.conf.get(batch_rows)
    cells = stage(map_arrow(rows, ["vec_id", "embedding", "is_query"], "kind string, number long, width int, ids binary, x binary, floor binary", cut), "kd-shards")
    fields = ["number", "width", "ids", "x"]
    shards = cells.where("kind = 'shard'").select(*(F.col(c).alias(f"s_{c}") for c in fields)).repartition(parts)
    blocks = cells.where("kind = 'block'").select(*(F.col(c).alias(f"q_{c}") for c in [*fields, "floor"]))
    pairs = shards.crossJoin(blocks)

    def meet(batches):
        trees: dict[int, Tree] = {}
        floors: dict[int, np.ndarray] = {}
        for b in batches:
            for r in b.to_pylist():
                if r["s_width"] != r["q_width"]:
                    continue
                d = r["s_width"]
                if r["s_number"] not in trees:
                    trees.clear()
                    ids = np.frombuffer(r["s_ids"], "<i8")
                    trees[r["s_number"]] = Tree(ids, np.frombuffer(r["s_x"], "<f8").reshape(len(ids), d))
                tree = trees[r["s_number"]]
                ids = np.frombuffer(r["q_ids"], "<i8")
                q = np.frombuffer(r["q_x"], "<f8").reshape(len(ids), d)
                floor = floors.get(r["q_number"], np.frombuffer(r["q_floor"], "<f8"))
                best = Best(len(ids), k, floor)
                whole = tree.x
                q, tree.x = _exact(q, whole)
                search(tree, ids, q, best)
                tree.x = whole
                floors[r["q_number"]] = best.kth
                n = [len(s) for s in best.scores]
                yield {
                    "query_id": np.repeat(ids, n), "vec_id": np.concatenate([*best.ids, np.zeros(0, np.int64)]),
                    "score": np.concatenate([*best.scores, np.zeros(0)]).astype(np.int64),
                }

    spark.conf.set(batch_rows, "2")  # a row is a pair of blocks, MBs each
    try:
        found = stage(map_arrow(pairs, pairs.columns, "query_id long, vec_id long, score long", meet), "kd-found")
    finally:
        spark.conf.set(batch_rows, before)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
