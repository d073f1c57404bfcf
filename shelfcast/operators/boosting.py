"""Boosted regression trees over staged blocks of binned rows.

Feature values are binned once (at most ``BINS`` quantile bins a feature) and
written as blocks: one record of at most ``BLOCK_ROWS`` rows holds the bins as
bytes, the labels and a fold code. Rows are dealt to blocks at random, so a block
is a random part of the data of fixed size however much data there is.

A round is one pass over the blocks and one Spark job, whatever the depth. Each
tree's splits are searched in one block, a different one every round (stochastic
gradient boosting with a bounded sample), level by level from histograms; a
node's histogram is its parent's less its sibling's. Its leaf values come from all
training rows: every block reports gradient sums by leaf and the driver adds up
2^depth numbers for each model. While round t measures its leaves, the block
whose turn it is searches the tree of round t + 1.

Many models share the passes (``fit_many``): settings x folds differ in their
trees, not in their scans. Fold k trains on the rows with code <= k and is
tested on those with code k + 1, the layout of expanding-window folds.

Predictions and leaves stay beside the block, in a persisted RDD that is renewed
every few rounds and checkpointed to the shared folder every
``CHECKPOINT_ROUNDS``: a lost executor costs the rounds since then, for its
blocks only.

Missing feature values go right at every split. A leaf has value
rate * soft(G, l1) / (n + l2), with soft the shrinking of |G| by l1."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, stage

#: Part of the name of a saved model: changes when the same rows and settings give another one.
VERSION = 1
BINS = 64
#: Rows of a block at most, and what a block should have at least before one more is made.
BLOCK_ROWS, LEAST_ROWS = 65_536, 16_384
CHECKPOINT_ROUNDS = 50
#: Model rounds that are played again rather than stored.
REPLAYED = 8
#: A histogram cell is one integer: count * _COUNT + sum of gradients in steps of 2^-19 of the largest.
_COUNT, _STEPS = float(1 << 37), float(1 << 19)


@dataclass(frozen=True)
class Boosting:
    """Settings; the defaults are the original's."""

    rounds: int = 300
    depth: int = 8
    rate: float = 0.05
    row_sample: float = 0.8
    column_sample: float = 0.8
    l1: float = 0.1
    l2: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """A complete tree of ``depth`` levels in heap order. A node that is not
    split sends every row left."""

    feature: np.ndarray
    bin: np.ndarray
    split: np.ndarray
    value: np.ndarray | None = None


@dataclass
class BoostedTrees:
    """A fitted model: ``base`` plus the values of the leaves a row falls into."""

    params: Boosting
    base: float
    edges: list[np.ndarray]
    trees: list[Tree]
    #: After each round: RMSE on the training rows, on the fold's test rows.
    watch: list[tuple[float, float]] = field(default_factory=list)
    #: RMSLE of the clipped predictions on the fold's test rows, None without any.
    test_rmsle: float | None = None

    @property
    def n_trees(self) -> int:
        return len(self.trees)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions for a matrix of rows by features."""
        binned = bin_values(x, self.edges)
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t.value[leaves(t, binned, self.params.depth)]
        return out

    def transform(self, df: DataFrame, features: str = "features", name: str = "prediction") -> DataFrame:
        """``df`` with a column of predictions; rows stay where they are."""
        return add_predictions(df, [self], features, [name])

    def save(self, spark: SparkSession, path: str) -> str:
        """Trees as Parquet, a row each, and the settings as JSON (written last)."""
        nodes = [(i, t.feature.tolist(), t.bin.tolist(), t.split.tolist(), t.value.tolist()) for i, t in enumerate(self.trees)]
        spark.createDataFrame(nodes, TREE_ROWS).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        head = {"params": asdict(self.params), "base": self.base, "edges": [e.tolist() for e in self.edges], "watch": self.watch, "test_rmsle": self.test_rmsle}
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTrees":
        head = json.loads(spark.read.text(f"{path}/settings", wholetext=True).first().value)
        trees = [
            Tree(np.array(r.feature, np.int32), np.array(r.bin, np.uint8), np.array(r.split, bool), np.array(r.value))
            for r in spark.read.schema(TREE_ROWS).parquet(f"{path}/trees").orderBy("tree").collect()
        ]
        edges = [np.array(e, float) for e in head["edges"]]
        return cls(Boosting(**head["params"]), head["base"], edges, trees, [tuple(w) for w in head["watch"]], head["test_rmsle"])


#: How trees are stored: arrays in heap order, one row per tree.
TREE_ROWS = "tree int, feature array<int>, bin array<int>, split array<boolean>, value array<double>"


def add_predictions(df: DataFrame, models: list[BoostedTrees], features: str, names: list[str]) -> DataFrame:
    """Predictions of several models, in one pass over the rows."""
    sent = df.sparkSession.sparkContext.broadcast(models)
    kept = [c for c in df.columns if c != features]
    rows = df.select(*kept, _array(df, features).alias("_x"))
    schema = df.select(*kept).schema
    for name in names:
        schema = schema.add(name, "double")

    def run(batches):
        for b in batches:
            x = _matrix(b.column(b.num_columns - 1), b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *[pa.array(m.predict(x)) for m in sent.value]], names=[*b.schema.names[:-1], *names]
            )

    return rows.mapInArrow(run, schema)


# ------------------------------------------------------------ binned blocks

def _array(df: DataFrame, features: str) -> Column:
    plain = df.schema[features].dataType.typeName() == "array"
    return F.col(features) if plain else vector_to_array(features)


def _matrix(lists, n: int) -> np.ndarray:
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1)


def bin_edges(rows: DataFrame, n_features: int) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature (array column ``x``): its
    distinct quantiles, less the largest. One aggregate of bounded sketches."""
    probs = [k / BINS for k in range(1, BINS + 1)]
    row = rows.agg(*[F.percentile_approx(F.col("x")[i], probs, 1000).alias(f"q{i}") for i in range(n_features)]).first()
    return [np.unique(np.array(q, float))[:-1] if q else np.zeros(0) for q in row]


def bin_values(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bytes, features by rows. Missing values are in the last bin."""
    out = np.empty((len(edges), len(x)), np.uint8)
    for i, e in enumerate(edges):
        out[i] = np.where(np.isnan(x[:, i]), 255, np.searchsorted(e, x[:, i], side="left"))
    return out


@dataclass
class Blocks:
    """Binned rows on disk: (rows, binned, label, code), ordered by code inside a
    block, so the rows that a fold trains on, or is tested on, are a range."""

    table: DataFrame
    edges: list[np.ndarray]
    n_blocks: int


def make_blocks(df: DataFrame, features: str, label: str, code: str) -> Blocks:
    """Bin and deal the rows of ``df``; ``code`` is 0 or more for rows that some
    fold trains on or is tested on."""
    spark = df.sparkSession
    picked = df.select(_array(df, features).alias("x"), F.col(label).cast("double").alias("y"), F.col(code).cast("int").alias("c"))
    rows = stage(picked, "fit-rows")
    first = rows.select(F.size("x").alias("n")).first()
    if first is None:
        raise ValueError("no rows to fit")
    edges = bin_edges(rows.select("x"), first.n)
    n = rows.count()
    per_core = min(spark.sparkContext.defaultParallelism, -(-n // LEAST_ROWS))
    n_parts = max(per_core, -(-n // BLOCK_ROWS), 1)
    sent = spark.sparkContext.broadcast(edges)

    def run(batches):
        held, n_held = [], 0

        def block():
            x, y, c = (np.concatenate(p) for p in zip(*held))
            order = np.argsort(c, kind="stable")
            x, y, c = x[order], y[order], c[order]
            # Parts of the deal may be uneven by a few rows: cut to the bound.
            n_cuts = -(-len(y) // BLOCK_ROWS)
            for k in range(n_cuts):
                at = slice(k, None, n_cuts)
                yield pa.RecordBatch.from_pydict({
                    "rows": pa.array([len(y[at])], pa.int32()), "binned": [bin_values(x[at], sent.value).tobytes()],
                    "label": [y[at].tobytes()], "code": [c[at].tobytes()],
                })

        for b in batches:
            if b.num_rows:
                held.append((_matrix(b.column(0), b.num_rows), b.column(1).to_numpy(zero_copy_only=False).astype(np.float64),
                             b.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)))
                n_held += b.num_rows
            if n_held >= BLOCK_ROWS:
                yield from block()
                held, n_held = [], 0
        if held:
            yield from block()

    table = stage(rows.repartition(n_parts).mapInArrow(run, "rows int, binned binary, label binary, code binary"), "blocks")
    return Blocks(table, edges, table.count())


# ------------------------------------------------------------ one tree

def leaves(tree: Tree, binned: np.ndarray, depth: int, n: int | None = None) -> np.ndarray:
    """Leaf 0 .. 2^depth - 1 of each of the first ``n`` rows (columns of ``binned``)."""
    n = binned.shape[1] if n is None else n
    flat, rows = binned.ravel(), np.arange(n)
    node = np.zeros(n, np.int64)
    start = tree.feature.astype(np.int64) * binned.shape[1]
    for _ in range(depth):
        right = (flat[start[node] + rows] > tree.bin[node]) & tree.split[node]
        node = 2 * node + 1 + right
    return node - ((1 << depth) - 1)


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_values(g: np.ndarray, n: np.ndarray, p: Boosting) -> np.ndarray:
    return p.rate * _soft(g, p.l1) / (n + p.l2)


def grow(binned: np.ndarray, gradient: np.ndarray, widths: np.ndarray, p: Boosting, rng: np.random.Generator) -> Tree:
    """Search the splits of one tree in the first rows of one block, those that
    have a gradient: ``binned`` features by rows, ``widths`` the bins of each."""
    n_features, n_nodes = len(widths), (1 << p.depth) - 1
    tree = Tree(np.zeros(n_nodes, np.int32), np.zeros(n_nodes, np.uint8), np.zeros(n_nodes, bool))
    rows = np.flatnonzero(rng.random(len(gradient)) < p.row_sample)
    used = np.sort(rng.permutation(n_features)[: max(1, round(p.column_sample * n_features))])
    if len(rows) < 2:
        return tree
    # Cells of a node: the bins of each used feature, one feature after the other.
    starts = np.concatenate([[0], np.cumsum(widths[used])])
    cells = int(starts[-1])
    at = np.minimum(binned[used][:, rows], (widths[used] - 1)[:, None].astype(np.uint8))
    top = np.abs(gradient[rows]).max()
    if top == 0:
        return tree
    scale = top / _STEPS
    weight = np.round(gradient[rows] / scale) + _COUNT
    feature_of = np.repeat(np.arange(len(used)), widths[used])
    last_bin = np.zeros(cells, bool)
    last_bin[starts[1:] - 1] = True
    before = starts[:-1][feature_of]

    def histogram(picked, slot, n_slots):
        out, mine, w = np.empty((n_slots, cells)), slot[picked], weight[picked]
        base = {width: mine * width for width in set(widths[used].tolist())}
        for f, width in enumerate(widths[used].tolist()):
            index = base[width] + at[f][picked]
            out[:, starts[f] : starts[f + 1]] = np.bincount(index, w, n_slots * width).reshape(n_slots, width)
        return out

    node = np.zeros(len(rows), np.int64)
    packed = histogram(np.arange(len(rows)), node, 1)
    for level in range(p.depth):
        first, n_here = (1 << level) - 1, 1 << level
        count = np.round(packed / _COUNT)
        grad = (packed - count * _COUNT) * scale
        total_n, total_g = count[:, : starts[1]].sum(axis=1), grad[:, : starts[1]].sum(axis=1)
        run_n, run_g = np.cumsum(count, axis=1), np.cumsum(grad, axis=1)
        head = before > 0
        left_n, left_g = run_n - np.where(head, run_n[:, before - 1], 0.0), run_g - np.where(head, run_g[:, before - 1], 0.0)
        right_n, right_g = total_n[:, None] - left_n, total_g[:, None] - left_g
        gain = _soft(left_g, p.l1) ** 2 / (left_n + p.l2) + _soft(right_g, p.l1) ** 2 / (right_n + p.l2)
        gain -= (_soft(total_g, p.l1) ** 2 / (total_n + p.l2))[:, None]
        gain[(left_n < 1) | (right_n < 1) | last_bin] = 0.0
        best = np.argmax(gain, axis=1)
        found = gain[np.arange(n_here), best] > 1e-9 * top * top
        here = slice(first, first + n_here)
        tree.feature[here] = used[feature_of[best]]
        tree.bin[here] = best - before[best]
        tree.split[here] = found
        if level + 1 == p.depth or not found.any():
            break
        cut = feature_of[best]
        right = (at[cut[node], np.arange(len(rows))] > (best - before[best])[node]) & found[node]
        node = 2 * node + right
        sizes = np.bincount(node, minlength=2 * n_here).reshape(n_here, 2)
        small = np.argmin(sizes, axis=1)
        in_small = np.flatnonzero(((node & 1) == small[node >> 1]) & found[node >> 1])
        part = histogram(in_small, node >> 1, n_here)
        packed_next = np.empty((n_here, 2, cells))
        packed_next[np.arange(n_here), small] = part
        packed_next[np.arange(n_here), 1 - small] = packed - part
        packed = packed_next.reshape(2 * n_here, cells)
    return tree


# ------------------------------------------------------------ rounds

@dataclass
class _Plan:
    """What the blocks are told of one model in one round."""

    params: Boosting
    limit: int
    values: np.ndarray | None
    tree: Tree | None
    searcher: int
    round: int
    last: bool


def _advance(state: dict, plans: list[_Plan], binned: np.ndarray) -> dict:
    """Add the last trees' values to the predictions and find the new trees' leaves."""
    preds, places = [], []
    for plan, pred, place in zip(plans, state["preds"], state["leaves"]):
        preds.append(pred if plan.values is None else (pred + plan.values[place]).astype(np.float32))
        places.append(None if plan.tree is None else leaves(plan.tree, binned, plan.params.depth, len(pred)).astype(np.uint16))
    return {**state, "preds": preds, "leaves": places}


def _round(state: dict, plans: list[_Plan], widths: np.ndarray) -> list[dict]:
    """What a block reports of a round: errors so far, gradient sums of the new
    trees' leaves, and the next trees where it is this block's turn to search."""
    binned = np.frombuffer(state["binned"], np.uint8).reshape(len(widths), -1)
    label = np.frombuffer(state["label"])
    state, report = _advance(state, plans, binned), []
    for plan, pred, place, n_train in zip(plans, state["preds"], state["leaves"], state["train"]):
        p, truth = plan.params, label[: len(pred)]
        residual, error = (truth - pred)[:n_train], (truth - pred)[n_train:]
        said = {"watch": (residual @ residual, n_train, error @ error, len(error))}
        if plan.last and len(error):
            gap = np.log1p(truth[n_train:]) - np.log1p(np.maximum(pred[n_train:], 0.0))
            said["log"] = gap @ gap
        if place is not None:
            n_leaves, place = 1 << p.depth, place[:n_train]
            said |= {"g": np.bincount(place, residual, n_leaves), "n": np.bincount(place, minlength=n_leaves)}
        if plan.searcher == state["block"]:
            if place is not None:
                # What the tree will add, as far as this block knows.
                residual = residual - leaf_values(said["g"], said["n"], p)[place]
            said["next"] = grow(binned, residual, widths, p, np.random.default_rng([p.seed, len(report), plan.round]))
        report.append(said)
    return report


def fit_many(blocks: Blocks, settings: list[tuple[Boosting, int]]) -> list[BoostedTrees]:
    """Fit a model for each (settings, fold): one pass over the blocks a round."""
    spark = blocks.table.sparkSession
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(ensure_checkpoint_dir(spark))
    widths = np.array([min(256, len(e) + 2) for e in blocks.edges])
    limits = [limit for _, limit in settings]

    def read(index, rows):
        for k, r in enumerate(rows):
            yield index, k, {"rows": r.rows, "binned": bytes(r.binned), "label": bytes(r.label), "code": bytes(r.code)}

    def sums(part):
        for _, _, s in part:
            y, c = np.frombuffer(s["label"]), np.frombuffer(s["code"], np.uint8)
            yield [(float(y[c <= k].sum()), int((c <= k).sum())) for k in limits]

    parts = min(blocks.n_blocks, max(sc.defaultParallelism, 1) if blocks.n_blocks < 4 * sc.defaultParallelism else blocks.n_blocks)
    held = blocks.table.repartition(parts).rdd.mapPartitionsWithIndex(read).persist(StorageLevel.MEMORY_AND_DISK)
    names = held.map(lambda r: r[:2]).collect()
    number = {name: i for i, name in enumerate(sorted(names))}
    totals = np.array(held.mapPartitions(sums).collect())  # blocks x models x (sum, rows)
    sums_of, rows_of = totals[:, :, 0].sum(axis=0), totals[:, :, 1].sum(axis=0)
    if not rows_of.all():
        raise ValueError("a fold without training rows")
    models = [BoostedTrees(p, float(s / n), blocks.edges, []) for (p, _), s, n in zip(settings, sums_of, rows_of)]
    bases = [m.base for m in models]
    # Only blocks with training rows of a fold are worth searching in.
    with_rows = [[number[name] for name, of_block in zip(names, totals) if of_block[m, 1] > 1] or [0] for m in range(len(models))]
    with_rows = [sorted(w) for w in with_rows]

    def start(part):
        for i, place, s in part:
            code = np.frombuffer(s.pop("code"), np.uint8)
            train, seen = (np.searchsorted(code, np.array(limits) + k, "right").tolist() for k in (0, 1))
            preds = [np.full(n, b, np.float32) for n, b in zip(seen, bases)]
            yield {**s, "block": number[(i, place)], "train": train, "preds": preds, "leaves": [None] * len(bases)}

    def replayed(s: dict, rounds: list[list[_Plan]]) -> dict:
        for plans in rounds:
            s = _advance(s, plans, np.frombuffer(s["binned"], np.uint8).reshape(len(widths), -1))
        return s

    state = held.mapPartitions(start).persist(StorageLevel.MEMORY_AND_DISK)
    waiting: list[Tree | None] = [None] * len(models)
    values: list[np.ndarray | None] = [None] * len(models)
    last = max(p.rounds for p, _ in settings)
    # The state is renewed every few rounds; the rounds since are played again,
    # which for few models costs less than handing the state over each time.
    kept_for, since, old = max(2, REPLAYED // len(models)), [], []
    for t in range(last + 2):
        if len(since) == kept_for:

            def renew(part, rounds=tuple(since)):
                for s in part:
                    yield replayed(s, rounds)

            old.append(state)
            state = state.mapPartitions(renew).persist(StorageLevel.MEMORY_AND_DISK)
            if t // CHECKPOINT_ROUNDS > (t - kept_for) // CHECKPOINT_ROUNDS:
                state.checkpoint()
            since = []
        plans = []
        for m, (p, limit) in enumerate(settings):
            turn = with_rows[m][(t + m) % len(with_rows[m])] if t < p.rounds else -1
            plans.append(_Plan(p, limit, values[m], waiting[m], turn, t, t == p.rounds + 1))

        def step(part, rounds=tuple(since), plans=plans):
            for s in part:
                yield _round(replayed(s, rounds), plans, widths)

        reports = state.mapPartitions(step).collect()
        since.append(plans)
        while old:
            old.pop().unpersist()
        for m, model in enumerate(models):
            mine = [r[m] for r in reports]
            tested = sum(r["watch"][3] for r in mine)
            if 1 < t <= settings[m][0].rounds + 1:
                a, n, b, k = np.sum([r["watch"] for r in mine], axis=0)
                model.watch.append((float(np.sqrt(a / n)), float(np.sqrt(b / k)) if k else float("nan")))
            if plans[m].last and tested:
                model.test_rmsle = float(np.sqrt(sum(r.get("log", 0.0) for r in mine) / tested))
            values[m] = None
            if waiting[m] is not None:
                g, n = np.sum([r["g"] for r in mine], axis=0), np.sum([r["n"] for r in mine], axis=0)
                tree = waiting[m]
                tree.value = values[m] = leaf_values(g, n, model.params)
                model.trees.append(tree)
            waiting[m] = next((r["next"] for r in mine if "next" in r), None)
    state.unpersist()
    held.unpersist()
    return models


def fit(df: DataFrame, params: Boosting, features: str = "features", label: str = "label", held_out: str = "is_val") -> BoostedTrees:
    """One model on the rows where ``held_out`` is false; the others are watched."""
    blocks = make_blocks(df.withColumn("_code", F.col(held_out).cast("int")), features, label, "_code")
    return fit_many(blocks, [(params, 0)])[0]
