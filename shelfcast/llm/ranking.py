"""Quality classifier: Bradley-Terry pairwise ranking.

A document's worth is linear in a few text statistics. All preference pairs (each
row labelled good beats each row labelled bad) are fitted by logistic loss on the
feature differences, and the cut between kept and rejected documents is a
quantile of the fitted rows' worth: the share of bad rows among all labels.

Every labelled row takes part. A pair's loss depends on its worths alone, so the
sum over all pairs does not need the pairs: each row is spread over the nodes of
a fine grid of worths (cubic interpolation, relative error below 1e-7), the rows
of a node are added up in one pass over the labelled rows, and the driver pairs
nodes. A Newton step is one such pass; what is added up has the size of the grid.

Defined cases: a null text counts as empty and is scored like any other; rows
with a null ``doc_id`` are scored too but never used for fitting; a repeated
row is scored once per row; a repeated label row is fitted once, and a document
labelled both ways stays on both sides. Without a label of each kind every
score is 0.5. Further columns of the inputs are ignored, whatever their names.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import column, map_arrow, stage, texts

#: Distance of the grid's nodes, in units of worth.
STEP = 1 / 16
RIDGE = 1e-2
#: Bins in which a pass counts the worths when the cut is looked for.
BINS = 1024
#: Labelled rows of one block, and tasks that add up what the others report.
BLOCK_ROWS, TOGETHER = 4096, 6
#: A score at or above this is predicted good.
CUT = 0.3

# The marks that the symbol feature counts.
SYMBOLS = b"#*$%&|<>"

FEATURES = (
    "symbols_per_word", "pipes_per_word", "bangs_per_word", "upper_share", "digit_share",
    "mark_share", "letters_per_word", "dup_line_share", "distinct_word_share",
    "top_word_share", "repeated_pair_share", "words_log", "line_end_share", "words_per_line",
)


def text_features(text: str) -> list[float]:
    """The statistics of one whole text, in the order of FEATURES."""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n = max(1, len(words))
    seen: dict[bytes, int] = {}
    ids = [seen.setdefault(w, len(seen)) for w in words]
    top = repeated = 0.0
    if ids:
        a = np.array(ids, np.int64)
        top = np.bincount(a).max() / n
        if n > 2:
            pairs = np.unique(a[:-1] * len(seen) + a[1:])
            repeated = 1 - len(pairs) / (n - 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    size = max(1, len(raw))
    symbols = sum(int(counts[c]) for c in SYMBOLS)
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    return [
        min(symbols / n, 4.0), min(counts[124] / n, 2.0), min(counts[33] / n, 4.0), upper / max(1, upper + lower),
        counts[48:58].sum() / size, marks / size, min((size - counts[32] - counts[10]) / n, 40.0),
        1 - len(set(lines)) / max(1, len(lines)), len(seen) / n, top, repeated, math.log1p(len(words)),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / max(1, len(lines)),
        min(len(words) / max(1, len(lines)), 200.0),
    ]


@dataclass(frozen=True)
class Ranker:
    """Worth = weights . (x - mean) / scale; score 0.3 lies at ``cut``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(x), 0.5)
        z = (self.worth(x) - self.cut) / self.spread + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _added(*parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and, for each, the sum of its rows, of parts of (keys, rows)."""
    keys, rows = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(rows[order], first) if len(first) else rows


def _moments(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By label: the number of rows, the sums of the features and of their squares."""
    return _added((y, np.hstack([np.ones((len(x), 1)), x, x * x])))


def _spread(x: np.ndarray, y: np.ndarray, ranker: Ranker) -> tuple[np.ndarray, np.ndarray]:
    """By 2 * node + label: the number of rows, and the sums of their features
    and of the products of two features, each row spread over four nodes."""
    z = np.clip((x - ranker.mean) / ranker.scale, -8, 8)
    at = z @ ranker.weights / STEP
    k = np.floor(at).astype(np.int64)
    u = (at - k)[:, None]
    i, j = np.triu_indices(z.shape[1])
    rows = np.hstack([np.ones((len(z), 1)), z, z[:, i] * z[:, j]])
    shares = -u * (u - 1) * (u - 2) / 6, (u + 1) * (u - 1) * (u - 2) / 2, -(u + 1) * u * (u - 2) / 2, (u + 1) * u * (u - 1) / 6
    return _added(*[_added((2 * (k + n) + y, rows * share)) for n, share in zip((-1, 0, 1, 2), shares)])


def _square(flat: np.ndarray, d: int) -> np.ndarray:
    out = np.zeros((d, d))
    out[np.triu_indices(d)] = flat
    return out + np.triu(out, 1).T


def _all_pairs(keys: np.ndarray, sums: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and second derivatives over all pairs of a good and a bad row."""
    d = len(w)
    good, bad = sums[keys % 2 == 1], sums[keys % 2 == 0]
    at_good, at_bad = keys[keys % 2 == 1] // 2 * STEP, keys[keys % 2 == 0] // 2 * STEP
    pairs = good[:, 0].sum() * bad[:, 0].sum()
    loss, grad, hess = 0.0, np.zeros(d), np.zeros((d, d))
    for lo in range(0, len(good), 256):
        g = good[lo : lo + 256]
        gap = at_good[lo : lo + 256, None] - at_bad
        q = 1 / (1 + np.exp(np.clip(gap, -500, 500)))
        loss += g[:, 0] @ np.logaddexp(0, -gap) @ bad[:, 0]
        grad += g[:, 0] @ q @ bad[:, 1 : d + 1] - (q @ bad[:, 0]) @ g[:, 1 : d + 1]
        curve = q * (1 - q)
        cross = g[:, 1 : d + 1].T @ curve @ bad[:, 1 : d + 1]
        hess += _square((curve @ bad[:, 0]) @ g[:, d + 1 :] + (g[:, 0] @ curve) @ bad[:, d + 1 :], d) - cross - cross.T
    return loss / pairs + RIDGE / 2 * (w @ w), grad / pairs + RIDGE * w, hess / pairs + RIDGE * np.eye(d)


def _bins(x: np.ndarray, y: np.ndarray, ranker: Ranker, lo: float, hi: float) -> tuple[np.ndarray, ...]:
    """Of the worths from ``lo`` to ``hi``, by bin: bad rows, good rows, the least and the largest."""
    worth = ranker.worth(x)
    inside = (worth >= lo) & (worth <= hi)
    worth, y = worth[inside], y[inside]
    cell = np.zeros(len(worth), np.int64)
    if hi > lo and math.isfinite(hi - lo):
        cell = np.minimum(((worth - lo) / (hi - lo) * BINS).astype(np.int64), BINS - 1)
    return _bins_added((cell, np.stack([y == 0, y == 1], 1).astype(np.int64), worth, worth))


def _bins_added(*parts: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    cell, count, least, most = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(cell, kind="stable")
    cell, count, least, most = cell[order], count[order], least[order], most[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    if not len(first):
        return cell, count, least, most
    return cell[first], np.add.reduceat(count, first), np.minimum.reduceat(least, first), np.maximum.reduceat(most, first)


def _cut(total: Callable, ranker: Ranker, weights: np.ndarray, bad_share: float) -> float:
    """The middle between the worth at which the rows' ``weights`` (of a bad and
    of a good one) reach ``bad_share`` and the next one in order, ties included."""
    lo, hi, before, after = -math.inf, math.inf, np.zeros(2), math.inf
    while lo < hi:
        _, count, least, most = total(partial(_bins, ranker=ranker, lo=lo, hi=hi), _bins_added)
        reached = (before + count.cumsum(axis=0)) @ weights
        k = min(int(np.searchsorted(reached, bad_share - 1e-12)), len(reached) - 1)
        before = before + count[:k].sum(axis=0)
        after = least[k + 1] if k + 1 < len(least) else after
        lo, hi, here = float(least[k]), float(most[k]), count[k]
    # The last of the rows with this worth (a good one, if any) may lie past the share already.
    last = weights[1] if here[1] else weights[0]
    again = here.sum() > 1 and (before + here) @ weights - last >= bad_share - 1e-12
    return lo if again or after == math.inf else (lo + after) / 2


def _fit(total: Callable, bad_share: float) -> Ranker:
    """``total(fn, add)`` adds up ``fn(x, y)`` over all blocks of rows."""
    found = total(_moments, _added)
    if found is None or len(found[0]) < 2:
        d = len(FEATURES) if found is None or not len(found[0]) else found[1].shape[1] // 2
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 1.0)
    rows, sums = found[1][:, 0], found[1].sum(axis=0)
    n, d = sums[0], len(sums) // 2
    mean = sums[1 : d + 1] / n
    scale = np.sqrt(np.maximum(sums[d + 1 :] / n - mean**2, 0)) + 1e-3
    w, step, last = np.zeros(d), np.zeros(d), math.inf
    for _ in range(60):  # Newton steps on the pairwise logistic loss with a ridge
        ranker = Ranker(mean, scale, w, 0.0, 1.0)
        keys, at = total(partial(_spread, ranker=ranker), _added)
        loss, grad, hess = _all_pairs(keys, at, w)
        if loss > last + 1e-9:
            step = step / 2
            w = w + step
            continue
        step, last = np.linalg.solve(hess, grad), loss
        if np.abs(step).max() < 1e-8:
            break
        w = w - step
    w, at = ranker.weights, at.sum(axis=0)
    variance = w @ _square(at[d + 1 :], d) @ w / n - (w @ at[1 : d + 1] / n) ** 2
    cut = _cut(total, ranker, np.array([bad_share, 1 - bad_share]) / rows, bad_share)
    return Ranker(mean, scale, w, cut, max(1e-6, math.sqrt(max(0.0, variance)) / 4))


def fit_ranker(x: np.ndarray, y: np.ndarray, bad_share: float) -> Ranker:
    """Fit from feature rows ``x`` with labels ``y`` (1 good, 0 bad).

    ``bad_share`` is the quantile of the cut, among rows weighted so that the
    bad ones make up that share."""
    return _fit(lambda fn, add: fn(x, y) if x.size else None, bad_share)


def fit_from_labels(docs: DataFrame, labels: DataFrame, fit_rows=None) -> Ranker:
    """Fit on all labelled rows that ``fit_rows`` (a column condition on doc_id)
    admits. Features are made where the texts are and meet the labels by a
    shuffle; the fit then reads the labelled rows in blocks."""
    rows = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").distinct()
    known = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    if fit_rows is not None:
        rows, known = rows.where(fit_rows), known.where(fit_rows)
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return fit_ranker(np.zeros((0, len(FEATURES))), np.zeros(0), 0.5)

    def features(batches):
        for b in batches:
            yield {"doc_id": column(b, "doc_id"), "x": [np.array(text_features(s), "<f8").tobytes() for s in texts(b)]}

    def blocks(batches):
        held = []
        for b in batches:
            held += zip(column(b, "y"), column(b, "x"))
            while len(held) >= BLOCK_ROWS:
                yield block(held[:BLOCK_ROWS])
                held = held[BLOCK_ROWS:]
        if held:
            yield block(held)

    def block(held):
        return {"y": [np.array([y for y, _ in held], "<i8").tobytes()], "x": [b"".join(x for _, x in held)]}

    found = map_arrow(known, ["doc_id", "text"], "doc_id long, x binary", features).join(rows, "doc_id")
    staged = stage(map_arrow(found, ["y", "x"], "y binary, x binary", blocks), "labelled-features")

    def total(fn, add):
        """Added up in the tasks, then by a few of them, then here."""
        def one(batches):
            out = None
            for b in batches:
                for y, x in zip(column(b, "y"), column(b, "x")):
                    part = fn(np.frombuffer(x, "<f8").reshape(-1, len(FEATURES)), np.frombuffer(y, "<i8"))
                    out = part if out is None else add(out, part)
            if out is not None:
                yield {"part": [pickle.dumps(out)]}

        def several(batches):
            out = None
            for b in batches:
                for part in map(pickle.loads, column(b, "part")):
                    out = part if out is None else add(out, part)
            if out is not None:
                yield {"part": [pickle.dumps(out)]}

        parts = map_arrow(staged, ["y", "x"], "part binary", one).repartition(TOGETHER)
        out = None
        for r in map_arrow(parts, ["part"], "part binary", several).collect():
            part = pickle.loads(r.part)
            out = part if out is None else add(out, part)
        return out

    return _fit(total, n[0] / (n[0] + n[1]))


def score_documents(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs``."""

    def scored(batches):
        for b in batches:
            t = texts(b)
            s = ranker.score(np.array([text_features(x) for x in t]).reshape(len(t), len(FEATURES)))
            yield {"doc_id": column(b, "doc_id"), "score": s, "predicted": (s >= CUT).astype(np.int32)}

    return map_arrow(docs, ["doc_id", "text"], "doc_id long, score double, predicted int", scored)


def keep_good(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns."""

    @F.pandas_udf("boolean")
    def good(text: pd.Series) -> pd.Series:
        x = np.array([text_features(t or "") for t in text]).reshape(len(text), len(FEATURES))
        return pd.Series(ranker.score(x) >= CUT)

    return docs.where(good("text"))
