"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of two learned inputs side by side: an embedding of the
word (by hash) and the mean embedding of its five-byte windows. Windows of
``WINDOW`` words, each overlapping the next, run through a gated recurrent unit
in both directions; attention weighs the states, and the pooled state gives the
window's logit. A document's score is its highest window's, put on a probability
scale by a logistic fit on the fitted documents. Every window of every text is
scored.

Only a document is labelled, not the place, so after two rounds in which every
window carries its document's label, a toxic document teaches by its highest
window alone and the others by their highest and a few at random. Windows of one
harmless word repeated are added, as no sign of either label.

Training is numpy on the driver over a bounded sample; scoring is numpy in the
tasks. Input projections are computed once for each distinct word of a block.

Defined cases: a null or empty text, or one of blanks only, scores 0. Null ids
pass through; null labels and null ids are not used for fitting. A repeated row
is scored once per row; a label row that repeats is used once; a document with
both labels counts as both. Without labels of both kinds every score is 0.5.
Further columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import column, map_arrow, texts
from .tokens import blocks

#: The fit reads at most this many labelled documents of each label, chosen by a
#: hash of doc_id, with whole texts, and trains on at most this many windows of
#: each in a round.
FIT_ROWS_PER_LABEL = 1500
FIT_WINDOWS = 8
WINDOW, STRIDE = 24, 16
CUT = 0.7
#: A word in fewer of the fitted documents has no embedding of its own, only its
#: characters': it would mark the document, not the label. Embeddings shrink by
#: this share in each step.
LEAST_DOCUMENTS, DECAY = 4, 0.002
WORDS, GRAMS, WIDE, HIDDEN = 1 << 16, 1 << 14, 8, 12
_EDGE = b" .,;:!?\"'()[]{}<>*#%&$|-_/"


def word_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word without its outer marks, the buckets of the 5-byte
    windows of all of them (a word begins and ends with a mark of its own), and
    where each word's windows begin."""
    bare = [w.strip(_EDGE) for w in words]
    ids = np.array([zlib.crc32(w) for w in bare], np.int64) % WORDS
    # Each word takes its own length + 1 places; the windows of its last four
    # bytes run into the marks between the words.
    raw = np.frombuffer(b"".join(b"\x02" + w + b"\x03\x03\x03\x03" for w in bare), np.uint8).astype(np.uint32)
    if not len(raw):
        return ids, np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(w) + 5 for w in bare])
    starts = sizes.cumsum() - sizes
    take = np.ones(len(raw), bool)
    for k in range(1, 5):
        take[starts + sizes - k] = False
    at = np.flatnonzero(take)
    g = raw[at] * np.uint32(0x01000193)
    for k in range(1, 5):
        g = (g ^ raw[at + k]) * np.uint32(0x01000193)
    g ^= g >> np.uint32(15)
    own = sizes - 4
    return ids, (g % np.uint32(GRAMS)).astype(np.int64), own.cumsum() - own


def windows(n: int) -> list[tuple[int, int]]:
    """Starts and lengths of the overlapping windows of a text of n words."""
    return [(s, min(WINDOW, n - s)) for s in range(0, max(1, n - WINDOW + STRIDE), STRIDE)] if n else []


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Net:
    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    blank: bool = False

    @staticmethod
    def start(seed: int = 5) -> "Net":
        rng = np.random.default_rng(seed)
        h, d = HIDDEN, 2 * WIDE
        p = {"words": rng.normal(0, 0.1, (WORDS, WIDE)), "grams": rng.normal(0, 0.1, (GRAMS, WIDE))}
        for k in "fb":
            p |= {f"W{k}": rng.normal(0, 0.4, (d, 3 * h)), f"U{k}": rng.normal(0, 0.3, (h, 3 * h)), f"c{k}": np.zeros(3 * h)}
        p |= {"att": rng.normal(0, 0.3, 2 * h), "out": rng.normal(0, 0.3, 2 * h), "bias": np.zeros(1)}
        return Net({k: v.astype(np.float32) for k, v in p.items()})

    def inputs(self, words: list[bytes]):
        ids, grams, at = word_inputs(words)
        sizes = np.diff(np.append(at, len(grams)))[:, None]
        chars = np.add.reduceat(self.p["grams"][grams], at) / sizes if len(grams) else np.zeros((len(ids), WIDE))
        return np.concatenate([self.p["words"][ids], chars], 1).astype(np.float32), ids, grams, at, sizes

    def _direction(self, k: str, proj: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool):
        """States (steps, rows, hidden) and, if asked, what the gradient needs."""
        u, h, n = self.p[f"U{k}"], HIDDEN, len(index)
        state, out, trace = np.zeros((n, h), np.float32), [None] * WINDOW, []
        whole = mask.all(0)
        for t in range(WINDOW) if k == "f" else range(WINDOW - 1, -1, -1):
            x = proj[index[:, t]]
            a = state @ u
            gates = 1 / (1 + np.exp(-(x[:, : 2 * h] + a[:, : 2 * h])))
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * a[:, 2 * h :])
            nxt = new + z * (state - new)
            if not whole[t]:
                nxt = np.where(mask[:, t, None], nxt, state)
            if keep:
                trace.append((t, state, a, z, r, new))
            state = out[t] = nxt
        return np.stack(out), trace

    def forward(self, x: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Window logits. ``x`` has the input of each distinct word, ``index``
        the words of each window, ``mask`` which of them there are."""
        both = [self._direction(k, x @ self.p[f"W{k}"] + self.p[f"c{k}"], index, mask, keep) for k in "fb"]
        states = np.concatenate([b[0] for b in both], 2)
        e = np.where(mask.T, states @ self.p["att"], -1e9)
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = (w[:, :, None] * states).sum(0)
        return pooled @ self.p["out"] + self.p["bias"][0], (both, states, w, pooled)

    def gradient(self, x, index, mask, logit, held, target, weight):
        both, states, w, pooled = held
        h = HIDDEN
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d = ((_sigmoid(logit) - target) * weight).astype(np.float32)
        g["out"], g["bias"][0] = pooled.T @ d, d.sum()
        dp = d[:, None] * self.p["out"]
        dw = (states * dp).sum(2)
        de = w * (dw - (w * dw).sum(0))
        ds = w[:, :, None] * dp + de[:, :, None] * self.p["att"]
        g["att"] = (states * de[:, :, None]).sum((0, 1))
        dx = np.zeros_like(x)
        for i, k in enumerate("fb"):
            u, dstate, dproj = self.p[f"U{k}"], np.zeros((len(index), h), np.float32), np.zeros((len(x), 3 * h), np.float32)
            for t, prev, a, z, r, new in reversed(both[i][1]):
                dh = ds[t][:, i * h : (i + 1) * h] + dstate
                m = mask[:, t, None]
                dn_h = np.where(m, dh, 0)
                dnew = dn_h * (1 - z) * (1 - new * new)
                dz = dn_h * (prev - new) * z * (1 - z)
                dr = dnew * a[:, 2 * h :] * r * (1 - r)
                da = np.concatenate([dz, dr, dnew * r], 1)
                g[f"U{k}"] += prev.T @ da
                dstate = np.where(m, dn_h * z, dh) + da @ u.T
                np.add.at(dproj, index[:, t], np.concatenate([dz, dr, dnew], 1))
            g[f"W{k}"], g[f"c{k}"] = x.T @ dproj, dproj.sum(0)
            dx += dproj @ self.p[f"W{k}"].T
        return g, dx

    # -- texts -----------------------------------------------------------------

    def logits(self, split: list[list[bytes]]) -> list[np.ndarray]:
        """Logits of all windows of each text."""
        x, index, mask, counts = _laid_out(self, split)
        out = np.zeros(len(index), np.float32)
        for lo in range(0, len(index), 4096):
            out[lo : lo + 4096] = self.forward(x, index[lo : lo + 4096], mask[lo : lo + 4096])[0]
        return np.split(out, np.cumsum(counts)[:-1]) if counts else []

    def scores(self, batch: list[str]) -> list[float]:
        out = []
        for block in blocks(batch, 1_000_000):
            split = [t.encode().lower().split() for t in block]
            if self.blank:
                out += [0.5] * len(split)
                continue
            out += [
                float(_sigmoid(self.slope * float(l.max()) + self.shift)) if len(l) else 0.0 for l in self.logits(split)
            ]
        return out


def _laid_out(net: Net, split: list[list[bytes]]):
    """Inputs of the distinct words, and all windows as rows of word numbers;
    the last number stands for no word."""
    seen: dict[bytes, int] = {}
    flat = np.array([seen.setdefault(w, len(seen)) for s in split for w in s], np.int64)
    x = net.inputs(list(seen))[0] if seen else np.zeros((0, 2 * WIDE), np.float32)
    x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
    starts, sizes, counts, at = [], [], [], 0
    for s in split:
        w = windows(len(s))
        counts.append(len(w))
        starts += [at + a for a, _ in w]
        sizes += [n for _, n in w]
        at += len(s)
    step = np.arange(WINDOW)
    mask = step < np.array(sizes, np.int64).reshape(-1, 1)
    index = np.append(flat, 0)[np.minimum(np.array(starts, np.int64).reshape(-1, 1) + step, len(flat))]
    return x, np.where(mask, index, len(seen)), mask, counts


def train(docs: list[str], labels: np.ndarray, rounds: int = 7, seed: int = 5) -> Net:
    """Fit the network on whole texts with a label each."""
    net, rng = Net.start(seed), np.random.default_rng(seed)
    y = np.asarray(labels, float)
    if not (y == 1).any() or not (y == 0).any():
        net.blank = True
        return net
    split = [t.encode().lower().split() for t in docs]
    # Words start out with their log odds between the labels in one dimension.
    odds = np.zeros((2, WORDS))
    for s, label in zip(split, y):
        if s:
            odds[int(label), np.unique(word_inputs(sorted(set(s)))[0])] += 1
    base = odds.sum(0) * (y == 1).mean()
    known = odds.sum(0) >= LEAST_DOCUMENTS
    net.p["words"][:, 0] = np.clip(np.log((odds[1] + 2) / (base + 2)), -1, 3)
    net.p["words"][~known] = 0
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step = 0
    for r in range(rounds):
        if r >= 2 and r % 2 == 0:
            ranked = net.logits(split)
        rows = []
        for i, s in enumerate(split):
            w = windows(len(s))
            if not w:
                continue
            if r < 2:
                pick = rng.permutation(len(w))[:FIT_WINDOWS]
            elif y[i]:
                pick = [int(ranked[i].argmax())]
            else:
                pick = {int(ranked[i].argmax()), *rng.integers(0, len(w), 2).tolist()}
            rows += [(i, *w[int(k)]) for k in pick]
        # A word said over and over is no sign of either: a tenth more rows
        # are one word of a harmless document, filling a window.
        clean = [i for i, _, _ in rows if not y[i]]
        rows += [(i, int(rng.integers(len(split[i]))), 0) for i in rng.choice(clean, len(rows) // 10)]
        y_rows = np.array([y[i] for i, _, _ in rows])
        ones = max(1.0, y_rows.sum())
        weights = np.where(y_rows == 1, len(rows) / (2 * ones), len(rows) / (2 * max(1.0, len(rows) - ones)))
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), 256):
            part = order[lo : lo + 256]
            words: dict[bytes, int] = {}
            index = np.zeros((len(part), WINDOW), np.int64)
            mask = np.zeros((len(part), WINDOW), bool)
            for j, k in enumerate(part):
                i, s, n = rows[k]
                window = split[i][s : s + n] or split[i][s : s + 1] * WINDOW
                index[j, : len(window)] = [words.setdefault(w, len(words)) for w in window]
                mask[j, : len(window)] = True
            index[~mask] = len(words)
            x, ids, grams, at, sizes = net.inputs(list(words))
            x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
            logit, held = net.forward(x, index, mask, keep=True)
            g, dx = net.gradient(x, index, mask, logit, held, y_rows[part], weights[part] / len(part))
            np.add.at(g["words"], ids, dx[:-1, :WIDE])
            g["words"][~known] = 0
            np.add.at(g["grams"], grams, np.repeat(dx[:-1, WIDE:] / sizes, sizes[:, 0], axis=0))
            step += 1
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for name, v in g.items():  # Adam, with the gradient's norm held to 1
                v = v / max(1.0, norm)
                if name in ("words", "grams"):
                    net.p[name] *= 1 - DECAY
                a, b = moment[name]
                a += 0.1 * (v - a)
                b += 0.001 * (v * v - b)
                net.p[name] -= (0.01 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    top = [(float(l.max()), label) for l, label in zip(net.logits(split), y) if len(l)]
    net.slope, net.shift = _logistic(np.array([t for t, _ in top]), np.array([v for _, v in top]))
    return net


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a one-input logistic fit with a slight ridge."""
    a, w = np.stack([x, np.ones_like(x)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(a @ w)
        grad = a.T @ (p - y) / len(y) + 1e-3 * (w - [1.0, 0.0])
        hess = (a * (p * (1 - p))[:, None]).T @ a / len(y) + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(hess, grad)
    return float(max(w[0], 1e-3)), float(w[1])


def fit_from_labels(docs: DataFrame, labels: DataFrame, fit_rows=None, per_label: int = FIT_ROWS_PER_LABEL) -> Net:
    """Train on a bounded sample of the labelled rows that ``fit_rows`` (a column
    condition on doc_id) admits; the at most ``2 * per_label`` chosen ids are
    broadcast to one scan of the texts."""
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").distinct()
    if fit_rows is not None:
        rows = rows.where(fit_rows)
    chosen = None
    for y in (0, 1):
        part = rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        chosen = part if chosen is None else chosen.unionAll(part)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").collect()
    found.sort(key=lambda r: (r.doc_id, r.y, r.text or ""))
    return train([r.text or "" for r in found], np.array([r.y for r in found]))


def score_documents(docs: DataFrame, net: Net) -> DataFrame:
    """doc_id, score, predicted of every row."""
    spread = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for b in batches:
            s = np.array(spread.value.scores(texts(b)))
            yield {"doc_id": column(b, "doc_id"), "score": s, "predicted": (s >= CUT).astype(np.int32)}

    return map_arrow(docs, ["doc_id", "text"], "doc_id long, score double, predicted int", run)
