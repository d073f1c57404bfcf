"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on the statistics of a whole
text. Expectation-maximisation over all documents estimates how each rule votes
on good and on bad documents, and a document is kept by its posterior
probability of being good instead of by passing every rule.

The statistics are one pass over the texts. The fit sees only the counts of the
distinct vote patterns, at most 3^7 rows however many documents there are, and
the posterior of each pattern goes back by a broadcast of that many rows.

Defined cases: a null or empty text has no words, fails the base rule and is
not kept. Repeated rows count once each. Null ids pass through. Further columns
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import column, map_arrow, texts

# The marks counted as symbols, and the separators of words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_bangs long, n_distinct long"


def repeat_words(ids: np.ndarray, window: int = 5) -> int:
    """Words that lie in a ``window``-word run found twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    ranks, width = ids, 1
    # Runs of equal content get equal ranks; widths double, then overlap.
    while width < window:
        step = min(width, window - width)
        pair = ranks[: len(ranks) - step] * (int(ranks.max()) + 1) + ranks[step:]
        kinds, ranks = np.unique(pair, return_inverse=True)
        width += step
        if len(kinds) == len(ranks):
            return 0
    twice = np.bincount(ranks)[ranks] > 1
    covered = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((covered.cumsum()[:-1] > 0).sum())


def text_stats(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_upper, n_bangs, n_distinct of one whole text."""
    words = text.encode().split()
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    lines, before, repeated = 0, set(), 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            if line in before:
                repeated += 1
            before.add(line)
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), repeated,
        repeat_words(ids), lines, int(raw[65:91].sum()), text.count("!"), len(seen),
    )


def document_stats(docs: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in STATS.split(", ")][1:]

    def run(batches):
        for b in batches:
            rows = np.array([text_stats(t) for t in texts(b)], np.int64).reshape(b.num_rows, len(names))
            yield {"doc_id": column(b, "doc_id"), **{n: rows[:, i] for i, n in enumerate(names)}}

    return map_arrow(docs, ["doc_id", "text"], STATS, run)


def votes() -> dict[str, Column]:
    """The rules, as columns over the statistics. A fault rule votes bad or
    abstains, the last two vote good or abstain."""
    c, n = F.col, F.col("n_words")

    def vote(condition: Column, value: int) -> Column:
        return F.when((n > 0) & condition, value).otherwise(0)

    return {
        "symbols": vote(c("n_symbols") > 0.2 * n, -1),
        "dup_lines": vote(c("n_dup_lines") > 0.3 * c("n_lines"), -1),
        "repeats": vote(c("n_repeat_words") > 0.15 * n, -1),
        "word_length": vote((c("word_chars") > 14 * n) | (c("word_chars") < 2 * n), -1),
        "shouting": vote((c("n_upper") > 0.3 * c("word_chars")) | (c("n_bangs") > 0.2 * n), -1),
        "few_symbols": vote((c("n_symbols") + c("n_bangs") <= 0.05 * n) & (c("n_upper") <= 0.15 * c("word_chars")), 1),
        "varied": vote((c("n_repeat_words") <= 0.05 * n) & (c("n_dup_lines") <= 0.1 * c("n_lines")), 1),
    }


def fit_em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, trust: float = 0.02) -> np.ndarray:
    """The posterior probability of good for each vote pattern (rows of -1, 0,
    1). Each rule has, in each class, a probability of each of its three
    outcomes. ``trust`` is the weight, as a share of the documents, of the prior
    that good documents draw good votes and few bad ones, and bad documents the
    other way about; it fixes which of the two classes means good."""
    if not len(counts):
        return np.zeros(0)
    total = counts.sum()
    posterior = 1 / (1 + np.exp(-2 * patterns.sum(1).astype(float)))
    voted = {v: patterns == v for v in (-1, 0, 1)}
    # Prior outcome shares (bad, abstain, good) of a rule by class.
    priors = {True: (0.02, 0.49, 0.49), False: (0.4, 0.5, 0.1)}
    for _ in range(rounds):
        weight = {True: counts * posterior, False: counts * (1 - posterior)}
        log_odds = np.full(len(counts), np.log((weight[True].sum() + 0.7 * trust * total) / (weight[False].sum() + 0.3 * trust * total)))
        for good, sign in ((True, 1), (False, -1)):
            size = weight[good].sum() + trust * total
            for v, prior in zip((-1, 0, 1), priors[good]):
                share = (voted[v].T @ weight[good] + prior * trust * total) / size
                log_odds += sign * (voted[v] * np.log(share)).sum(1)
        new = 1 / (1 + np.exp(-np.clip(log_odds, -40, 40)))
        moved = np.abs(new - posterior).max()
        posterior = new
        if moved < 1e-9:
            break
    return posterior


def judge(stats: DataFrame, keep_at: float = 0.5) -> DataFrame:
    """``stats`` with the votes, ``posterior``, ``base_failed`` and ``kept``.

    ``stats`` should be staged: it is read once to count patterns and once for
    the result."""
    rules = votes()
    names = [f"vote_{k}" for k in rules]
    voted = stats.withColumns({f"vote_{k}": v for k, v in rules.items()})
    found = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()
    found.sort(key=lambda r: tuple(r[:-1]))
    posterior = fit_em(
        np.array([r[:-1] for r in found], np.int64).reshape(len(found), len(names)), np.array([r.n for r in found], float)
    )
    table = stats.sparkSession.createDataFrame(
        [(*map(int, r[:-1]), float(p)) for r, p in zip(found, posterior)],
        ", ".join(f"{n} int" for n in names) + ", posterior double",
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        voted.join(F.broadcast(table), names, "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.coalesce(F.col("posterior"), F.lit(0.0)) >= keep_at))
    )
