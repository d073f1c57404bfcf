"""How five filters interact, in every order, from truth-table survival words.

A document fails some of the filters A to E. Bit S of its survival word is set
if it survives the subset S of filters (bit i of S stands for the i-th letter),
that is, if it fails none of them: 32 subsets, one 32-bit word. The positional
popcount of the words of a part, for all documents, the good and the toxic
ones, says how many survive each subset, and from those 32 numbers follow kept,
removed and redundant documents of all 120 orders and the Shapley sums.

The popcounts are taken by carry-save adders: three words become a sum word and
a carry word of twice the weight, until two words or fewer of each weight are
left (:func:`positional_popcount`). A task adds up its own parts and sends 32
numbers for each; nothing is gathered by document. Filter E (the same text under
a smaller id) is answered by grouping digests; rows of very large groups do not
move for it (``join_groups``).

Nulls and odd input: a null text is empty, and empty texts are equal texts. A
null part is the empty string. A null id is not smaller than any id, and has no
label. Rows that share an id count each; those of equal text do not make each
other fail E. A document is good (toxic) if any label row of its id says 1. An
empty table gives no rows. Columns of other names are never looked at.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import permutations
from math import factorial

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import Workspace, map_arrow
from .joins import join_groups

LETTERS = "ABCDE"
SUBSETS = 1 << len(LETTERS)
#: Bit S of WORDS[mask]: a document that fails exactly ``mask`` survives S.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & mask) for mask in range(SUBSETS)], np.uint32)

CONTINUATION = bytes(range(0x80, 0xC0))
CAPITALS = bytes(range(0x41, 0x5B))
SYMBOLS = b"#$%&*|"

#: Words that a task holds before it adds them up, and parts before it sends them.
HELD_WORDS, HELD_PARTS = 1_000_000, 10_000


def failed_filters(text: bytes) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails."""
    words = text.split()
    distinct = len(set(words))
    code_points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return (
        (len(words) < 200)
        | (100 * distinct < 50 * len(words)) << 1
        | (100 * capitals > 2 * code_points) << 2
        | (symbols > 0) << 3
    )


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have bit 0, 1, .. 31 set."""
    counts, shifts = np.zeros(32, np.int64), np.arange(32, dtype=np.uint32)
    level, weight = np.asarray(words, np.uint32), 0
    while len(level):
        carries = []
        while len(level) > 2:
            n = len(level) // 3
            a, b, c = level[:n], level[n : 2 * n], level[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * n :]])
        counts += ((level[:, None] >> shifts) & 1).sum(axis=0, dtype=np.int64) << weight
        level = np.concatenate(carries) if carries else level[:0]
        weight += 1
    return counts


def _texts_read(batches):
    for b in batches:
        ids, parts, raw = (b.column(i) for i in range(3))
        found = [(failed_filters(t), sha256(t).digest()) for t in raw.to_pylist()]
        yield {"doc_id": ids, "part": parts, "fails": [f for f, _ in found], "digest": [d for _, d in found]}


def failure_masks(docs: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, part and the bits of all five filters that each row fails."""
    read = work.stage(
        map_arrow(
            docs,
            [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
             F.coalesce("text", F.lit("")).cast("binary").alias("raw")],
            "doc_id long, part string, fails int, digest binary",
            _texts_read,
        ),
        "fails",
    )
    groups = work.stage(
        read.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).where("n > 1"), "equal-texts"
    )
    alone_or_not = join_groups(read, groups, "digest", "n", read.count(), "left")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return alone_or_not.select("doc_id", "part", (F.col("fails") + F.shiftleft(later, 4)).alias("fails"))


def with_labels(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``masks`` with the booleans good and toxic; rows without an id stay put."""
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    false = F.lit(False)
    named = masks.where("doc_id IS NOT NULL").join(said, "doc_id", "left")
    named = named.withColumns({"good": F.coalesce("good", false), "toxic": F.coalesce("toxic", false)})
    return named.unionByName(masks.where("doc_id IS NULL").withColumns({"good": false, "toxic": false}))


def _add_up(batches):
    held: dict[str, list] = {}
    sums: dict[str, np.ndarray] = {}
    size = 0

    def settle():
        for part, pieces in held.items():
            at = sums.setdefault(part, np.zeros((3, 32), np.int64))
            words = WORDS[np.concatenate([p[0] for p in pieces])]
            at[0] += positional_popcount(words)
            for k in (1, 2):
                at[k] += positional_popcount(words[np.concatenate([p[k] for p in pieces])])
        held.clear()

    def send():
        rows = [(part, s, *counts) for part, at in sums.items() for s, counts in enumerate(at.T.tolist())]
        sums.clear()
        return dict(zip(("part", "subset", "all", "good", "toxic"), map(list, zip(*rows))))

    for b in batches:
        if not b.num_rows:
            continue
        parts = b.column(0).dictionary_encode()
        names, codes = parts.dictionary.to_pylist(), parts.indices.to_numpy(zero_copy_only=False)
        fails, good, toxic = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        order = np.argsort(codes, kind="stable")
        cuts = np.flatnonzero(np.diff(codes[order])) + 1
        for rows in np.split(order, cuts):
            held.setdefault(names[codes[rows[0]]], []).append((fails[rows], good[rows].astype(bool), toxic[rows].astype(bool)))
        size += b.num_rows
        if size >= HELD_WORDS or len(held) >= HELD_PARTS:
            settle()
            size = 0
            if len(sums) >= HELD_PARTS:
                yield send()
    settle()
    if sums:
        yield send()


def survivors(labelled: DataFrame) -> DataFrame:
    """One row per part: ``n``, an array over the 32 subsets of structs (subset,
    all, good, toxic): how many documents survive the subset."""
    counted = map_arrow(labelled, ["part", "fails", "good", "toxic"], "part string, subset int, all long, good long, toxic long", _add_up)
    added = counted.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("all", "good", "toxic")])
    return added.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("subset", "all", "good", "toxic"))).alias("n"))


def _alive(subset, kind: str = "all"):
    index = F.lit(subset) if isinstance(subset, int) else subset
    return F.col("n")[index][kind]


def every_order(counts: DataFrame) -> DataFrame:
    """The audit of all orders from the survivors of every subset."""
    full = SUBSETS - 1
    unique, shapley, failing = [], [], []
    for i in range(len(LETTERS)):
        bit = 1 << i
        failing.append(_alive(0) - _alive(bit))
        unique.append(_alive(full ^ bit) - _alive(full))
        gains = []
        for s in range(SUBSETS):
            if not s & bit:
                orders = factorial(s.bit_count()) * factorial(len(LETTERS) - 1 - s.bit_count())
                gains.append(F.lit(orders) * (_alive(s) - _alive(s | bit)))
        shapley.append(sum(gains[1:], gains[0]))
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(LETTERS))), ",")
    rows = counts.withColumns({"failing": F.array(*failing), "unique": F.array(*unique), "shapley_sums": F.array(*shapley)})
    rows = rows.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    rows = rows.withColumn("letter", F.instr(F.lit(LETTERS), F.substring("filter_order", F.col("step"), F.lit(1))) - 1)
    before = sum((F.when(F.instr("filter_order", x) < F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(LETTERS)), F.lit(0))
    rows = rows.withColumn("before", before)
    rows = rows.withColumn("after", F.col("before") + F.element_at(F.array(*[F.lit(1 << i) for i in range(len(LETTERS))]), F.col("letter") + 1))
    lost = {kind: _alive(F.col("before"), kind) - _alive(F.col("after"), kind) for kind in ("all", "good", "toxic")}
    at = F.col("letter")
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        _alive(F.col("after")).alias("kept"), lost["all"].alias("removed"),
        (F.col("failing")[at] - lost["all"]).alias("redundant"), F.col("unique")[at].alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"), F.col("shapley_sums")[at].alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step."""
    work = Workspace(docs.sparkSession, "filter-audit")
    counts = work.stage(survivors(with_labels(failure_masks(docs, work), labels)), "survivors")
    return every_order(counts)
