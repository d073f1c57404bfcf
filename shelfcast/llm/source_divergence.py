"""How the sources of a language differ in the terms they use.

Texts are cut into terms and counted by Arrow compute functions inside
``mapInArrow``: ascii_lower, split_pattern_regex, dictionary_encode, and two hash
group_bys, by (row, term) for the counts within a text and by (group, term) for
the partial counts of a task. Spark merges the partial counts of a term into one
row, the columnar shard (its sources and their counts, side by side), and drops
terms in too few documents. Tasks then turn shards into divergences with integer
arithmetic on matrices of terms by sources: partial distances of source pairs,
and the terms that a source uses more than its language does.

A task holds a bounded number of partial counts and sends them when it has more.
A shard has at most one entry for each source of its language. What every task
of the last step is given is a line (source, total) for each group of the
languages in hand, and what it holds is a sum for each pair in hand: the work is
done in turns of at most MOST_GROUPS groups and PAIR_CELLS pairs, so a language
of very many sources takes several, each for some of its rows of the pair matrix.

Nulls and odd input: null text, language and source are empty strings. Rows are
counted each, repeated ids or not. A group without any term has the smoothing
alone. A language without kept terms has pairs of distance 0 and no terms; one
with a single source has no pairs. An empty table gives no rows. Columns of
other names are never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import Workspace

#: What separates terms: ASCII other than letters.
BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents that a kept term is in, smoothing, scale, ranks kept.
LEAST_DOCS, ADDED, SCALE_STEPS, TOP_TERMS = 30, 5, (1000, 1000, 1000), 50

#: Partial counts that a task holds before it merges them, and merged before it sends them.
HELD_ROWS, SENT_ROWS = 1_000_000, 500_000
#: Groups (language, source) whose totals are sent to all tasks at once.
MOST_GROUPS = 100_000
#: Cells of a matrix of terms by sources, and of the sums for pairs in one turn.
MATRIX_CELLS, PAIR_CELLS = 1_000_000, 4_000_000

_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of a batch of (lang, source, text)."""
    langs, sources = (batch.column(i).dictionary_encode() for i in (0, 1))
    lists = pc.split_pattern_regex(pc.ascii_lower(batch.column(2)), BREAKS)
    words = pc.list_flatten(lists)
    full = pc.not_equal(words, "")
    rows, terms = pc.filter(pc.list_parent_indices(lists), full), pc.filter(words, full).dictionary_encode()
    in_row = pa.table({"row": rows, "term": terms.indices}).group_by(["row", "term"]).aggregate([([], "count_all")])
    width = max(1, len(sources.dictionary))
    groups = pa.array(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * width + sources.indices.to_numpy(zero_copy_only=False))
    counted = (
        pa.table({"group": groups.take(in_row["row"].combine_chunks()), "term": in_row["term"], "n": in_row["count_all"]})
        .group_by(["group", "term"])
        .aggregate([("n", "sum"), ([], "count_all")])
    )
    group = counted["group"].to_numpy()
    return pa.table(
        [
            langs.dictionary.take(pa.array(group // width)), sources.dictionary.take(pa.array(group % width)),
            terms.dictionary.take(counted["term"].combine_chunks()), counted["n_sum"], counted["count_all"],
        ],
        schema=_PARTIAL,
    )


def merge_counts(tables: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return merged.rename_columns(["lang", "source", "term", "n", "docs"]).select(_PARTIAL.names)


def _count(batches):
    held: list[pa.Table] = []
    for b in batches:
        if b.num_rows:
            held.append(count_terms(b))
        if sum(t.num_rows for t in held) >= HELD_ROWS:
            held = [merge_counts(held)]
            if held[0].num_rows >= SENT_ROWS:
                yield from held.pop().combine_chunks().to_batches(max_chunksize=50_000)
    if held:
        yield from merge_counts(held).combine_chunks().to_batches(max_chunksize=50_000)


def term_shards(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """One row per kept term of a language: lang, term, docs, and ``counts``, an
    array of (source, n). The partial counts move once, by language and term."""
    empty = F.lit("")
    partial = docs.select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")]).mapInArrow(
        _count, "lang string, source string, term string, n long, docs long"
    )
    merged = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (
        merged.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts"))
        .where(F.col("docs") >= least_docs)
    )


def group_totals(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """Every group (lang, source) of ``docs`` with ``total``, its occurrences of
    kept terms, and ``kept``, the number of kept terms of its language."""
    empty = F.lit("")
    groups = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")).distinct()
    used = shards.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    size = shards.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    zero = F.lit(0).cast("long")
    return groups.join(used, ["lang", "source"], "left").join(size, "lang", "left").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept")
    )


def smoothed(count: np.ndarray, total, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), exact: long division in
    steps, whose remainders stay in 64 bits for totals up to 9 * 10^15."""
    divisor = np.asarray(total, np.int64) + ADDED * kept
    rest, out = np.asarray(count, np.int64) + ADDED, np.int64(0)
    out, rest = rest // divisor, rest % divisor
    for step in SCALE_STEPS:
        rest = rest * step
        out = out * step + rest // divisor
        rest = rest % divisor
    return 1 + out


class _Language:
    """Sums of one language over the shards of a task, for the pairs whose first
    source has a place from ``lo`` to ``hi`` - 1."""

    def __init__(self, name: str, sources: list[str], totals: list[int], kept: int, lo: int, hi: int):
        self.name, self.sources, self.kept, self.lo, self.hi = name, sources, kept, lo, hi
        self.totals = np.array(totals, np.int64)
        self.place = {s: i for i, s in enumerate(sources)}
        self.apart = np.zeros((hi - lo, len(sources)), np.int64)

    def add(self, terms: list[str], where: np.ndarray, which: np.ndarray, n: np.ndarray):
        """Terms, and for each count the index of its term and the place of its
        source. Returns the rows of terms, in the first turn of the language."""
        counts = np.zeros((len(terms), len(self.sources)), np.int64)
        counts[where, which] = n
        p = smoothed(counts, self.totals[None, :], self.kept)
        for i in range(self.lo, self.hi):
            self.apart[i - self.lo, i + 1 :] += np.abs(p[:, i : i + 1] - p[:, i + 1 :]).sum(axis=0)
        if self.lo:
            return []
        above = p - smoothed(counts.sum(axis=1), self.totals.sum(), self.kept)[:, None]
        t, s = np.nonzero((counts > 0) & (above > 0))
        return [(self.name, self.sources[j], "term", terms[i], int(above[i, j])) for i, j in zip(t.tolist(), s.tolist())]

    def pairs(self):
        for i in range(self.lo, self.hi):
            for j, value in enumerate(self.apart[i - self.lo, i + 1 :].tolist(), i + 1):
                yield (self.name, self.sources[i], "pair", self.sources[j], value)


def _diverge(groups):
    """The map over shards, given {lang: (sources, totals, kept, lo, hi)}."""
    names = ("lang", "source", "part", "item", "value")

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if k == 4 else pa.string()) for k, c in enumerate(zip(*rows))], names=list(names)
        )

    def run(batches):
        known: dict[str, _Language] = {}
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            terms, counts = b.column(1).to_pylist(), b.column(2)
            for name in sorted(set(langs)):
                if name not in known:
                    known[name] = _Language(name, *groups.value[name])
                lang = known[name]
                mine = np.flatnonzero(langs == name)
                height = max(1, MATRIX_CELLS // len(lang.sources))
                for lo in range(0, len(mine), height):
                    picked = mine[lo : lo + height]
                    lists = counts.take(pa.array(picked))
                    flat = pc.list_flatten(lists)
                    which = np.array([lang.place[s] for s in flat.field("source").to_pylist()], np.int64)
                    rows = lang.add([terms[i] for i in picked], pc.list_parent_indices(lists).to_numpy(), which, flat.field("n").to_numpy())
                    for at in range(0, len(rows), 50_000):
                        yield batch(rows[at : at + 50_000])
        for lang in known.values():
            ready = []
            for row in lang.pairs():
                ready.append(row)
                if len(ready) == 50_000:
                    yield batch(ready)
                    ready = []
            if ready:
                yield batch(ready)

    return run


def _turns(sizes: list[tuple[str, int]], groups: int = MOST_GROUPS, cells: int = PAIR_CELLS) -> list[list[tuple[str, int, int]]]:
    """Turns of (language, lo, hi): at most ``groups`` sources and ``cells`` pairs
    in each, or one language and one row of its pairs."""
    out, has_groups, has_cells = [], 0, 0
    for lang, n in sizes:
        height = max(1, cells // n)
        for lo in range(0, n, height):
            hi = min(n, lo + height)
            size = (hi - lo) * n
            if not out or has_groups + n > groups or has_cells + size > cells or lo:
                out.append([])
                has_groups = has_cells = 0
            out[-1].append((lang, lo, hi))
            has_groups, has_cells = has_groups + n, has_cells + size
    return out


def divergences(docs: DataFrame) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    spark = docs.sparkSession
    work = Workspace(spark, "divergence")
    shards = work.stage(term_shards(docs), "shards")
    totals = work.stage(group_totals(docs, shards), "totals")
    sizes = totals.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")).where("kept > 0").orderBy("lang")
    made = []
    for turn in _turns([(r.lang, r.n) for r in sizes.toLocalIterator()]):
        rows = {lang: (lo, hi) for lang, lo, hi in turn}
        of_turn = F.col("lang").isin(list(rows))
        groups: dict[str, tuple] = {}
        for r in totals.where(of_turn).orderBy("lang", "source").toLocalIterator():
            sources, sums, *_ = groups.setdefault(r.lang, ([], [], r.kept, *rows[r.lang]))
            sources.append(r.source)
            sums.append(r.total)
        sent = spark.sparkContext.broadcast(groups)
        found = shards.where(of_turn).select("lang", "term", "counts").mapInArrow(
            _diverge(sent), "lang string, source string, part string, item string, value long"
        )
        made.append(work.stage(found, "found"))
        sent.destroy()
    found = made[0] if made else spark.createDataFrame([], "lang string, source string, part string, item string, value long")
    for more in made[1:]:
        found = found.unionByName(more)
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    # The rows asked for are all pairs of a language's sources.
    asked = totals.select("lang", "source").join(totals.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = asked.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return ranked.unionByName(terms)
