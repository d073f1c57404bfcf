"""Exact duplicates, the filter audit and source divergences against brute force."""

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import bloom_dedup, filter_audit, joins, queries, source_divergence

from .conftest import ODD_TEXTS

CLASHING = ("digest", "row", "keep", "n", "fails", "part", "term", "docs", "counts", "total", "kept", "good", "group_size", "_bucket")
LONG = "wörd und noch eins " * 150_000


def some_rows(seed, n=150, ids=60):
    """(doc_id, text, lang, source): few ids, few texts, nulls everywhere."""
    r = random.Random(seed)
    words = ["Red", "green", "BLUE", "naïve", "tea-pot", "x1y", "日本", "$5", "the", "of"]
    texts = [" ".join(r.choice(words) for _ in range(r.choice((0, 1, 3, 12, 230)))) for _ in range(30)] + ODD_TEXTS
    pick = lambda values: r.choice(values)
    rows = [(pick([None, *range(ids)]), pick(texts), pick(["en", "de", None, ""]), pick(["a", "b", "c", None])) for _ in range(n)]
    return rows + rows[:5] + [(10**12, "red red", "fr", "only"), (10**12 + 1, "", "it", "a"), (10**12 + 2, None, "it", "b")]


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in CLASHING:
        df = df.withColumn(name, F.lit("x"))
    return df.repartition(3)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def brute_duplicates(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: -1 if i is None else i)
        out += [(i, ids[-1], len(ids), at == len(ids) - 1, sha256(t.encode()).hexdigest()) for at, i in enumerate(ids)]
    return sorted(out, key=repr)


def duplicates(docs):
    found = bloom_dedup.exact_duplicates(docs)
    return tuples(found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))))


def test_duplicates_equal_brute_force(shipped):
    rows = some_rows(1) + [(5, LONG, "en", "a"), (7, LONG, "en", "a"), (8, LONG + "!", "en", "a")]
    docs = table(shipped, rows)
    assert duplicates(docs) == brute_duplicates(rows)
    kept = bloom_dedup.without_duplicates(docs)
    assert kept.columns == docs.columns
    wanted = Counter((i, sha) for i, _, _, stays, sha in brute_duplicates(rows) if stays)
    assert Counter((r.doc_id, sha256((r.text or "").encode()).hexdigest()) for r in kept.collect()) == wanted
    assert duplicates(docs.where("false")) == [] and bloom_dedup.without_duplicates(docs.where("false")).count() == 0


def test_duplicates_by_slices_hot_groups_and_crowded_bitmaps(shipped, monkeypatch):
    rows = some_rows(2) + [(1000 + k, "one hot text", "en", "a") for k in range(200)]
    rows += [(5000 + k, f"a text of its own {k}", "en", "a") for k in range(300)]
    monkeypatch.setattr(bloom_dedup, "SLICE_ROWS", 150)
    monkeypatch.setattr(joins, "LEAST_HOT", 20)
    assert duplicates(table(shipped, rows)) == brute_duplicates(rows)
    monkeypatch.setattr(bloom_dedup, "bitmap_size", lambda n: 64)  # nearly every row is a false positive
    assert duplicates(table(shipped, rows)) == brute_duplicates(rows)


def test_only_possible_repeats_leave_the_filters(shipped):
    rows = [(k, f"text {k % 1900}") for k in range(2000)]
    work = bloom_dedup.Workspace(shipped, "t")
    df = shipped.createDataFrame(rows, "doc_id long, text string").withColumn("digest", bloom_dedup.digest_of("text"))
    maybe = bloom_dedup.possibly_repeated(work, work.stage(df, "d"), "digest", 2000)
    found = {r.doc_id: r.maybe for r in maybe.collect()}
    twice = {k for k in range(2000) if k < 100 or k >= 1900}
    assert all(found[k] for k in twice) and sum(found.values()) < 300


def test_dedup_plan_has_no_python(shipped, tmp_path):
    table(shipped, some_rows(3)).write.parquet(str(tmp_path / "documents.parquet"))
    plan = queries.op12_bloom_dedup(shipped, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_positional_popcount(words):
    counts = filter_audit.positional_popcount(np.array(words, np.uint32))
    assert counts.tolist() == [sum(w >> k & 1 for w in words) for k in range(32)]


def test_survival_words():
    assert all((int(filter_audit.WORDS[m]) >> s & 1) == (m & s == 0) for m in range(32) for s in range(32))


def brute_audit(rows, labels):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = defaultdict(list)
    for i, t, _, source in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            x for x, bad in zip("ABCDE", (
                len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t],
            )) if bad
        }
        mine = [x for x in labels if i is not None and x[0] == i]
        docs[source or ""].append((fails, any(q == 1 for _, q, _ in mine), any(x == 1 for _, _, x in mine)))
    out = []
    for part, held in docs.items():
        removed, lines = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = held
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                removed[x] += len(gone)
                lines.append((x, part, order, step, len(left), len(gone), sum(x in d[0] for d in held) - len(gone),
                              sum(d[0] == {x} for d in held), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*line[1:], removed[line[0]]) for line in lines]
    return sorted(out, key=repr)


LABELS = [(k, k % 2, k % 3 == 0 and 1 or 0) for k in range(0, 60, 2)] + [(4, None, 1), (4, 1, None), (None, 1, 1), (999, 1, 1)]


def test_audit_equals_brute_force(shipped, monkeypatch):
    rows = some_rows(4) + [(3, LONG, "en", "a"), (2, LONG, "en", "b")]
    labels = shipped.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    docs = table(shipped, rows)
    assert tuples(filter_audit.audit(docs, labels)) == brute_audit(rows, LABELS)
    monkeypatch.setattr(joins, "LEAST_HOT", 3)
    monkeypatch.setattr(filter_audit, "HELD_WORDS", 7)
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 1)
    assert tuples(filter_audit.audit(docs, labels.where("false"))) == brute_audit(rows, [])
    assert filter_audit.audit(docs.where("false"), labels).count() == 0


def brute_divergence(rows, least=30):
    uses, docs, groups = Counter(), Counter(), defaultdict(set)
    for _, t, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        uses.update((lang, source, x) for x in terms)
        docs.update((lang, x) for x in set(terms))
    out = []

    def ranked(lang, source, part, values, most=None):
        values = sorted(values, key=lambda v: (-v[1], v[0].encode()))[:most]
        return [(lang, source, part, item, value, k) for k, (item, value) in enumerate(values, 1)]

    for lang, sources in groups.items():
        kept = sorted(x for (g, x), n in docs.items() if g == lang and n >= least)
        count = {s: [uses[lang, s, x] for x in kept] for s in sources}
        whole = [sum(count[s][k] for s in sources) for k in range(len(kept))]
        p = lambda c: [1 + 10**9 * (n + 5) // (sum(c) + 5 * len(kept)) for n in c]
        ps, q = {s: p(count[s]) for s in sources}, p(whole)
        for s in sources:
            out += ranked(lang, s, "pair", [(b, sum(abs(x - y) for x, y in zip(ps[s], ps[b]))) for b in sources if b != s])
            out += ranked(lang, s, "term", [(x, a - b) for x, a, b, n in zip(kept, ps[s], q, count[s]) if n and a > b], 50)
    return sorted(out, key=repr)


@pytest.mark.parametrize("held", [10**6, 5])
def test_divergences_equal_brute_force(shipped, monkeypatch, held):
    monkeypatch.setattr(source_divergence, "HELD_ROWS", held)
    monkeypatch.setattr(source_divergence, "SENT_ROWS", held)
    r = random.Random(9)
    names = [f"{a}{b}" for a in "äbcdefg" for b in "defghijklmnopqrstuvwxyz"]
    rows = some_rows(5, 200)
    rows += [(None, "-".join(r.choice(names) for _ in range(r.choice((0, 160)))), "en", r.choice("abcd")) for _ in range(120)]
    rows += [(1, LONG, "en", "z")]
    got = tuples(source_divergence.divergences(table(shipped, rows)))
    assert got == brute_divergence(rows)
    assert {x[2] for x in got} == {"pair", "term"} and max(x[5] for x in got) == 50
    assert source_divergence.divergences(table(shipped, rows).where("false")).count() == 0


def test_divergences_in_several_turns(shipped, monkeypatch):
    rows = some_rows(6, 300)
    turns = source_divergence._turns([("de", 3), ("en", 40), ("fr", 2)], 41, 200)
    assert all(sum((hi - lo) * {"de": 3, "en": 40, "fr": 2}[lang] for lang, lo, hi in turn) <= 200 for turn in turns)
    covered = sorted((lang, k) for turn in turns for lang, lo, hi in turn for k in range(lo, hi))
    assert covered == [("de", k) for k in range(3)] + [("en", k) for k in range(40)] + [("fr", k) for k in range(2)]
    make = source_divergence._turns
    monkeypatch.setattr(source_divergence, "_turns", lambda sizes: make(sizes, 3, 5))
    monkeypatch.setattr(source_divergence, "MATRIX_CELLS", 8)
    assert tuples(source_divergence.divergences(table(shipped, rows))) == brute_divergence(rows)


def test_smoothed_counts_are_exact():
    r = random.Random(1)
    for _ in range(200):
        total, kept = r.randint(0, 10**15), r.randint(1, 10**6)
        n = r.randint(0, total)
        assert int(source_divergence.smoothed(np.array([n]), total, kept)[0]) == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_terms_of_a_batch():
    b = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "source": ["a", "a"], "text": ["It's ÄÖ_b it", "\x00 it 4"]})
    rows = {(r["term"]): (r["n"], r["docs"]) for r in source_divergence.count_terms(b).to_pylist()}
    assert rows == {"it": (3, 2), "s": (1, 1), "ÄÖ": (1, 1), "b": (1, 1)}


def test_sql_of_the_audits(shipped, tmp_path):
    rows = some_rows(7, 400)
    table(shipped, rows).write.parquet(str(tmp_path / "documents.parquet"))
    shipped.createDataFrame(LABELS, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    for name in ("op11_source_divergence", "op12_bloom_dedup", "op13_filter_audit"):
        got = queries.QUERIES[name](shipped, str(tmp_path))
        said = con.sql(queries.ORACLE[name])
        assert got.columns == said.columns
        assert tuples(got) == sorted(said.fetchall(), key=repr)
