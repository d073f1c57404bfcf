"""Ranking, rules, toxicity, language fusion and KD search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import kd_search, lang_fusion, ranking, toxicity, weak_rules

from .conftest import ODD_TEXTS


def prose(r, n, extra=()):
    words = ["the", "river", "stone", "walks", "under", "green", "hills", "and", "finds", "water", "slowly", "again"]
    out = []
    for k in range(n):
        w = r.choice(extra) if extra and r.random() < 0.08 else r.choice(words) + (r.choice("abcdefgh") if r.random() < 0.3 else "")
        out.append(w + (".\n" if k % 11 == 10 else ""))
    return " ".join(out)


def junk(r, n):
    kind = r.randint(0, 2)
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in prose(r, n).split())
    if kind == 1:
        return " ".join(w + r.choice(["$$$", "%%%", "###"]) for w in prose(r, n).split())
    return " ".join([r.choice(["spam", "click"])] * n)


# -- quality --------------------------------------------------------------------


def labelled(seed, n=160):
    r = random.Random(seed)
    rows = [(i, junk(r, r.randint(20, 80)) if i % 4 == 0 else prose(r, r.randint(20, 200))) for i in range(n)]
    return rows, [(i, 0 if i % 4 == 0 else 1) for i in range(n)]


def test_ranking_separates_held_out_documents(frame, shipped):
    rows, quality = labelled(1)
    labels = shipped.createDataFrame(quality + [(None, 1), (3, None), quality[5]], "doc_id long, quality int").withColumn("text", F.lit("x"))
    docs = frame(rows + [(1000 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, ODD_TEXTS[0]), rows[7]])
    ranker = ranking.fit_from_labels(docs, labels, F.col("doc_id") < 100)
    got = ranking.score_documents(docs, ranker).collect()
    assert len(got) == len(rows) + len(ODD_TEXTS) + 2
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.doc_id is not None and 100 <= r.doc_id < 1000]
    assert np.mean([r.predicted == dict(quality)[r.doc_id] for r in held]) > 0.95
    kept = ranking.keep_good(docs, ranker)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got)


def test_ranking_without_labels(frame, shipped):
    ranker = ranking.fit_from_labels(frame([(1, "a")]), shipped.createDataFrame([], "doc_id long, quality int"))
    assert [r.score for r in ranking.score_documents(frame([(1, "a"), (2, None)]), ranker).collect()] == [0.5, 0.5]
    assert ranking.score_documents(frame([]), ranker).count() == 0


def test_cut_is_the_quantile_of_the_bad_share():
    x = np.arange(100.0)[:, None]
    y = (np.arange(100) >= 30).astype(int)
    r = ranking.fit_ranker(x, y, 0.3)
    assert ((r.score(x) >= 0.3) == (y == 1)).all()


def all_pairs_optimum(x, y):
    """Weights by Newton steps over every pair written out."""
    z = np.clip((x - x.mean(0)) / (x.std(0) + 1e-3), -8, 8)
    diff = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-diff @ w))
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hess, diff.T @ (p - 1) / len(diff) + 1e-2 * w)
    return w, z @ w


def test_ranking_is_fitted_on_all_pairs():
    rng = np.random.default_rng(3)
    y = (rng.random(500) < 0.7).astype(int)
    x = rng.normal(size=(500, 5)) + y[:, None] * [0.5, 0, 1, -0.3, 0]
    w, worth = all_pairs_optimum(x, y)
    r = ranking.fit_ranker(x, y, (y == 0).mean())
    assert np.abs(r.weights - w).max() < 1e-6
    k = (y == 0).sum()
    assert abs(r.cut - np.sort(worth)[k - 1 : k + 1].mean()) < 1e-5
    assert abs(r.spread - worth.std() / 4) < 1e-5
    # An uneven share weighs the rows of the labels differently; ties stay on one side.
    tied = ranking.fit_ranker(np.repeat(x, 3, axis=0), np.repeat(y, 3), 0.5)
    order = np.argsort(tied.worth(x), kind="stable")
    share = np.where(y == 0, 0.5 / k, 0.5 / (500 - k))[order].cumsum()
    at = int(np.searchsorted(share, 0.5 - 1e-12))
    low, high = tied.worth(x)[order][at : at + 2]
    assert low - 1e-9 <= tied.cut <= (low + high) / 2 + 1e-9


def test_ranking_reads_every_labelled_row(frame, shipped):
    # More rows of each label than any sample of 3,000 would hold.
    rows = [(i, f"word{i} " * (1 + i % 7) + ("$" if i % 2 and i % 11 else "")) for i in range(8000)]
    labels = shipped.createDataFrame([(i, i % 2) for i in range(8000)], "doc_id long, quality int")
    r = ranking.fit_from_labels(frame(rows, clash=False).repartition(5), labels)
    x = np.array([ranking.text_features(t) for _, t in rows])
    y = np.arange(8000) % 2
    assert np.allclose(r.mean, x.mean(0), rtol=1e-12) and np.allclose(r.scale, x.std(0) + 1e-3, rtol=1e-6, atol=1e-9)
    whole = ranking.fit_ranker(x, y, 0.5)
    assert np.abs(r.weights - whole.weights).max() < 1e-6 and abs(r.cut - whole.cut) < 1e-6
    worth = np.sort(r.worth(x))
    assert abs(r.cut - (worth[3999] + worth[4000]) / 2) < 1e-9


# -- rules ----------------------------------------------------------------------


def brute_repeat_words(words):
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)})


def test_statistics_equal_brute_force(frame):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice("ab#c|") for _ in range(r.randint(0, 30)))) for i in range(60)]
    rows += [(100 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(200, "a b\nc\na b\n\n a b\na b\x0b"), (None, "a\na")]
    got = {(x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in weak_rules.document_stats(frame(rows)).collect()}
    want = set()
    for i, t in rows:
        t = t or ""
        words = [w.decode() for w in t.encode().split()]
        lines = t.split("\n")
        dup = sum(1 for k, x in enumerate(lines) if x.encode().split() and x in lines[:k])
        want.add((i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, brute_repeat_words(words)))
    assert got == want


def test_rules_keep_prose_and_reject_junk(frame):
    rows, quality = labelled(3)
    rows += [(1000, None), (1001, "")]
    got = {r.doc_id: r for r in weak_rules.judge(weak_rules.document_stats(frame(rows))).collect()}
    assert len(got) == len(rows)
    assert np.mean([got[i].kept == bool(q) for i, q in quality]) > 0.95
    assert not got[1000].kept and got[1000].base_failed
    assert weak_rules.judge(weak_rules.document_stats(frame([]))).count() == 0


def test_em_recovers_rule_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(4000) < 0.8
    votes = np.array([np.where(rng.random(4000) < (0.03 if v else 0), -1, 0) for v in (1, 1)]).T
    votes = np.stack([np.where(~good & (rng.random(4000) < 0.7), -1, 0), np.where(~good & (rng.random(4000) < 0.5), -1, 0), np.where(good & (rng.random(4000) < 0.9), 1, 0)], 1)
    kinds, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = weak_rules.fit_em(kinds, n.astype(float))
    assert (np.abs((p[at.ravel()] >= 0.5).astype(int) - good).mean()) < 0.12


# -- toxicity -------------------------------------------------------------------


def test_toxicity_learns_words_and_prefixes(frame, shipped):
    r = random.Random(4)
    mean = ["idiot", "moron", "scumbag", "vilething", "vilestone"]
    rows = [(i, prose(r, r.randint(30, 150), mean if i % 3 == 0 else ())) for i in range(240)]
    labels = shipped.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    docs = frame(rows + [(1000 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "idiot")])
    net = toxicity.fit_from_labels(docs, labels, F.col("doc_id") < 180)
    got = toxicity.score_documents(docs, net).collect()
    assert len(got) == 241 + len(ODD_TEXTS)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) for x in got)
    held = [x for x in got if x.doc_id is not None and 180 <= x.doc_id < 240]
    assert np.mean([x.predicted == (x.doc_id % 3 == 0) for x in held]) > 0.9
    # Every window counts: a word at the very end of a long text is found.
    calm = prose(r, 2000)
    low, high = net.scores([calm, calm + " idiot moron scumbag"])
    assert high > 0.7 > low
    blank = toxicity.fit_from_labels(docs, shipped.createDataFrame([], "doc_id long, toxic int"))
    assert {x.score for x in toxicity.score_documents(docs, blank).collect()} == {0.5}
    assert toxicity.score_documents(frame([]), net).count() == 0


def test_windows_cover_every_word_and_overlap():
    for n in range(0, 130):
        w = toxicity.windows(n)
        assert {k for s, m in w for k in range(s, s + m)} == set(range(n))
        assert all(a[0] + a[1] > b[0] for a, b in zip(w, w[1:]))


def test_gradient_matches_differences():
    net = toxicity.Net.start(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x = rng.normal(size=(6, 2 * toxicity.WIDE))
    index = rng.integers(0, 6, (3, toxicity.WINDOW))
    mask = np.arange(toxicity.WINDOW) < np.array([[5], [24], [12]])
    target, weight = np.array([1.0, 0.0, 1.0]), np.array([0.5, 1.0, 2.0])

    def loss():
        z = net.forward(x, index, mask)[0]
        return float((weight * (np.logaddexp(0, z) - target * z)).sum())

    logit, held = net.forward(x, index, mask, keep=True)
    g, dx = net.gradient(x, index, mask, logit, held, target, weight)
    for name in ("Uf", "Ub", "Wf", "cb", "att", "out", "bias"):
        flat = net.p[name].reshape(-1)
        for k in rng.integers(0, len(flat), 3):
            old = flat[k]
            flat[k] = old + 1e-4
            up = loss()
            flat[k] = old - 1e-4
            slope = (up - loss()) / 2e-4
            flat[k] = old
            assert g[name].reshape(-1)[k] == pytest.approx(slope, rel=2e-2, abs=2e-4)


# -- languages ------------------------------------------------------------------


def test_fusion_equals_brute_force(shipped):
    rng = np.random.default_rng(3)
    langs = ("aa", "bb", "cc")
    hosts = ["x.p.net", "y.p.net", "q.org", None, "solo"]
    rows = []
    for i in range(80):
        ll = rng.normal(0, 2, 3) if i % 7 else np.zeros(3)
        rows.append((i, hosts[i % 5], [None, "aa", "bb"][i % 3], [float(v) for v in ll - ll.max()]))
    df = shipped.createDataFrame(rows, "id long, host string, declared string, ll array<double>")
    df = df.withColumns({"domain": F.when(F.col("host").contains("."), F.substring_index("host", ".", -2)).otherwise(F.col("host")),
                         "suffix": F.when(F.col("host").contains("."), F.substring_index("host", ".", -1))})
    got = {r.id: r for r in lang_fusion.fuse(df, langs).collect()}
    full = [(r.id, {"host": r.host, "domain": r.domain, "suffix": r.suffix, "declared": r.declared}, np.array(r.ll)) for r in df.collect()]
    p = {i: np.exp(ll) / np.exp(ll).sum() for i, _, ll in full}
    share = sum(p.values()) + 1
    share = share / share.sum()
    k = lang_fusion.SMOOTH

    def mix(i, key, value, own, above):
        peers = [j for j, f, _ in full if value is not None and f[key] == value]
        s = sum((p[j] for j in peers), np.zeros(3))
        n = len(peers)
        if own:
            s, n = np.maximum(s - p[i], 0), max(n - 1, 0)
        return (s + k * above) / (n + k)

    for i, f, ll in full:
        domain = mix(i, "domain", f["domain"], True, share)
        logs = ll + np.log(mix(i, "host", f["host"], True, domain))
        for key in ("suffix", "declared"):
            logs = logs + np.log(mix(i, key, f[key], False, share) / share)
        post = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        assert got[i].lang == langs[int(post.argmax())]
        assert got[i].posterior == pytest.approx(post.max(), rel=1e-9)
        assert got[i].accepted == (got[i].posterior >= 0.5)


def test_pages_get_the_language_of_their_evidence(frame, shipped):
    r = random.Random(1)
    en = lambda: prose(r, 60)
    de = lambda: " ".join(r.choice(["der", "fluß", "geht", "über", "grüne", "hügel", "und", "findet"]) for _ in range(60))
    docs = shipped.createDataFrame([(i, en() if i % 2 else de(), "en" if i % 2 else "de") for i in range(60)] + [(99, None, None)], "doc_id long, text string, lang string")
    model = lang_fusion.fit_text_model(docs)
    assert model.languages == ("de", "en")
    rows = [(i, f"https://{'a.en.net' if i % 2 else 'b.de.org'}/p{i}", f"<html lang='{'en' if i % 2 else 'de'}'><script>der der</script><p>{en() if i % 2 else de()}</p>") for i in range(30)]
    rows += [(100, "https://a.en.net/empty", ""), (101, None, None), (102, "not an address", "<html LANG=de-AT>"), (None, rows[0][1], rows[0][2]), rows[1]]
    pages = shipped.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "ll", "id", "lang")})
    got = lang_fusion.identify_pages(pages, model).collect()
    assert len(got) == len(rows)
    by = {x.page_id: x for x in got}
    assert all(by[i].lang == ("en" if i % 2 else "de") and by[i].accepted for i in range(30))
    assert by[100].lang == "en" and by[100].text_lang is None  # by its host
    assert by[101].lang in model.languages
    assert by[102].declared == "de"
    assert lang_fusion.identify_pages(pages.limit(0), model).count() == 0
    none = lang_fusion.fit_text_model(docs.limit(0))
    assert [(x.lang, x.accepted) for x in lang_fusion.identify_pages(pages.limit(1), none).collect()] == [(None, False)]


def test_every_labelled_language_is_fitted(shipped, monkeypatch):
    """More languages than one table of commonest ones would hold: pages of each
    get its name, the rarest too, whatever batch sizes the counts are sent in."""
    r = random.Random(6)
    names = [f"l{k:02d}" for k in range(40)]
    words = {name: ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 8))) for _ in range(12)] for name in names}
    text = lambda name: " ".join(r.choice(words[name]) for _ in range(50))
    rows = [(1000 * k + i, text(name), name) for k, name in enumerate(names) for i in range(3 if k in (7, 39) else 6)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_fusion.fit_text_model(docs)
    assert model.languages == tuple(names)
    monkeypatch.setattr(lang_fusion, "_FLUSH", 500)
    assert np.array_equal(lang_fusion.fit_text_model(docs).log_p, model.log_p)
    pages = [(k, None, f"<p>{text(name)}</p>") for k, name in enumerate(names)]
    got = lang_fusion.identify_pages(shipped.createDataFrame(pages, "page_id long, url string, html string"), model).collect()
    assert all(x.lang == x.text_lang == names[x.page_id] and x.accepted for x in got) and len(got) == 40


def test_fit_sample_is_the_first_of_each_language_by_hash(shipped):
    rows = [(i, "x", ["aa", "bb", "cc"][min(i % 7, 2)]) for i in range(700)] + [(5, "x", "aa"), (None, "x", "dd"), (9, "x", ""), (9, "x", None)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string")
    found, chosen = lang_fusion._fit_sample(docs, 40)
    assert found == {"aa": 101, "bb": 100, "cc": 500, "dd": 1}
    got = sorted(map(tuple, chosen.collect()), key=repr)
    want = []
    for name in ("aa", "bb", "cc"):
        ids = docs.where((F.col("lang") == name) & F.col("doc_id").isNotNull()).select("doc_id", "lang").distinct()
        want += ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(40).collect()
    assert got == sorted(map(tuple, want), key=repr)


def test_repeated_rows_are_fitted_once_each(shipped):
    text = "ein kleiner text mit worten"
    schema = "doc_id long, text string, lang string"
    one = lang_fusion.fit_text_model(shipped.createDataFrame([(1, text, "de"), (2, "other words here", "en")], schema))
    rows = [(1, text, "de")] * 10 + [(1, "words of one id", "en"), (2, "other words here", "en"), (None, text * 3, "de")]
    many = lang_fusion.fit_text_model(shipped.createDataFrame(rows, schema))
    assert many.totals[0] == 10 * one.totals[0]
    assert many.totals[1] == one.totals[1] + len(lang_fusion.grams("words of one id"))


# -- vectors --------------------------------------------------------------------


def brute_top(rows, k, is_query):
    held = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and all(map(math.isfinite, v)):
            held[i] = min(held.get(i, v), v)
    vec = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v in held.items()}
    out = []
    for q in filter(is_query, vec):
        s = sorted((-sum(a * b for a, b in zip(vec[q], vec[i])), i) for i in vec if i != q and len(vec[i]) == len(vec[q]))
        out += [(q, n + 1, i, -score) for n, (score, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("leaf", [2, 128])
def test_top_k_equals_brute_force(shipped, monkeypatch, leaf):
    monkeypatch.setattr(kd_search, "SHARD_ROWS", 40)
    monkeypatch.setattr(kd_search, "BLOCK_ROWS", 7)
    monkeypatch.setattr(kd_search.Tree.__init__, "__defaults__", (leaf,))
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 0.3, 4), 1)]) for i in range(250)]  # coarse, so scores tie
    rows += [(300 + i, [float(x) for x in rng.normal(size=3)]) for i in range(3)]
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0]), (402, [math.nan, 0.0, 0.0, 0.0]), (403, [math.inf, 0.0, 0.0, 0.0]), (404, []), (405, []), (None, [1.0] * 4), rows[10], (20, [9.0] * 4)]
    # Rows that take no part do not stand in for a valid row of their id.
    rows += [(15, [None] * 4), (16, [math.nan] * 4), (17, [-math.inf] * 4), (18, None)]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = kd_search.top_k(df, F.col("vec_id") % 5 == 0, 6).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 6, lambda i: i % 5 == 0)
    assert kd_search.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_large_components_stay_exact(shipped):
    rows = [(i, [float(i % 97) * 1000, float(i % 89) * 700]) for i in range(60)]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = kd_search.top_k(df, F.col("vec_id") % 20 == 0, 3).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 3, lambda i: i % 20 == 0)


def test_visible_text_equals_the_plain_patterns():
    import random
    import re

    from shelfcast.llm.lang_fusion import visible_text

    hidden = re.compile(r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->")
    rng = random.Random(5)
    parts = ["<script", "<script>", "</script>", "</SCRIPT >", "<style a=1>", "</style>", "<!--", "-->", "<!---->", "--", "<", ">", "<p>", "word ",
             "<scripts>", "</template>", "<Template>", "-", "\n"]
    for _ in range(3000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert visible_text(page) == re.sub(r"(?s)<[^>]*>", " ", hidden.sub(" ", page)), page
    assert visible_text("a &amp; b") == "a & b"


def test_pages_of_unclosed_marks_take_linear_time():
    import time

    from shelfcast.llm.lang_fusion import visible_text

    start = time.monotonic()
    for mark in ("<", "<script>", "<!--", "<style ", "</script ", "<!-- <script> "):
        page = mark * (2_000_000 // len(mark))
        assert len(visible_text(page)) > 100_000
    assert time.monotonic() - start < 60


def test_declared_language_of_pages_of_unclosed_marks(spark):
    import time

    from pyspark.sql import functions as F

    from shelfcast.llm.lang_fusion import PAGE_LANG

    pages = spark.createDataFrame([("<html " * 300_000,), ('<HTML class="x"\n lang = "De-AT">',), ("<html>lang=fr",)], "h string")
    start = time.monotonic()
    got = [r[0] for r in pages.select(F.regexp_extract("h", PAGE_LANG, 1)).collect()]
    assert got == ["", "De", ""] and time.monotonic() - start < 60
