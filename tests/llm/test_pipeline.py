"""The pipeline's stages on a small corpus with one case of each kind."""

import random

import corpus_pipeline

from .conftest import DOCS
from .test_models import junk, prose


def test_stages_keep_clean_documents(shipped, tmp_path):
    r = random.Random(9)
    rows = [(i, junk(r, 40) if i % 5 == 0 else prose(r, r.randint(60, 160)), "en", f"s{i % 3}", 0) for i in range(100)]
    clean = [x for x in rows if x[0] % 5]
    rows += [(200, clean[0][1], "en", "s0", 0), (201, clean[1][1] + " end", "en", "s0", 0), (202, None, None, None, None), (None, clean[2][1], "en", "s1", 0)]
    shared = " ".join(f"passage{k}" for k in range(30))
    rows += [(300, prose(r, 80) + " " + shared, "en", "s0", 0), (301, prose(r, 80) + " " + shared, "en", "s0", 0)]
    sf = str(tmp_path)
    shipped.createDataFrame(rows, DOCS).write.parquet(f"{sf}/documents.parquet")
    shipped.createDataFrame([(i, int(i % 5 != 0)) for i in range(100)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    docs = shipped.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for n, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(shipped, docs, sf)
        if n < 4:
            assert out.columns == docs.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(path := f"{sf}/out{n}")
        docs = shipped.read.parquet(path)
        seen.append(docs.collect())
    quality, language, near, repeats, pieces = ({x.doc_id for x in s} for s in seen)
    clean_ids = {x[0] for x in clean}
    assert len(quality & clean_ids) >= 0.97 * len(clean_ids) and len(quality & {x[0] for x in rows[:100]} - clean_ids) <= 1
    assert len(language & clean_ids) >= 0.97 * len(quality & clean_ids)
    assert {200, 201} & language and not {200, 201} & near and clean[0][0] in near
    assert repeats == near == pieces
    texts = {x.doc_id: x for x in seen[3]}
    assert shared in texts[300].text and shared not in texts[301].text
    assert all(x.n_chars == len(x.text) for x in seen[3] if x.text is not None)
    assert sum(x.length for x in seen[4]) > 0
    assert {r.doc_id for r in corpus_pipeline.run(shipped, sf).select("doc_id").collect()} == pieces


def test_stages_take_an_empty_table(shipped, tmp_path):
    sf = str(tmp_path)
    shipped.createDataFrame([], DOCS).write.parquet(f"{sf}/documents.parquet")
    shipped.createDataFrame([], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(shipped, sf).count() == 0


def test_near_copies_are_five_word_sets_of_similarity_80(frame, shipped):
    """The stage keeps the smallest doc_id of each group that brute force finds,
    with pairs around the threshold."""
    r = random.Random(4)
    rows, added = [], [0, 1, 30, 36, 40, 42, 45, 48, 49, 50, 52, 60]
    for k, more in enumerate(added):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(200)]
        rows += [(10 * k, " ".join(base)), (10 * k + 1, " ".join(base + [f"x{r.randint(0, 10**6)}" for _ in range(more)]))]
    base = [f"v{r.randint(0, 3000)}" for _ in range(120)]
    for k in range(40):  # a group of near copies, most of them near one another
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = f"e{r.randint(0, 10**6)}"
        rows.append((1000 + k, " ".join(words)))
    for k, n in enumerate((1, 4, 5, 6, 14, 20)):  # short texts, and one word more
        base = [f"s{r.randint(0, 10**6)}" for _ in range(n)]
        rows += [(2000 + 10 * k, " ".join(base)), (2001 + 10 * k, " ".join(base)), (2002 + 10 * k, " ".join(base + ["more"]))]
    sets = []
    for _, text in rows:
        w = text.split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    group = {i: {i} for i, _ in rows}
    between = 0
    for a in range(len(rows)):
        for b in range(a):
            alike = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            between += 0.8 <= alike < 0.85
            if alike >= 0.8 and group[rows[a][0]] is not group[rows[b][0]]:
                joined = group[rows[a][0]] | group[rows[b][0]]
                group.update(dict.fromkeys(joined, joined))
    assert between >= 4
    kept = corpus_pipeline.one_of_each_group(shipped, frame(rows, clash=False), "")
    assert sorted(x.doc_id for x in kept.collect()) == sorted({min(g) for g in group.values()})


def test_language_stage_drops_noise_and_foreign_texts(shipped):
    """Whatever they are declared as, and with one labelled language too."""
    r = random.Random(8)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    noise = [" ".join("".join(r.choice(alphabet) for _ in range(r.randint(3, 12))) for _ in range(50)) for _ in range(4)]
    german = ["der", "fluß", "geht", "über", "grüne", "hügel", "zwischen", "wäldern", "zurück", "pflügt"]
    foreign = [
        "Река медленно течёт под зелёными холмами и находит воду снова и снова среди камней",
        "Ο ποταμός ρέει αργά κάτω από τους πράσινους λόφους και βρίσκει ξανά το νερό",
        "Rzeka płynie powoli pod zielonymi wzgórzami i znów znajduje wodę wśród kamieni oraz trawy",
    ]
    markup = ['<div class="nav-item"><a href="/x?id=3">&nbsp;</a></div><span style="display:none">{}</span> <td colspan=2 onclick="go(1)">' * 2]
    for two in (False, True):
        rows = [(i, prose(r, r.randint(5, 120)), "en", f"s{i % 3}", 0) for i in range(80)]
        if two:
            rows += [(100 + i, " ".join(r.choice(german) for _ in range(60)), "de", "s4", 0) for i in range(20)]
        rows += [(300, None, "en", "s0", 0), (301, "", None, "s1", 0)]
        bad = [(200 + i, t, ["en", None][i % 2], f"s{i % 3}", 0) for i, t in enumerate(noise + foreign + markup)]
        bad += [(400, None, None, None, 0), (401, " 12 ", "", "", 0)]
        kept = corpus_pipeline.known_language(shipped, shipped.createDataFrame(rows + bad, DOCS), "").collect()
        found = {x.doc_id for x in kept}
        assert (found - {x[0] for x in rows}, {x[0] for x in rows} - found) == (set(), set())
