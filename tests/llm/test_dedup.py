"""Repeated bytes and similar documents against brute force."""

import random
from hashlib import sha256

import numpy as np
from hypothesis import given, settings, strategies as st

from shelfcast.llm import jaccard_join, suffix_dedup
from shelfcast.llm.common import Workspace

from .conftest import ODD_TEXTS


def brute_repeats(rows, length):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1) if i is not None else ():
            if first[b[s : s + length]] < (i, s):
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed, n=60):
    r = random.Random(seed)
    words = ["the", "of", "andé", "thing", "x", "stone", "river", "ß"]
    text = lambda k: " ".join(r.choice(words) for _ in range(k))
    shared = [text(30) for _ in range(4)] + ["the " * 60, "a common line of text that many documents hold. "]
    rows = []
    for i in range(n):
        parts = [text(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            parts += [r.choice(shared), text(r.randint(0, 15))]
        rows.append((r.randint(0, 10**6), " ".join(parts)))
    rows += [(rows[0][0] + 10**7, rows[0][1]), (rows[1][0], rows[1][1]), (rows[2][0], "other " + rows[2][1]), (None, rows[0][1])]
    return rows + [(2 * 10**7 + k, t) for k, t in enumerate(ODD_TEXTS)]


def test_repeats_equal_brute_force(frame):
    rows = passages(1)
    got = suffix_dedup.remove_repeats(frame(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows, 100)
    assert suffix_dedup.remove_repeats(frame([])).count() == 0


def test_frequent_anchors_are_sent_window_by_window(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    rows = passages(2, 40)
    got = suffix_dedup.remove_repeats(frame(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows, 100)


def test_long_documents_are_cut_into_parts(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PIECE", 300)
    rows = passages(3, 30)
    docs = [(i, (t or "").encode()) for i, t in rows if i is not None]
    seen = sum(int((hi - lo + 1).sum()) for raw, s, e, _, _ in suffix_dedup.pieces(docs, 100) for _, lo, hi, _ in [suffix_dedup.anchors(raw, s, e)])
    assert seen == sum(max(0, len(b) - 99) for _, b in docs)


def test_a_window_has_its_anchor_in_blocks_of_any_length():
    r = random.Random(4)
    whole = bytes(r.choice(b"ab ") for _ in range(3000))

    def chosen(raw):
        h, lo, hi, at = suffix_dedup.anchors(raw, np.array([0]), np.array([len(raw)]))
        return {(i, int(a)): int(x) for x, first, last, a in zip(h, lo, hi, at) for i in range(first, last + 1)}

    found = chosen(whole)
    for start, end in ((0, 150), (700, 1100), (2000, 3000)):
        part = {(i + start, a + start): x for (i, a), x in chosen(whole[start:end]).items()}
        assert part.items() <= found.items()


def test_kept_texts_follow_the_spans(frame):
    rows = [(1, "α" * 60 + "0123456789" * 12), (2, "β " + "0123456789" * 12 + " ende"), (3, None)]
    docs = frame(rows)
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    digests = {r.doc_id: r.kept_sha256 for r in suffix_dedup.remove_repeats(docs).collect()}
    assert kept[3] is None
    assert all(sha256((kept[i] or "").encode()).hexdigest() == digests[i] for i in kept)


@given(st.lists(st.lists(st.binary(min_size=1, max_size=6).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=12), min_size=1, max_size=7))
@settings(max_examples=150, deadline=None)
def test_loser_tree_merges_and_knows_prefixes(runs):
    coded = [suffix_dedup.front_code(sorted((t, 1, 2, 3, 4) for t in run)) for run in runs]
    merged = list(suffix_dedup.merge_runs([suffix_dedup.front_decode(c) for c in coded]))
    texts = [m[0] for m in merged]
    assert texts == sorted(t for run in runs for t in run)
    for a, b in zip(merged, merged[1:]):
        assert b[1] == suffix_dedup.common_prefix(a[0], b[0])


# -- similar documents ------------------------------------------------------------


def brute_groups(rows, percent=85):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(s), None if i is None else least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def families(seed, n, size, edits):
    """Documents around a few bases, with up to ``edits`` words changed."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        base = [f"w{r.randint(0, 3000)}" for _ in range(size)]
        for _ in range(r.randint(5, 45)):
            words = list(base)
            for _ in range(r.randint(0, edits)):
                words[r.randrange(size)] = f"e{r.randint(0, 10**6)}"
            rows.append((r.randint(0, 10**9), " ".join(words)))
    r.shuffle(rows)
    return rows


def groups(frame, rows):
    return sorted(map(tuple, jaccard_join.similar_groups(frame(rows)).collect()), key=repr)


def test_groups_equal_brute_force_with_frequent_tokens(frame, monkeypatch):
    monkeypatch.setattr(jaccard_join.counted_tokens, "__defaults__", (4, 3, 1 << 20))
    monkeypatch.setattr(jaccard_join.index_keys, "__defaults__", (16, 6))
    rows = families(1, 4, 120, 6) + families(2, 5, 24, 2) + families(3, 4, 8, 1)
    rows += list(enumerate(ODD_TEXTS)) + [(None, rows[0][1]), (rows[1][0], rows[1][1]), (10**9 + 5, rows[2][1].upper())]
    for small in (8, 2):  # with most groups listed as pairs, and hardly any
        monkeypatch.setattr(jaccard_join, "SMALL", small)
        assert groups(frame, rows) == brute_groups(rows)


def test_groups_equal_brute_force_without_frequent_tokens(frame):
    rows = families(4, 3, 60, 5)
    assert groups(frame, rows) == brute_groups(rows)
    assert groups(frame, []) == []


def near_copies(seed, n, common=40, most=7):
    """Copies of one text, each with some of ``common`` edits made, and drifts: texts
    of which each is near the one before, and ever farther from the first."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(110)]
    edits = [(r.randrange(110), f"c{i}") for i in range(common)]
    rows = []
    for i in range(n):
        words = list(base)
        for at, word in r.sample(edits, r.randint(1, most)):
            words[at] = word
        if i % 4 == 0:
            words += [f"t{r.randint(0, 9)}"] * r.randint(1, 6)
        rows.append((r.randint(0, 10**9), " ".join(words)))
    for k in range(2):
        words = list(base)
        for i in range(12):
            words[9 * i] = f"d{k}"
            rows.append((r.randint(0, 10**9), " ".join(words)))
    return rows


def test_groups_equal_brute_force_with_many_members(frame, monkeypatch):
    """Large groups go by the differences from hubs, small ones are joined."""
    monkeypatch.setattr(jaccard_join.counted_tokens, "__defaults__", (4, 3, 1 << 20))
    monkeypatch.setattr(jaccard_join.index_keys, "__defaults__", (16, 6))
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    rows = near_copies(5, 120) + families(6, 3, 120, 9) + families(7, 5, 24, 3) + families(8, 4, 8, 2)
    # Short texts that share a common line and little else: far from any one hub.
    rows += [(10**6 + i, f"a line that all of these texts hold x{i % 40} y{i % 40} z{i % 13} u{i % 7} v{i % 5}") for i in range(120)]
    rows += [(rows[3][0], rows[3][1]), (None, rows[4][1]), (10**9 + 5, rows[5][1].upper())] + list(enumerate(ODD_TEXTS))
    want = brute_groups(rows)
    for many, reach in ((2, 0.5), (20, 0.1)):
        monkeypatch.setattr(jaccard_join, "MANY", many)
        monkeypatch.setattr(jaccard_join, "REACH", reach)
        assert groups(frame, rows) == want, (many, reach)


def test_pairs_of_a_large_group_grow_with_its_size(frame, monkeypatch):
    """Of copies of one text, most have two edits of their own, a sixth has three
    that many have: too far from the hub, and not so far from the others that
    their distances tell."""
    made, plain = {}, Workspace.stage

    def stage(self, df, name):
        made[name] = plain(self, df, name)
        if name == "rest":
            made["pairs"] = made[name].count()
        return made[name]

    monkeypatch.setattr(Workspace, "stage", stage)
    r = random.Random(3)
    rows = [(0, " ".join(f"b{k}" for k in range(110)))]
    for i in range(1, 721):
        words = rows[0][1].split()
        for at in r.sample(range(8, 110, 13), 3) if i % 6 == 0 else r.sample(range(110), 2):
            words[at] = f"c{at}" if i % 6 == 0 else f"e{i}"
        rows.append((i, " ".join(words)))
    assert groups(frame, rows) == brute_groups(rows)
    assert made["pairs"] < 3 * len(rows)


def test_two_sets_beyond_a_hub_are_still_compared(shipped):
    """Two like sets in a large group of others, which share no group but that."""
    sets = {i: list(range(100 * i, 100 * i + 20)) for i in range(5)} | {7: list(range(900, 920)), 8: list(range(901, 921))}
    left = shipped.createDataFrame([(1, False, i, 20, i, i) for i in sets], "gid long, paired boolean, cid long, n long, rare long, root long")
    tokens = shipped.createDataFrame(list(sets.items()), "cid long, tokens array<long>")
    work = Workspace(shipped, "t")
    for settled in range(5):
        to_hub, pairs, beyond = jaccard_join._beside_hubs(left, tokens, work, 85)
        assert to_hub.count() == pairs.count() == 0
        left = work.stage(jaccard_join._mixed(beyond, 2), "left")
        assert left.count() == 6 - settled
        left = left.drop("m")
    to_hub, pairs, beyond = jaccard_join._beside_hubs(left, tokens, work, 85)
    assert [tuple(r) for r in to_hub.collect()] == [(8, 7)] and beyond.count() == 0


def test_index_finds_every_similar_pair():
    """The prefix scheme itself: similar sets share a key, whatever is frequent."""
    rng = np.random.default_rng(0)
    for trial in range(300):
        n = int(rng.integers(5, 150))
        a = rng.choice(2**60, n, replace=False).astype(np.uint64)
        b = a.copy()
        change = rng.choice(n, int(rng.integers(0, max(1, n // 8))), replace=False)
        b[change] = rng.choice(2**60, len(change)).astype(np.uint64)
        a, b = np.unique(a), np.unique(b)
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 85 * (len(a) + len(b) - shared):
            continue
        both = np.union1d(a, b)
        often = np.unique(rng.choice(both, int(len(both) * rng.random()), replace=False) >> np.uint64(24))
        known = often, rng.integers(3, 80, len(often))
        (s1, p1, _, _), (s2, p2, _, _) = (jaccard_join.index_keys(x, known, 85) for x in (a, b))
        assert len(np.intersect1d(s1, s2)) or len(np.intersect1d(p1, p2)), (trial, n)


def test_components_of_a_long_chain(shipped):
    rows = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 9)]
    random.Random(1).shuffle(rows)
    got = {r.node: r.root for r in jaccard_join.components(shipped.createDataFrame(rows, "a long, b long"), Workspace(shipped, "t")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, 7: 3, 9: 3}


def test_anchors_are_dealt_in_equal_shares():
    raw = np.random.default_rng(2).integers(97, 123, 400_000).astype(np.uint8).tobytes()
    h, lo, _, at = suffix_dedup.anchors(raw, np.array([0]), np.array([len(raw)]))
    for parts in (8, 50, 200):
        share = np.bincount((((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(int), minlength=parts)
        assert share.max() < 2 * share.mean() and share.min() > 0
    assert all(suffix_dedup._gram_hash(raw[a : a + suffix_dedup.GRAM]) == int(x) for a, x in zip(at[:50].tolist(), h[:50]))
