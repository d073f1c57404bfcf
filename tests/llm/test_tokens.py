"""Encoding, token files, the trie codec and packing against the library."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from shelfcast.llm import bpe_trie, packing, token_files, tokens  # noqa: E402
from shelfcast.llm.common import scratch  # noqa: E402

from .conftest import ODD_TEXTS  # noqa: E402

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LIB = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def ids_of(path, text):
    return LIB[path].encode(text or "", add_special_tokens=False).ids


def random_texts(seed, n=1500):
    r = random.Random(seed)
    parts = [*"aabbcdeTHIS  ..,,''!%$\n\n\t 0123²½éÉßñΣσ́\x1c\x85 　日本🙂‍<|>_-—", "'s", "'ll", " the", "İ", "<|endoftext|>"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path,byte_level", [(BYTE, True), (WORD, False)])
def test_encoder_equals_the_library(path, byte_level):
    texts = random_texts(3) + [t or "" for t in ODD_TEXTS]
    enc = tokens.TextEncoder(path, byte_level, cache=500)  # small, so that entries are forgotten
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [ids_of(path, t) for t in texts]


def test_words_after_line_feeds_and_at_the_start():
    words = ["Word", "word.", "it's", "'s", "x,", "a1", "é", "don't!", "<|endoftext|>", "_", "A" * 50, "end)"]
    r = random.Random(8)
    texts = ["\n".join(" ".join(r.choices(words, k=r.randint(1, 3))) for _ in range(r.randint(1, 6))) for _ in range(400)]
    for path, byte_level in ((BYTE, True), (WORD, False)):
        enc = tokens.TextEncoder(path, byte_level, cache=20)
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [ids_of(path, t) for t in texts]


def test_short_batches_are_joined_in_order():
    import pyarrow as pa

    from shelfcast.llm.common import joined

    batches = [pa.record_batch({"x": ["a" * n] * 3}) for n in (1, 500, 2, 9000, 1, 1)]
    out = list(joined(iter(batches), 2000))
    assert [v for b in out for v in b.column(0).to_pylist()] == [v for b in batches for v in b.column(0).to_pylist()]
    assert len(out) == 3 and not list(joined(iter([]), 10))


def test_short_batches_are_gone_while_the_joined_one_is_in_use():
    import weakref

    import pyarrow as pa

    from shelfcast.llm.common import joined

    alive = weakref.WeakValueDictionary()

    def batches():
        for k in range(6):
            b = pa.record_batch({"x": [str(k) * 1000]})
            alive[k] = b
            yield b
            b = None

    # The batch that did not fit any more is there, and none at the end.
    assert [len(alive) for _ in joined(batches(), 2500)] == [1, 1, 0]


def test_packing_holds_small_blocks_and_few_words(monkeypatch):
    import pyarrow as pa

    held, numbered = [], tokens.numbered
    monkeypatch.setattr(tokens, "numbered", lambda lists, *a: held.append(sum(map(len, lists.flatten().to_pylist()))) or numbered(lists, *a))
    texts = [" ".join(f"word{k} x{k * k}" for k in range(lo, lo + 50)) for lo in range(0, 2000, 50)]
    enc = tokens.encoder(WORD, False, 300)
    try:
        got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode(pa.array(texts), 2000)]
    finally:
        tokens.kept.__globals__["_KEPT"].pop((WORD, False, 300))
    assert got == [ids_of(WORD, t) for t in texts]
    assert max(held) <= 2000 and len(enc.cache.young) + len(enc.cache.old) < 2 * (300 + 400)
    assert packing.BLOCK < tokens.BLOCK and packing.WORDS < tokens.CACHE


MODEL = bpe_trie.TrieBPE(WORD, cache=500)


def check_trie(texts):
    for t, (n, ids, decoded) in zip(texts, MODEL.encode(texts)):
        want = ids_of(WORD, t)
        assert (n, ids) == (len(want), " ".join(map(str, want)))
        assert decoded == LIB[WORD].decode(want, skip_special_tokens=False)


def test_trie_equals_the_library():
    check_trie(random_texts(4) + [t or "" for t in ODD_TEXTS])


@given(st.lists(st.text(alphabet="abcdeéthing ", max_size=25), max_size=8))
@settings(max_examples=60, deadline=None)
def test_trie_on_shared_prefixes(texts):
    check_trie(texts)


def test_codec_query_rows(frame):
    rows = list(enumerate(ODD_TEXTS)) + [(1, ""), (None, "null id"), (7, ODD_TEXTS[7])]
    got = bpe_trie.encode_decode(frame(rows), WORD).collect()
    want = []
    for i, t in rows:
        ids = ids_of(WORD, t)
        d = LIB[WORD].decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(d.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe_trie.encode_decode(frame([]), WORD).count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 3, 10, 1000):
        keys = np.random.default_rng(n).choice(10**12, n, replace=False) - 10**6
        seeds, slots = token_files.build_index(keys)
        assert sorted(slots.tolist()) == list(range(n))
        row = token_files.make_shard([(int(k), bytes(4)) for k in np.sort(keys)], 0, 0, 0, 2)
        shard = token_files.Shard(row)
        assert sorted(shard.slot(keys).tolist()) == list(range(n)) if n else True


def test_token_files_round_trip(frame, shipped):
    rows = [(i * 7 % 101 - 50, t) for i, t in enumerate(ODD_TEXTS * 3 + random_texts(5, 70))] + [(None, "no key"), (-50, "again"), (-50, "again")]
    docs = frame(rows)
    path = token_files.write(docs, scratch(shipped, "t"), BYTE, shard_bytes=600)
    got = [tuple(r) for r in token_files.read(shipped, path).collect()]
    want, start = [], 0
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda x: (x[0], x[1] is not None, (x[1] or "").encode())):
        ids = ids_of(BYTE, t) + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got) == sorted(want)
    asked = {i: [] for i in (3, -50, 10**9, -(10**9))}
    for r in token_files.lookup(shipped, path, list(asked)).collect():
        asked[r.doc_id].append(r.ids)
    for i, found in asked.items():
        assert sorted(found) == sorted(ids_of(BYTE, t) + [2] for j, t in rows if j == i)
    assert token_files.write_and_read(frame([]), BYTE).count() == 0


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=150, deadline=None)
def test_two_fit_packs_everything_without_overlap(lengths):
    arr = np.array(lengths, np.int64)
    bins, offsets = packing.pack_two_fit(arr, 50)
    used = {}
    for b, o, n in sorted(zip(bins.tolist(), offsets.tolist(), lengths)):
        assert used.get(b, 0) == o
        used[b] = o + n
    assert all(v <= 50 for v in used.values())
    assert len(used) <= 2 * -(-sum(lengths) // 50) + 1


def test_two_fit_replaces_the_smallest_by_a_tighter_pair():
    # Greedy: 60+30 and gap 10; the pair 25+15 fills the 40 that 30 leaves.
    bins, _ = packing.pack_two_fit(np.array([60, 30, 25, 15]), 100)
    assert sorted(np.bincount(bins, [60, 30, 25, 15]).tolist()) == [30, 100]


def test_packing_rows(frame):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "null id"), (5, ODD_TEXTS[5])]
    got = packing.pack_documents(frame(rows), WORD, size=64).collect()
    want = []
    for i, t in rows:
        ids = ids_of(WORD, t) + [0]
        want += [(i, k, lo, len(ids[lo : lo + 64]), zlib.crc32(np.array(ids[lo : lo + 64], "<u4").tobytes())) for k, lo in enumerate(range(0, len(ids), 64))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    assert packing.pack_documents(frame([]), WORD).count() == 0


def test_packing_groups_stay_near_the_bound(shipped):
    rng = np.random.default_rng(0)
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(rng.integers(1, 2048, 3000))]
    df = shipped.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df, group_rows=1500).groupBy("sequence_id").sum("length").collect()
    assert len(got) <= 1.03 * -(-sum(r[3] for r in rows) // 2048)


@pytest.mark.parametrize("path, byte_level", [(BYTE, True), (WORD, False)])
def test_a_word_is_encoded_once_whatever_marks_follow(path, byte_level):
    words = ["river", "Übung", "été", "x1", "日本", "İx", "12", "don't", "a_b", "½", "ét"]
    marks = ["", ".", ",", "###", "$$$", "*.", "<|", "<|endoftext|>", "'", "'s.", "_", "·", ")́", "≠"]
    chunks = [w + m for w in words for m in marks]
    texts = ["start " + " ".join(chunks), "start " + "\n".join(chunks), "start " + " ".join(chunks[::-1]) + " end"]
    enc = tokens.TextEncoder(path, byte_level)
    want = [ids_of(path, t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want
    known = set(enc.cache.young)
    assert "river" in known and not {"river.", "river,", "river###", "Übung$$$"} & known


def test_a_worker_lets_go_of_what_its_tasks_stopped_using(frame, shipped):
    from shelfcast.llm import common

    made = []
    common.kept("k", lambda: made.append(1) or "model")
    common._let_go()
    assert common.kept("k", lambda: made.append(1) or "model") == "model" and len(made) == 1
    common._let_go()
    common._let_go()
    assert "k" not in common._KEPT

    def asks(batches):
        for b in batches:
            tokens.encoder(BYTE, True)
            yield {"n": [int((BYTE, True) in common._KEPT)]}

    def looks(batches):
        for b in batches:
            yield {"n": [len(common._KEPT)]}

    docs = frame([(1, "a")]).coalesce(1)
    assert common.map_arrow(docs, ["text"], "n int", asks).collect()[0].n == 1
    # Idle workers take turns; each lets go at the end of its first task that does not ask.
    seen = [common.map_arrow(docs, ["text"], "n int", looks).collect()[0].n for _ in range(25)]
    assert seen[-1] == 0
