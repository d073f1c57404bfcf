"""Repeated byte strings, removed by a distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes covers it that also starts earlier
(smaller doc_id, or the same document and an earlier start), judged on the whole
input.

Sorting a suffix for every byte would move a hundred bytes for each. A window of
``length`` bytes is therefore represented by its anchor, the place of its
smallest hash of ``GRAM`` bytes; equal windows have equal anchors, and
neighbouring windows mostly share theirs. Windows in a row with one anchor are
one suffix: the text from the anchor on, then the text before it backwards.

1. Anchors whose hash occurs once cannot repeat. The hashes are dealt out and
   counted; what remains goes back to its document.
2. Each task sorts the suffixes of its remaining anchors, drops those equal to an
   earlier one of its own (their bytes are repeated already) and sends the rest
   as front-coded runs, sorted, without the prefix shared with the one before.
3. The runs of an anchor meet in one task. A loser tree merges them; it knows
   each contender's common prefix with the last winner, so two suffixes are only
   compared past what is known to be equal. Equal suffixes leave all but the
   earliest; unequal ones with one anchor are compared window by window.

Suffixes whose anchor is very frequent are sent window by window, dealt out by
the windows' own hashes, so no task gets all contexts of a common line.

Defined cases: a null or empty text has no bytes. A row with a null doc_id
removes nothing and loses nothing. Positions are (doc_id, start): of rows that
share a doc_id, a string at the same start in another row is not earlier.
Repeated rows get the same result each. Further columns are ignored by
``remove_repeats`` and kept by ``without_repeats``, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import column, free_name, map_arrow, release_memory, stage
from .exchange import by_bucket, decode, encode, gather, task_count

LENGTH = 100
GRAM = 32
#: An anchor met this often (by the reports of all tasks) has its windows sent
#: one by one; the most frequent 65,536 are, so the list has a bound.
HOT, MOST_HOT = 20_000, 1 << 16
#: Bytes laid end to end at a time (up to twice that), and bits that a place in them takes.
_PIECE, _PLACE_BITS = 1 << 18, 21
_FLUSH = 400_000
#: Suffixes that a task sorts at a time.
_RUN_ROWS = 150_000
_SIGN = 1 << 63
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def anchors(raw: bytes, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash, first window, last window, anchor) of each run of windows with one
    anchor, as positions in ``raw``, which holds the documents at
    ``starts``..``ends`` one after the other. No window leaves its document."""
    none = np.zeros(0, np.int64)
    width = length - GRAM + 1  # grams of a window
    n = len(raw) - GRAM + 1
    if len(raw) < length:
        return none.astype(np.uint64), none, none, none
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    h = eight[:n] * _M[0]
    for k in (1, 2, 3):
        h ^= h >> np.uint64(29)
        h += eight[8 * k : 8 * k + n]
        h *= _M[k]
    h ^= h >> np.uint64(32)
    # The place breaks ties, so the leftmost of equal grams is the anchor.
    # As many bits of the hash decide in every block, whatever its length.
    if n >> _PLACE_BITS:
        raise ValueError("a block is too long")
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keyed = (h & ~low) | np.arange(n, dtype=np.uint64)
    full = -(-n // width) * width
    grid = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = keyed
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = len(raw) - length + 1
    at = (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & low).astype(np.int64)
    valid = np.zeros(windows + 1, np.int32)
    has = ends - starts >= length
    np.add.at(valid, starts[has], 1)
    np.add.at(valid, np.minimum(ends[has] - length + 1, windows), -1)
    valid = valid.cumsum()[:-1] > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    # A document that begins right where windows of the one before end.
    first = starts[has]
    new[first] = True
    lo = np.flatnonzero(new)
    stop = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
    # The least hash of a window is a small number: multiplied, all numbers are as
    # likely, and buckets by the high bits get equal shares.
    return h[at[lo]] * _M[1], lo, stop, at[lo]


def pieces(docs: list[tuple[int, bytes]], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents laid end to end in blocks of _PIECE bytes or more: the bytes, and each
    part's start, end, document number and offset in its document. Long
    documents are cut so that every window lies in one part."""
    held, size = [], 0
    for k, (_, raw) in enumerate(docs):
        for off in range(0, max(1, len(raw) - length + 1), _PIECE):
            part = raw[off : off + _PIECE + length - 1]
            held.append((part, k, off))
            size += len(part)
            if size >= _PIECE:
                yield _laid(held)
                held, size = [], 0
    if held:
        yield _laid(held)


def _laid(held):
    ends = np.cumsum([len(p) for p, _, _ in held])
    starts = ends - np.array([len(p) for p, _, _ in held])
    return b"".join(p for p, _, _ in held), starts, ends, np.array([k for _, k, _ in held]), np.array([o for _, _, o in held])


def _doc_bucket(doc: np.ndarray, n: int) -> np.ndarray:
    return ((doc * _M[0]) >> np.uint64(40)) % np.uint64(n)


def _candidates(docs: DataFrame, parts: int, length: int) -> DataFrame:
    """bucket, blob: (doc, place) of the anchors that may repeat, by document
    bucket; bucket -1 has (hash, count) of the frequent anchors."""
    buckets = parts

    def report(batches):
        """Anchors met once by this task, and one of each met more often, go to
        their hash's bucket; the rest are known to repeat and go to their
        document's bucket, after the hash buckets."""
        def flush():
            h, doc, place = (np.concatenate(v) for v in zip(*held))
            order = np.argsort(h, kind="stable")
            h, doc, place = h[order], doc[order], place[order]
            first = np.concatenate([[True], h[1:] != h[:-1]])
            times = np.diff(np.append(np.flatnonzero(first), len(h)))
            count = np.repeat(times, times)
            bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            out = by_bucket(bucket[first], h[first], doc[first], place[first], count[first])
            again = count > 1
            d, p = doc[again], place[again]
            order = np.lexsort((d, _doc_bucket(d, buckets)))
            d, p = d[order], p[order]
            # Documents ascend within a bucket only, so each bucket is sorted.
            more = by_bucket(_doc_bucket(d, buckets).astype(np.int64) + buckets, d, p)
            return {k: out[k] + more[k] for k in out}

        release_memory()
        held, size = [], 0
        for b in batches:
            rows = [(d, (t or "").encode()) for d, t in zip(column(b, "doc_id"), column(b, "text"))]
            ids = np.array([d for d, _ in rows], np.int64).astype(np.uint64) + np.uint64(_SIGN)
            for raw, starts, ends, number, offset in pieces(rows, length):
                h, lo, hi, at = anchors(raw, starts, ends, length)
                k = np.searchsorted(starts, lo, "right") - 1
                place = ((lo - starts[k] + offset[k]) << 14) | ((hi - lo) << 7) | (at - lo)
                held.append((h, ids[number[k]], place.astype(np.uint64)))
                size += len(h)
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def judge(bucket, blobs):
        if bucket >= buckets:
            for x in blobs:
                yield tuple(decode(x, 2))
            return
        release_memory()
        h, doc, place, count = (np.concatenate(v) for v in zip(*(decode(x, 4) for x in blobs)))
        order = np.argsort(h, kind="stable")
        h, doc, place, count = h[order], doc[order], place[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        total = np.add.reduceat(count, first)
        many = np.repeat(total, np.diff(np.append(first, len(h)))) > 1
        hot = total >= HOT
        if hot.any():
            yield h[first][hot], total[hot], True
        yield doc[many & (count == 1)], place[many & (count == 1)]

    def send(found):
        out = {"bucket": [], "blob": []}
        for h, total, _ in (x for x in found if len(x) == 3):
            out["bucket"].append(-1)
            out["blob"].append(encode(h, total))
        plain = [x for x in found if len(x) == 2]
        if not plain:
            return out
        d, p = (np.concatenate(c) for c in zip(*plain))
        if not len(d):
            return out
        order = np.lexsort((d, _doc_bucket(d, buckets)))
        d, p = d[order], p[order]
        more = by_bucket(_doc_bucket(d, buckets).astype(np.int64), d, p)
        return {k: out[k] + more[k] for k in out}

    dealt = map_arrow(docs, ["doc_id", "text"], "bucket int, blob binary", report)
    return stage(gather(dealt, parts, "bucket int, blob binary", judge, send), "anchors")


def _per_document(dealt: DataFrame, parts: int, schema: str, n_columns: int, make) -> DataFrame:
    """A row for each document from blobs dealt by document bucket."""

    def run(bucket, blobs):
        cols = [np.concatenate(v) for v in zip(*(decode(x, n_columns) for x in blobs))]
        order = np.lexsort(cols[::-1])
        cols = [c[order] for c in cols]
        cuts = np.flatnonzero(np.diff(cols[0])) + 1
        lows, highs = np.append(0, cuts).tolist(), np.append(cuts, len(cols[0])).tolist()
        ids = (cols[0] - np.uint64(_SIGN)).astype(np.int64).tolist()
        for k in range(0, len(lows), 2000):
            rows = [(ids[lo], make(*(c[lo:hi] for c in cols[1:]))) for lo, hi in zip(lows[k : k + 2000], highs[k : k + 2000])]
            yield {"doc_id": [r[0] for r in rows], schema: [r[1] for r in rows]}

    return gather(dealt, parts, f"doc_id long, {schema} binary", run)


# -- runs of suffixes -----------------------------------------------------------


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(run: list[tuple]) -> bytes:
    """A sorted run of (suffix, forward, doc, anchor, tie) as one blob: for each
    suffix what it shares with the one before, and only the rest of its bytes."""
    texts = [r[0] for r in run]
    shared = [0] + [common_prefix(a, b) for a, b in zip(texts, texts[1:])]
    numbers = encode(
        np.arange(len(run)), np.array(shared), np.array([len(t) for t in texts]), *(np.array([r[k] for r in run], np.uint64) for k in (1, 2, 3, 4))
    )
    return struct.pack("<I", len(numbers)) + numbers + b"".join(t[s:] for t, s in zip(texts, shared))


def front_decode(blob: bytes) -> Iterator[tuple]:
    """(suffix, bytes shared with the one before, forward, doc, anchor, tie)."""
    size = struct.unpack_from("<I", blob)[0]
    cols = [c.tolist() for c in decode(blob[4 : 4 + size], 7)]
    at, text = 4 + size, b""
    for shared, n, *rest in zip(*cols[1:]):
        text = text[:shared] + blob[at : at + n - shared]
        at += n - shared
        yield (text, shared, *rest)


def merge_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Sorted merge by a loser tree. Each contender keeps the length of its
    common prefix with the last winner: the longer one comes first, and only
    equal ones are compared, from there on. The second field of what comes out
    is the prefix shared with the suffix before it."""
    n = 1
    while n < len(runs):
        n *= 2
    item: list[tuple | None] = [next(r, None) for r in runs] + [None] * (n - len(runs))
    known = [0] * n

    def beats(a: int, b: int) -> bool:
        """Does a come before b? Sets the loser's common prefix with the winner."""
        x, y = item[a], item[b]
        if x is None or y is None:
            return y is None
        if known[a] != known[b]:
            return known[a] > known[b]
        k = common_prefix(x[0], y[0], known[a])
        if x[0][k:] <= y[0][k:]:
            known[b] = k
            return True
        known[a] = k
        return False

    losers = [0] * n

    def play(node: int) -> int:
        if node >= n:
            return node - n
        a, b = play(2 * node), play(2 * node + 1)
        won, lost = (a, b) if beats(a, b) else (b, a)
        losers[node] = lost
        return won

    top = play(1) if n > 1 else 0
    while item[top] is not None:
        out = item[top]
        yield (out[0], known[top], *out[2:])
        item[top] = nxt = next(runs[top], None)
        known[top] = nxt[1] if nxt is not None else 0
        node = (top + n) // 2
        while node:
            rival = losers[node]
            if beats(rival, top):
                losers[node], top = top, rival
            node //= 2


def settle(merged: Iterator[tuple], length: int) -> Iterator[tuple[int, int, int, int]]:
    """(doc, tie, start, end) of the strings that are repeated, from suffixes in
    order. Suffixes of one anchor share its gram, so they come in a row."""
    group: list[list[tuple]] = []  # of equal suffixes: (suffix, forward, doc, anchor, tie)

    def close():
        if len(group) == 1 and len(group[0]) == 1:
            return
        first = []
        for same in group:
            low = min(x[2:4] for x in same)
            for text, forward, doc, at, tie in same:
                if (doc, at) > low:
                    start = at - (len(text) - forward)
                    yield doc, tie, start, start + len(text)
                else:
                    first.append((doc, at, tie, text, forward))
        if len(group) < 2:
            return
        seen: dict[bytes, tuple] = {}
        for doc, at, tie, text, forward in sorted(first):
            whole = text[forward:][::-1] + text[:forward]
            start = at - (len(text) - forward)
            found = []
            for i in range(len(whole) - length + 1):
                # The anchor's place in the window belongs to the window: equal
                # windows of one anchor have it at the same place.
                before = seen.setdefault(whole[i : i + length], (doc, at))
                if before < (doc, at):
                    found.append(i)
            for _, row in groupby(enumerate(found), lambda x: x[1] - x[0]):
                row = [i for _, i in row]
                yield doc, tie, start + row[0], start + row[-1] + length

    last = None
    for text, shared, forward, doc, at, tie in merged:
        new = (text, forward, doc, at, tie)
        if last is None or shared < min(GRAM, len(text), len(last[0])):
            yield from close()
            group = [[new]]
        elif shared == len(text) == len(last[0]) and forward == last[1]:
            group[-1].append(new)
        else:
            # Equal bytes with another split into forward and backward parts.
            same = next((g for g in group if g[0][:2] == new[:2]), None) if shared == len(text) == len(last[0]) else None
            if same:
                same.append(new)
            else:
                group.append([new])
        last = new
    yield from close()


def _spans_by_doc(found: list[tuple[int, int, int, int]], buckets: int) -> dict:
    """Blobs of (doc, start, end, tie) by document bucket, joined where they touch."""
    rows = []
    for doc, tie, lo, hi in sorted(found):
        if rows and rows[-1][:2] == [doc, tie] and lo <= rows[-1][3]:
            rows[-1][3] = max(rows[-1][3], hi)
        else:
            rows.append([doc, tie, lo, hi])
    if not rows:
        return {"bucket": [], "blob": []}
    doc, tie, lo, hi = (np.array(c, np.uint64) for c in zip(*rows))
    order = np.lexsort((doc, _doc_bucket(doc, buckets)))
    doc, tie, lo, hi = doc[order], tie[order], lo[order], hi[order]
    return by_bucket(_doc_bucket(doc, buckets).astype(np.int64), doc, tie, lo, hi)


def _tie(raw: bytes) -> int:
    """Tells rows that share a doc_id apart."""
    return xxhash.xxh3_64_intdigest(raw) & 0xFFFF


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, spans: for each document with a repeated string, (tie, start, end)
    triples as a blob; spans may touch."""
    parts = task_count(docs)
    buckets = parts
    known = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    found = _candidates(known, parts, length)
    hot: dict[int, int] = {}
    for r in found.where("bucket = -1").select("blob").toLocalIterator():
        h, n = decode(r.blob, 2)
        hot |= dict(zip(h.tolist(), n.tolist()))
        if len(hot) > 2 * MOST_HOT:
            hot = dict(sorted(hot.items(), key=lambda x: (-x[1], x[0]))[:MOST_HOT])
    frequent = docs.sparkSession.sparkContext.broadcast(frozenset(sorted(hot, key=lambda h: (-hot[h], h))[:MOST_HOT]))
    places = _per_document(found.where("bucket >= 0"), parts, "places", 2, lambda p: p.astype("<u8").tobytes())
    joined = known.join(places, "doc_id")

    def sort_runs(batches):
        """Sorted runs by anchor bucket, and this task's own repeats by document
        bucket after them."""
        hot = frequent.value
        own: dict[tuple, list] = {}
        size = 0

        def flush():
            repeats, runs = [], {}
            for (text, forward, bucket), entries in own.items():
                low = min(e[:2] for e in entries)
                kept = {e for e in entries if e[:2] == low}
                start = len(text) - forward
                repeats += [(d, t, a - start, a - start + len(text)) for d, a, t in entries if (d, a) != low]
                runs.setdefault(bucket, []).extend((text, forward, *e) for e in kept)
            out = {"bucket": list(runs), "blob": [front_code(sorted(r)) for r in runs.values()]}
            more = _spans_by_doc(repeats, buckets)
            return {"bucket": out["bucket"] + [b + buckets for b in more["bucket"]], "blob": out["blob"] + more["blob"]}

        release_memory()
        for b in batches:
            for doc, text, where in zip(column(b, "doc_id"), column(b, "text"), column(b, "places")):
                raw, doc = text.encode(), doc + _SIGN
                tie = _tie(raw)
                for p in np.frombuffer(where, "<u8").tolist():
                    lo = p >> 14
                    hi, at = lo + (p >> 7 & 127), lo + (p & 127)
                    whole = raw[lo : hi + length]
                    if len(whole) < hi - lo + length:
                        continue  # a place of another row with this doc_id
                    gram = whole[at - lo : at - lo + GRAM]
                    if hot and _gram_hash(gram) in hot:
                        for i in range(hi - lo + 1):
                            # A window of its own: its anchor becomes its start.
                            w = whole[i : i + length]
                            own.setdefault((w, length, xxhash.xxh3_64_intdigest(w) % buckets), []).append((doc, lo + i, tie))
                    else:
                        text_from = raw[at : hi + length] + raw[lo:at][::-1]
                        key = (text_from, hi + length - at, xxhash.xxh3_64_intdigest(gram) % buckets)
                        own.setdefault(key, []).append((doc, at, tie))
                    size += 1
                if size >= _RUN_ROWS:
                    yield flush()
                    own, size = {}, 0
        if size:
            yield flush()

    def merge(bucket, blobs):
        if bucket >= buckets:
            for x in blobs:
                doc, tie, lo, hi = decode(x, 4)
                yield doc, tie, lo, hi
            return
        held = []
        for row in settle(merge_runs([front_decode(x) for x in blobs]), length):
            held.append(row)
            if len(held) >= 200_000:
                yield tuple(np.array(c, np.uint64) for c in zip(*held))
                held = []
        if held:
            yield tuple(np.array(c, np.uint64) for c in zip(*held))

    def send(found):
        return _spans_by_doc(list(zip(*(np.concatenate(c).tolist() for c in zip(*found)))), buckets)

    runs = map_arrow(joined, ["doc_id", "text", "places"], "bucket int, blob binary", sort_runs)
    merged = gather(runs, parts, "bucket int, blob binary", merge, send)
    return _per_document(merged, parts, "spans", 4, lambda *c: np.stack(c, 1).astype("<u8").tobytes())


def _gram_hash(gram: bytes) -> int:
    h = 0
    mask = 2**64 - 1
    words = struct.unpack("<4Q", gram)
    h = words[0] * int(_M[0]) & mask
    for k in (1, 2, 3):
        h ^= h >> 29
        h = (h + words[k] & mask) * int(_M[k]) & mask
    return (h ^ h >> 32) * int(_M[1]) & mask


def kept_bytes(raw: bytes, spans: bytes | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    if not spans:
        return raw, 0
    tie, out, at, runs = _tie(raw), [], 0, 0
    end = -1
    for t, lo, hi in np.frombuffer(spans, "<u8").reshape(-1, 3).tolist():
        if t != tie:
            continue
        if lo > end:
            out.append(raw[at:lo])
            runs += 1
        end = max(end, hi)
        at = end
    out.append(raw[at:])
    return b"".join(out), runs


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    joined = docs.select("doc_id", "text").join(repeated_spans(docs, length), "doc_id", "left")

    def run(batches):
        for b in batches:
            out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for doc, text, spans in zip(column(b, "doc_id"), column(b, "text"), column(b, "spans")):
                raw = (text or "").encode()
                kept, runs = kept_bytes(raw, spans)
                for k, v in zip(out, (doc, len(raw), len(raw) - len(kept), runs, sha256(kept).hexdigest())):
                    out[k].append(v)
            yield out

    return map_arrow(joined, ["doc_id", "text", "spans"], "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", run)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with what is left of each text. Bytes of a character that was
    cut in two go too, as a text holds whole characters."""
    doc, found = (free_name(docs, n) for n in ("_doc", "_spans"))
    spans = repeated_spans(docs, length).select(F.col("doc_id").alias(doc), F.col("spans").alias(found))
    joined = docs.join(spans, docs["doc_id"] == F.col(doc), "left")

    @F.pandas_udf("string")
    def kept(text: pd.Series, blob: pd.Series) -> pd.Series:
        return pd.Series([
            t if s is None or t is None else kept_bytes(t.encode(), s)[0].decode(errors="ignore") for t, s in zip(text, blob)
        ], dtype=object)

    return joined.withColumn("text", kept("text", F.col(found))).select(*docs.columns)
