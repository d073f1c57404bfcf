"""N-gram Jaccard self-join by token-combination prefixes.

A document is the set of its distinct word shingles, here called tokens. All
tokens have one order, by how many documents hold them, the fewest first; from
``FREQUENT_FROM`` documents on a token is frequent, below it is rare. Two sets of similarity t or more share, among the first
``n - ceil(t n) + 1 + G`` tokens of each, at least ``1 + G`` tokens. Frequent
tokens are split into G classes. So two such sets share either a rare token of
those prefixes, or, if all of the ``1 + G`` are frequent, two of one class. The
index therefore holds rare tokens one by one and frequent tokens in pairs within
their class, and a set with fewer than ``1 + G`` frequent tokens in its prefix
needs no pairs. Sets too small for that arithmetic are indexed by the single
tokens of the plain prefix.

Equal sets are one class. Sets that meet in small index groups are counted pair
by pair, and verified if they can share enough of their prefixes: what they share
in small groups is known, and in others there is no more than either set has
there. The sets of a large group are not paired with each other: each is verified
against the group's hub, the set with the fewest rare tokens, the verified links
are joined to components, and only what could still link two components is
verified in a second round. What cannot is told by exact
bounds: the sizes; the distances to a common hub (Jaccard distance obeys the
triangle inequality); and, for groups of frequent pairs, the counts of rare
tokens, as sets that share a rare token meet in that token's group. Members of
groups of more than ``MANY`` sets are not paired for that: ``_beside_hubs`` finds
the pairs by the tokens in which they differ from the hub, and what is too far
from it gets another hub.

Defined cases: a null or empty text has no set, zero shingles and itself as
component. A text of fewer words than a shingle has one. Each row is a document
of its own; rows that share a doc_id may be in one component or two. A row with
a null doc_id links nothing and has a null component. Further columns are
ignored. Tokens are 64-bit hashes of shingles.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Workspace, column, map_arrow, stage, texts
from .exchange import by_bucket, decode, encode, gather, task_count

#: Tokens are ordered by their document counts from this count on, and from the
#: second one on are frequent. At most ``MOST_COUNTED`` tokens, the ones in most
#: documents, have a known count; that list is broadcast: 32 MB at most, whatever
#: the input. The others count as held by one document.
COUNTED_FROM, FREQUENT_FROM = 3, 32
MOST_COUNTED = 1 << 21
CLASSES = 16
#: Up to so many candidate ids are broadcast to the scan of the texts; more are
#: joined by a shuffle.
BROADCAST_IDS = 500_000
_FLUSH = 3_000_000

_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def shingles(text: str, n: int = 4) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's n-word shingles."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    seen: dict[bytes, int] = {}
    ids = [seen.setdefault(w, len(seen)) for w in words]
    hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in seen], np.uint64)[ids]
    size = len(words) - n + 1
    total = np.zeros(size, np.uint64)
    for i in range(n):
        total = scramble(total * _M[i % 8] + hashed[i : i + size])
    return np.unique(total)


def _short(tokens: np.ndarray) -> np.ndarray:
    """40 bits of a token: what its document count is kept by."""
    return tokens >> np.uint64(24)


def counted_tokens(docs: DataFrame, work: Workspace, n: int = 4, least: int = COUNTED_FROM, most: int = MOST_COUNTED) -> tuple[np.ndarray, np.ndarray]:
    """The 40 bits in order of tokens that several documents hold, and how many
    do, counted over all documents."""
    parts = task_count(docs)
    buckets = parts

    def count(batches):
        def flush():
            v, c = np.unique(np.concatenate(held), return_counts=True)
            bucket = (v * np.uint64(buckets)) >> np.uint64(40)
            return by_bucket(bucket, v, c)

        held, size = [], 0
        for b in batches:
            for t in texts(b):
                held.append(_short(shingles(t, n)))
                size += len(held[-1])
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def total(bucket, blobs):
        """A blob for each power of two of the count, so that a lower bound can
        be chosen before anything is read."""
        cols = [decode(x, 2) for x in blobs]
        v = np.concatenate([c[0] for c in cols])
        kinds, at = np.unique(v, return_inverse=True)
        df = np.bincount(at, np.concatenate([c[1] for c in cols]).astype(float)).astype(np.int64)
        level = np.where(df >= least, np.log2(np.maximum(df, 1)).astype(np.int64), -1)
        for k in np.unique(level[level >= 0]).tolist():
            here = level == k
            yield {"level": [k], "tokens": [int(here.sum())], "blob": [encode(kinds[here], df[here])]}

    dealt = map_arrow(docs, ["text"], "bucket int, blob binary", count)
    counted = work.stage(gather(dealt, parts, "level int, tokens long, blob binary", total), "counted")
    room, lowest = most, 64
    for r in sorted(counted.groupBy("level").agg(F.sum("tokens").alias("n")).collect(), reverse=True):
        room -= r.n
        if room < 0:
            break
        lowest = r.level
    held = [decode(r.blob, 2) for r in counted.where(F.col("level") >= lowest).select("blob").toLocalIterator()]
    if not held:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    token, df = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(token)
    return token[order], df[order].astype(np.int32)


def index_keys(tokens: np.ndarray, counted: tuple[np.ndarray, np.ndarray], percent: int, classes: int = CLASSES, frequent_from: int = FREQUENT_FROM) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The single keys and the pair keys of a set, its count of rare tokens, and
    how many frequent ones its prefix has."""
    n = len(tokens)
    if not n:
        return tokens, tokens, 0, 0
    known, counts = counted
    df = np.zeros(n, np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, _short(tokens)), len(known) - 1)
        df = np.where(known[at] == _short(tokens), counts[at], 0)
    order = np.lexsort((tokens, df))
    tokens, df = tokens[order], df[order]
    rare = int((df < frequent_from).sum())
    plain = n - (percent * n + 99) // 100 + 1
    # From this size on, sets that link share more than ``classes`` tokens.
    enough = -(-(100 * classes + 1) // percent)
    singles, pairs, frequent = [], np.zeros(0, np.uint64), 0
    if percent * n <= 100 * enough:
        singles.append(tokens[:plain])
    if n >= enough:
        prefix, often = tokens[: plain + classes], df[: plain + classes] >= frequent_from
        singles.append(prefix[~often])
        frequent = int(often.sum())
        if often.sum() > classes:
            some = np.sort(prefix[often])
            kind = (scramble(some) % np.uint64(classes)).astype(np.int64)
            made = []
            for k in range(classes):
                c = some[kind == k]
                if len(c) > 1:
                    i, j = np.triu_indices(len(c), 1)
                    made.append(scramble(c[i] * _M[0] + scramble(c[j])))
            if made:
                pairs = np.concatenate(made)
    return np.unique(np.concatenate(singles)) if singles else tokens[:0], pairs, rare, frequent


def _signatures(docs: DataFrame, work: Workspace, counted, percent: int, n: int) -> DataFrame:
    spread = docs.sparkSession.sparkContext.broadcast(counted)

    def run(batches):
        known = spread.value
        for b in batches:
            out = {k: [] for k in ("doc_id", "n", "fp1", "fp2", "rare", "often", "singles", "pairs")}
            for doc, t in zip(column(b, "doc_id"), texts(b)):
                s = shingles(t, n)
                singles, pairs, rare, often = index_keys(s, known, percent) if doc is not None else (s[:0], s[:0], 0, 0)
                fp = xxhash.xxh3_128_intdigest(s.tobytes())
                row = (doc, len(s), (fp >> 64) - (1 << 63), (fp & (2**64 - 1)) - (1 << 63), rare, often, singles.tobytes(), pairs.tobytes())
                for k, v in zip(out, row):
                    out[k].append(v)
            yield out

    signed = map_arrow(docs, ["doc_id", "text"], "doc_id long, n long, fp1 long, fp2 long, rare long, often long, singles binary, pairs binary", run)
    # Numbered once written, so that a row keeps its number however often it is read.
    written = work.stage(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
    spread.destroy()
    return written


#: Index groups of up to so many sets are listed as pairs.
SMALL = 8
#: Open groups of up to so many sets are joined with themselves in round two.
MANY = 64
#: A hub settles the sets of larger ones up to this Jaccard distance.
REACH = 0.5
# What a row (kind, x, y, c) of the members table says.
PAIR, GROUP, IN_LARGE, IN_SMALL, COMBINED = range(5)


def _groups(sets: DataFrame, parts: int) -> DataFrame:
    """(kind, x, y, c) rows about the index groups of two or more sets:

    PAIR      sets x and y share c tokens of small groups
    COMBINED  sets x and y share a pair key in a small group
    GROUP     large group x has set y; c is 1 for a group of a pair key. Groups
              of the same members within a bucket are listed once.
    IN_LARGE, IN_SMALL   set x has c single tokens in such groups
    """
    buckets = parts

    def keys(batches):
        def flush():
            key, cid = (np.concatenate(v) for v in zip(*held))
            order = np.argsort(key, kind="stable")
            key = key[order]
            return by_bucket((key * np.uint64(buckets)) >> np.uint64(48), key, cid[order])

        held, size = [], 0
        for b in batches:
            for cid, singles, pairs in zip(*(column(b, c) for c in ("cid", "singles", "pairs"))):
                # 48 bits of each key, of which the lowest tells pairs from
                # single tokens. Keys that fall together only add candidates.
                s = np.frombuffer(singles, np.uint64) >> np.uint64(16) & ~np.uint64(1)
                p = np.frombuffer(pairs, np.uint64) >> np.uint64(16) | np.uint64(1)
                k = np.concatenate([s, p])
                held.append((k, np.full(len(k), cid, np.uint64)))
                size += len(k)
            if size >= _FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def members(bucket, blobs):
        key, cid = (np.concatenate(v) for v in zip(*(decode(x, 2) for x in blobs)))
        order = np.lexsort((cid, key))
        key, cid = key[order], cid[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        combined = (key[first] & np.uint64(1)).astype(bool)
        small = (size > 1) & (size <= SMALL)
        rows = []
        for is_pair, kind in ((False, PAIR), (True, COMBINED)):
            found = []
            for m in range(2, SMALL + 1):
                lo = first[small & (size == m) & (combined == is_pair)]
                i, j = np.triu_indices(m, 1)
                found.append(np.stack([cid[lo[:, None] + j].ravel(), cid[lo[:, None] + i].ravel()], 1))
            both, times = np.unique(np.concatenate(found), axis=0, return_counts=True)
            rows.append((np.full(len(both), kind), both[:, 0], both[:, 1], times))
        each = np.repeat(size, size)
        single = ~np.repeat(combined, size)
        for where, kind in ((each > SMALL, IN_LARGE), ((each > 1) & (each <= SMALL), IN_SMALL)):
            who, times = np.unique(cid[where & single], return_counts=True)
            rows.append((np.full(len(who), kind), who, np.zeros(len(who)), times))
        seen, starts = set(), []
        for lo, m in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
            sign = (int(key[lo]) & 1, xxhash.xxh3_128_digest(cid[lo : lo + m].tobytes()))
            if sign not in seen:
                seen.add(sign)
                starts.append((lo, m))
        if starts:
            at = np.concatenate([np.arange(lo, lo + m) for lo, m in starts])
            gid = np.repeat(np.arange(len(starts)), [m for _, m in starts]) + (bucket << 40)
            rows.append((np.full(len(at), GROUP), gid, cid[at], key[at] & np.uint64(1)))
        cols = [np.concatenate([np.asarray(r[k]).astype(np.int64) for r in rows]) for k in range(4)]
        for lo in range(0, len(cols[0]), 200_000):
            yield dict(zip(("kind", "x", "y", "c"), (c[lo : lo + 200_000] for c in cols)))

    dealt = map_arrow(sets, ["cid", "singles", "pairs"], "bucket int, blob binary", keys)
    return gather(dealt, parts, "kind int, x long, y long, c long", members)


def _token_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """cid, tokens of the wanted sets (cid, doc_id, fp1, fp2), from the texts."""
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    picked = docs.select("doc_id", "text").join(ids, "doc_id")

    def run(batches):
        for b in batches:
            out = {"cid": [], "tokens": []}
            for cid, t, fp1, fp2 in zip(*(column(b, c) for c in ("cid", "text", "fp1", "fp2"))):
                s = shingles(t or "", n)
                fp = xxhash.xxh3_128_intdigest(s.tobytes())
                if (fp >> 64) - (1 << 63) == fp1 and (fp & (2**64 - 1)) - (1 << 63) == fp2:
                    out["cid"].append(cid)
                    out["tokens"].append(s.view(np.int64))
            yield out

    return map_arrow(picked, ["cid", "text", "fp1", "fp2"], "cid long, tokens array<long>", run)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, shared, either (sizes of intersection and union), linked. Identical
    rows of documents bring a set twice; so much the more often it is compared."""
    left = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("ta", "tb"))
    found = both.select("a", "b", shared.alias("shared"), (F.size("ta") + F.size("tb")).alias("sum"))
    return found.select(
        "a", "b", "shared", (F.col("sum") - F.col("shared")).alias("either"),
        (100 * F.col("shared") >= percent * (F.col("sum") - F.col("shared"))).alias("linked"),
    )


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """node, root: the smallest node reachable, for nodes that have a link
    (a, b). Alternates joining every node's larger and smaller neighbours to the
    smallest one until nothing moves; each round is written out."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = work.stage(edges, "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(low.select("u", F.col("m").alias("v")))
        before, edges = edges, work.stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        work.drop(before)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def _apart(x: str, y: str, percent: int):
    """True if two sets that share no rare token cannot link: columns ``n`` and
    ``rare`` of both, by their prefixes."""
    (nx, rx), (ny, ry) = ((F.col(f"{p}n"), F.col(f"{p}rare")) for p in (x, y))
    return 100 * F.least(nx - rx, ny - ry) < percent * (rx + ry + F.greatest(nx - rx, ny - ry))


def _beside_hubs(left: DataFrame, sets: DataFrame, work: Workspace, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A hub for each group of ``left`` (gid, paired, cid, n, rare, root and more):
    the links (a, b) to hubs, the pairs (a, b) of different roots that may link
    and have a member within ``REACH`` of the hub, and the rows of ``left`` beyond.

    A set is told by its differences, the tokens that only it or only the hub has.
    Sets x and y of d and e differences, s of them shared, are d + e - 2 s tokens
    apart, and link if that is at most t = (100 - percent) / (100 + percent) of
    their summed sizes. Two sets linked to the hub are in one component already,
    so one is far: its d exceeds t of its size and the hub's. Then s is more than
    half of e - t (size of y - size of the hub), which is less than e: the
    differences of y, ordered by how many members of the hub have them, can be
    cut to a prefix that still shares one with x."""
    more, less, key = 100 + percent, 100 - percent, ["centre", "paired", "cid"]
    hubs = left.groupBy("gid").agg(F.min(F.struct("rare", "cid")).alias("hub")).select("gid", F.col("hub.cid").alias("centre"))
    placed = left.join(hubs, "gid")
    mine, its = sets.select("cid", "tokens"), sets.select(F.col("cid").alias("centre"), F.col("tokens").alias("theirs"))
    members = placed.select(*key, "n", "rare", "root").distinct().join(mine, "cid").join(its, "centre")
    members = members.select(*key, "n", "rare", "root", F.size("theirs").alias("hub_n"), F.concat(F.array_except("tokens", "theirs"), F.array_except("theirs", "tokens")).alias("apart"))
    size, both = F.size("apart"), F.col("n") + F.col("hub_n")
    members = work.stage(members.select(
        *key, "n", "rare", "root", "apart", size.alias("size"), (more * size > less * both).alias("far"),
        (F.floor((more * size - less * (F.col("n") - F.col("hub_n"))) / (2 * more)) + 1).alias("common"),
        (2 * size / (both + size)).alias("d"),
    ), "members")
    to_hub = members.where("NOT far AND cid != centre").select(F.greatest("cid", "centre").alias("a"), F.least("cid", "centre").alias("b"))
    beyond = placed.join(members.where(F.col("d") <= REACH).select(*key), key, "left_anti").select(*left.columns)

    # Who links with a set within reach is no further from the hub than this.
    near = members.where(F.col("d") <= REACH + 1 - percent / 100 + 1e-9)
    listed = near.select(*key, F.explode("apart").alias("token"))
    often = listed.groupBy("centre", "paired", "token").agg(F.count("*").alias("df"))
    order = listed.join(often, ["centre", "paired", "token"]).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("order"))
    placed_tokens = near.drop("apart").join(order, key).select(*key, "n", "rare", "root", "size", "far", "common", "d", F.posexplode("order").alias("at", "t"))
    placed_tokens = work.stage(placed_tokens.select("*", "t.token").drop("t"), "differences")
    x, y, c = placed_tokens.where("far").alias("x"), placed_tokens.where("at <= size - common").alias("y"), F.col
    same = (c("x.centre") == c("y.centre")) & (c("x.paired") == c("y.paired")) & (c("x.token") == c("y.token"))
    # From these places on no more than so many are shared.
    shared = F.least(c("x.size") - c("x.at"), c("y.size") - c("y.at"))
    enough = 2 * more * shared >= more * (c("x.size") + c("y.size")) - less * (c("x.n") + c("y.n"))
    pairs = x.join(y, same & (c("x.root") != c("y.root")) & (~c("y.far") | (c("x.cid") > c("y.cid")))
                   & ((c("x.d") <= REACH) | (c("y.d") <= REACH)) & enough & ~(c("x.paired") & _apart("x.", "y.", percent)))
    return to_hub, pairs.select(F.greatest("x.cid", "y.cid").alias("a"), F.least("x.cid", "y.cid").alias("b")), beyond


def _mixed(rows: DataFrame, least: int) -> DataFrame:
    """The rows of groups that hold different roots and at least so many sets,
    with the group's size m."""
    size = rows.groupBy("gid").agg(F.min("root").alias("lowest"), F.max("root").alias("highest"), F.count("*").alias("m"))
    return rows.join(size.where((F.col("lowest") != F.col("highest")) & (F.col("m") >= least)).select("gid", "m"), "gid")


def similar_groups(docs: DataFrame, percent: int = 85, n: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    parts = task_count(docs)
    work = Workspace(docs.sparkSession, "jaccard-join")
    signed = _signatures(docs, work, counted_tokens(docs, work, n), percent, n)
    rows = work.stage(signed.select("doc_id", "n", "fp1", "fp2", "row"), "rows")
    linked = rows.where("doc_id IS NOT NULL AND n > 0")
    classes = work.stage(linked.groupBy("fp1", "fp2").agg(F.min("row").alias("cid")), "classes")
    sets = signed.where("doc_id IS NOT NULL AND n > 0").join(classes, ["fp1", "fp2"]).where("row = cid")
    facts = sets.select("cid", "doc_id", "fp1", "fp2", "n", "rare", "often")
    found = work.stage(_groups(sets, parts), "members")

    def of(kind: int, *names: str) -> DataFrame:
        return found.where(F.col("kind") == kind).select(*(F.col(c).alias(n) for c, n in zip(("x", "y", "c"), names)))

    # What a set can share outside small groups, and in all: two sets of enough
    # tokens link only if they share more than CLASSES of their prefixes.
    enough = -(-(100 * CLASSES + 1) // percent)
    large, small = (of(k, "cid", "_", "c").groupBy("cid").agg(F.sum("c").alias(n)) for k, n in ((IN_LARGE, "large"), (IN_SMALL, "small")))
    facts = facts.join(large, "cid", "left").join(small, "cid", "left").withColumn("large", F.coalesce("large", F.lit(0)) + F.col("often"))
    short = F.col("n") < enough
    able = work.stage(facts.where(short | (F.coalesce("small", F.lit(0)) + F.col("large") > CLASSES)).drop("small"), "able")
    a, b = (able.select(F.col("cid").alias(k), *(F.col(c).alias(f"{k}_{c}") for c in ("n", "rare", "large"))) for k in "ab")

    def with_facts(pairs: DataFrame) -> DataFrame:
        sized = pairs.join(a, "a").join(b, "b")
        return sized.where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))

    work.drop(signed)
    direct = with_facts(of(PAIR, "a", "b", "c").groupBy("a", "b").agg(F.sum("c").alias("c"))).where(
        (F.least("a_n", "b_n") < enough) | (F.col("c") + F.least("a_large", "b_large") > CLASSES)
    ).select("a", "b")
    combined = with_facts(of(COMBINED, "a", "b").distinct()).where(~_apart("a_", "b_", percent)).select("a", "b")
    groups = work.stage(of(GROUP, "gid", "cid", "paired").join(able.select("cid", "n", "rare"), "cid").withColumn("paired", F.col("paired") == 1), "groups")

    # Round one: the pairs of small groups, and every member of a large group
    # against its hub.
    hub = F.min(F.struct("rare", "cid")).alias("hub")
    stars = groups.join(groups.groupBy("gid").agg(hub), "gid").where("cid != hub.cid").select(
        F.greatest("cid", "hub.cid").alias("a"), F.least("cid", "hub.cid").alias("b"))
    stars = work.stage(stars.unionByName(direct).unionByName(combined).distinct(), "candidates")
    wanted = stars.select(F.col("a").alias("cid")).unionByName(stars.select(F.col("b").alias("cid")))
    wanted = wanted.unionByName(groups.select("cid")).distinct().join(able, "cid")
    wanted = work.stage(wanted.select("cid", "doc_id", "fp1", "fp2"), "wanted")
    tokens = work.stage(_token_sets(docs, wanted, n), "token-sets")
    checked = work.stage(_verified(stars, tokens, percent), "checked")
    label = components(checked.where("linked"), work)

    # Round two: members of one group that are still in different components.
    ends = [checked.select(F.col(x).alias("cid"), (1 - F.col("shared") / F.col("either")).alias("d"), F.col(y).alias("hub")) for x, y in ("ab", "ba")]
    near = ends[0].unionByName(ends[1]).groupBy("cid").agg(F.min(F.struct("d", "hub")).alias("h"))
    marked = groups.join(label.withColumnRenamed("node", "cid"), "cid", "left").join(near, "cid", "left").select(
        "gid", "paired", "cid", "n", "rare", F.coalesce("root", "cid").alias("root"),
        F.coalesce("h.hub", "cid").alias("hub"), F.coalesce("h.d", F.lit(0.0)).alias("d"),
    )
    left = work.stage(_mixed(marked, 3), "open-groups")  # Of two, one was the hub of the other.
    few, to_hubs, beside = left.where(F.col("m") <= MANY), [], []
    left = left.where(F.col("m") > MANY)
    count = left.count()
    if count:
        large = work.stage(tokens.join(left.select("cid").distinct(), "cid", "left_semi").dropDuplicates(["cid"]), "large-sets")
    while count:
        to_hub, pairs, beyond = _beside_hubs(left.drop("m"), large, work, percent)
        to_hubs.append(to_hub)
        beside.append(pairs)
        left = work.stage(_mixed(beyond, 2), "open-groups")
        few, left = few.unionByName(left.where(F.col("m") <= MANY)), left.where(F.col("m") > MANY)
        before, count = count, left.count()
        if 20 * count > 19 * before:  # Hubs do not settle these: no two are near each other.
            few, count = few.unionByName(left), 0
    a, b = few.alias("a"), few.alias("b")
    far, c = 1 - percent / 100 + 1e-9, F.col
    apart = c("a.paired") & _apart("a.", "b.", percent)
    rest = a.join(b, (c("a.gid") == c("b.gid")) & (c("a.cid") > c("b.cid")) & (c("a.root") != c("b.root"))
                  & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
                  & ~((c("a.hub") == c("b.hub")) & (F.abs(c("a.d") - c("b.d")) > far)) & ~apart)
    rest = rest.select(c("a.cid").alias("a"), c("b.cid").alias("b"))
    for pairs in beside:
        rest = rest.unionByName(pairs)
    rest = rest.distinct()
    done = checked.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rest = work.stage(rest.join(done, ["a", "b"], "left_anti"), "rest")
    links = checked.where("linked").select("a", "b").unionByName(_verified(rest, tokens, percent).where("linked").select("a", "b"))
    for to_hub in to_hubs:
        links = links.unionByName(to_hub)
    label = components(links, work)

    # Back to documents: the smallest doc_id of each component.
    member = linked.select("doc_id", "n", "row", "fp1", "fp2").join(classes, ["fp1", "fp2"])
    member = member.join(label.withColumnRenamed("node", "cid"), "cid", "left").select("row", "doc_id", "n", F.coalesce("root", "cid").alias("root"))
    least = member.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    grouped = member.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("doc_id IS NULL OR n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    out = stage(grouped.unionByName(alone), "similar-groups")
    work.drop()
    return out
