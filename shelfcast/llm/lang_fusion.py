"""Language ID by Bayesian evidence fusion.

A row's posterior over languages multiplies four pieces of evidence: the
likelihood of its text (byte trigrams, naive Bayes), of its declared markup
language and of its address suffix given each language, and a prior of its host
that is smoothed towards its domain's and that towards the whole table's. The
last three are grouped sums of the text posteriors over all rows, joined back;
a row's own share is taken out of its host's and domain's sums first.

Next to the languages stands the hypothesis that the text is in none of them:
``UNKNOWN`` is its prior, and its text likelihood is that of a background in
which bytes follow each other at random, as often as in the fitted texts, mixed
with an even share of every trigram. Host, suffix and declaration tell nothing
about it. The background is also what each language's trigram counts are
smoothed with, so a language of few documents is not told from it by what it
has not been seen with. A document of the fitted sample is judged without its
own trigrams.

A row is accepted if its best language's posterior, of all languages and the
unknown, reaches ``ACCEPT`` and there is evidence of any kind.

Defined cases: null or empty text, address, host or declared language gives no
evidence of that kind (a flat factor); without any, the row gets the table's
most usual language with its share as posterior, and is not accepted. ``lang``
is the best language even where the unknown wins. A null id passes through.
Repeated rows count once each. Pages of unclosed marks are read in linear
time. Without a labelled document there are no
languages: lang is null, posterior 0, not accepted. Ties go to the language
first in alphabetical order. Further columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BROADCAST_IDS, column, map_arrow, stage, texts

#: The text model is fitted on at most this many documents of each language,
#: chosen by a hash of doc_id, and on every language that a document is labelled
#: with. Its table takes 64 kB for each.
FIT_ROWS_PER_LANGUAGE = 1500
GRAMS = 1 << 14
_FLUSH = 3_000_000
#: Trigrams overlap and follow each other closely, so a text counts as at most
#: this many independent ones.
MOST_EVIDENCE = 60.0
#: Weight, in rows, of the level above in the host and domain priors, and of the
#: flat share in the suffix and declaration likelihoods.
SMOOTH = 4.0
ACCEPT = 0.5
#: The share of texts that are in no labelled language, before any is read.
UNKNOWN = 0.01
#: The even share within the background.
EVEN = 0.5

# Parts of a page that show no text.
HIDDEN = ("script", "style", "noscript", "template")
MARK = re.compile(rf"(?i)<({'|'.join(HIDDEN)})\b|</({'|'.join(HIDDEN)})\s*>|(<!)(?=--)|-->")
TAG = re.compile(r"<[^>]*>")
#: An opening tag ends at the next mark, so a page of unclosed ones is read once.
PAGE_LANG = r"(?is)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,3})"


def without_hidden(page: str) -> str:
    """The page less its hidden elements and comments, each from its opening
    mark to the first closing one after it; an opening mark that is never
    closed hides nothing. The marks are found once, whatever the page holds."""
    opening: list[tuple[int, int, str]] = []
    starts: dict[str, list[int]] = {}
    ends: dict[str, list[int]] = {}
    for m in MARK.finditer(page):
        if m[1] or m[3]:
            opening.append((m.start(), m.end() if m[1] else m.end() + 2, m[1].lower() if m[1] else "--"))
        else:
            name = m[2].lower() if m[2] else "--"
            starts.setdefault(name, []).append(m.start())
            ends.setdefault(name, []).append(m.end())
    out, at = [], 0
    for start, end, name in opening:
        if start < at:
            continue
        close = bisect_left(starts.get(name, []), end)
        if close < len(starts.get(name, [])):
            out.append(page[at:start])
            at = ends[name][close]
    out.append(page[at:])
    return " ".join(out)


def visible_text(page: str) -> str:
    """Text outside of tags and hidden elements, its character references
    resolved. A tag runs from ``<`` to the next ``>``; after the last ``>``
    there are none, so no search runs to the end in vain."""
    page = without_hidden(page)
    last = page.rfind(">") + 1
    return html.unescape(TAG.sub(" ", page[:last]) + page[last:])


def lowered(text: str) -> np.ndarray:
    """The bytes that are counted; blanks run together."""
    return np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode(), np.uint8)


def buckets(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Bucket of each trigram of bytes."""
    h = ((a << np.uint32(16)) | (b << np.uint32(8)) | c) * np.uint32(2654435761)
    return (h >> np.uint32(18)).astype(np.int64)


def is_letter(raw: np.ndarray) -> np.ndarray:
    return ((raw >= 97) & (raw <= 122)) | (raw >= 128)


def grams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams that touch a letter."""
    raw = lowered(text).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    letter = is_letter(raw)
    return buckets(raw[:-2], raw[1:-1], raw[2:])[letter[:-2] | letter[1:-1] | letter[2:]]


def background(byte_counts: np.ndarray) -> np.ndarray:
    """The share of each bucket among trigrams of independent bytes that touch a
    letter, mixed with the even share."""
    f = (byte_counts + 1) / (byte_counts + 1).sum()
    byte = np.arange(256, dtype=np.uint32)
    letter = is_letter(byte)
    share = np.zeros(GRAMS)
    for a in byte:
        touched = letter[a] | letter[:, None] | letter[None, :]
        share += np.bincount(buckets(a, byte[:, None], byte[None, :]).ravel(), (f[a] * np.outer(f, f) * touched).ravel(), GRAMS)
    return (1 - EVEN) * share / share.sum() + EVEN / GRAMS


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    log_p: np.ndarray  # grams x languages
    log_background: np.ndarray  # grams
    totals: np.ndarray  # trigrams of each language's sample
    last: dict  # language -> the largest hash of a doc_id in its sample

    def log_likelihood(self, text: str, own: str | None = None) -> tuple[np.ndarray, float | None]:
        """Per language, up to a constant, and of the background next to the best
        of them; zeros and None for a text without letters. ``own`` is the
        language that the text itself was fitted for."""
        g = grams(text)
        if not len(g) or not self.languages:
            return np.zeros(len(self.languages)), None
        weight = min(len(g), MOST_EVIDENCE)
        log_p = self.log_p[g]
        if own is not None:
            k, even = self.languages.index(own), 0.5 * GRAMS
            _, at, times = np.unique(g, return_inverse=True, return_counts=True)
            least = even * np.exp(self.log_background[g])
            others = np.maximum(np.exp(log_p[:, k]) * (self.totals[k] + even) - times[at], least)
            log_p[:, k] = np.log(others / (max(self.totals[k] - len(g), 0) + even))
        ll = log_p.mean(0) * weight
        return ll - ll.max(), float(self.log_background[g].mean() * weight - ll.max())


def _fit_sample(docs: DataFrame, per_language: int) -> tuple[dict[str, int], DataFrame]:
    """The labelled languages with their rows, and doc_id, lang of the first
    ``per_language`` documents of each by the hash of doc_id: each id once, null
    ids not at all. A language's ids are cut by a histogram of the hash before
    they are ranked."""
    named = docs.select("doc_id", "lang").where("lang IS NOT NULL AND lang != ''")
    rows = {r.lang: r.n for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    known = named.where("doc_id IS NOT NULL").distinct()
    known = known.withColumn("h", F.xxhash64("doc_id")).withColumn("cell", F.shiftright("h", 52))
    of = Window.partitionBy("lang").orderBy("cell")
    cells = known.groupBy("lang", "cell").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(of))
    first = F.col("upto") - F.col("n") < per_language
    cut = stage(cells.groupBy("lang").agg(F.max(F.when(first, F.col("cell"))).alias("last")), "languages")
    few = known.join(F.broadcast(cut), "lang").where("cell <= last")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    return rows, few.withColumn("rank", rank).where(F.col("rank") <= per_language).select("doc_id", "lang")


def fit_text_model(docs: DataFrame, per_language: int = FIT_ROWS_PER_LANGUAGE) -> TextModel:
    """Fit on a bounded sample of the whole texts of documents with a ``lang``."""
    found, chosen = _fit_sample(docs, per_language)
    languages = tuple(sorted(found))
    chosen = stage(chosen, "fit-sample")
    last = {r.lang: r.h for r in chosen.groupBy("lang").agg(F.max(F.xxhash64("doc_id")).alias("h")).collect()}
    if not languages:
        return TextModel((), np.zeros((GRAMS, 0), np.float32), np.zeros(GRAMS, np.float32), np.zeros(0), {})
    if sum(min(n, per_language) for n in found.values()) <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    # By language too: rows of one id in two languages each speak for their own.
    picked = docs.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])
    number = {name: i for i, name in enumerate(languages)}
    # Buckets of trigrams, and single bytes after them.
    kinds = GRAMS + 256

    def count(batches):
        def flush():
            code, n = np.unique(np.concatenate(held), return_counts=True)
            return {"y": code // kinds, "g": code % kinds, "n": n}

        held, size = [], 0
        for b in batches:
            for t, name in zip(texts(b), column(b, "lang")):
                held.append(np.concatenate([grams(t), lowered(t).astype(np.int64) + GRAMS]) + number[name] * kinds)
                size += len(held[-1])
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    sums = map_arrow(picked, ["text", "lang"], "y int, g int, n long", count)
    sums = sums.groupBy("y", "g").agg(F.sum("n").alias("n")).toArrow()
    y, g, n = (sums.column(k).to_numpy() for k in ("y", "g", "n"))
    single = g >= GRAMS
    back = background(np.bincount(g[single] - GRAMS, n[single], 256))
    y, g, n = y[~single], g[~single], n[~single]
    p = np.repeat((0.5 * GRAMS * back).astype(np.float32)[:, None], len(languages), 1)
    p[g, y] += n
    totals = np.bincount(y, n, len(languages))
    p /= totals + 0.5 * GRAMS
    return TextModel(languages, np.log(p, out=p), np.log(back).astype(np.float32), totals, last)


def text_evidence(rows: DataFrame, model: TextModel, is_page: bool) -> DataFrame:
    """id, host, domain, suffix, declared of ``rows``, and ``ll`` and ``unknown``:
    the text's log likelihoods. ``rows`` has id, body, host, declared, and the
    hash of the id for documents that the model may have been fitted on."""

    def run(batches):
        for b in batches:
            found = []
            for t, name, h in zip(texts(b, "body"), column(b, "declared"), column(b, "hash")):
                fitted = h is not None and name in model.last and h <= model.last[name]
                found.append(model.log_likelihood(visible_text(t) if is_page else t, name if fitted else None))
            yield {
                **{c: column(b, c) for c in ("id", "host", "declared")},
                "ll": [ll for ll, _ in found], "unknown": [u for _, u in found],
            }

    scored = map_arrow(rows, ["id", "body", "host", "declared", "hash"], "id long, host string, declared string, ll array<double>, unknown double", run)
    labels = F.split("host", r"\.")
    dotted = F.col("host").contains(".")
    return scored.withColumns({
        "domain": F.when(dotted, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")),
        "suffix": F.when(dotted, F.element_at(labels, -1)),
    })


def matrix(batch, name: str, n: int) -> np.ndarray:
    """A column of arrays of ``n`` numbers each, rows x n."""
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def softmax(logs: np.ndarray) -> np.ndarray:
    """Logarithms, rows x languages, as shares."""
    powers = np.exp(logs - logs.max(1, keepdims=True))
    return powers / powers.sum(1, keepdims=True)


RESULT = "id long, host string, declared string, text_lang string, lang string, posterior double, accepted boolean"


def fuse(scored: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """id, host, declared, text_lang, lang, posterior, accepted. ``scored``
    should be staged: it is read for each of the sums and for the result. Without
    a column ``unknown``, rows are judged among the languages alone."""
    n = len(languages)
    if not n:
        return scored.select(
            "id", "host", "declared", F.lit(None).cast("string").alias("text_lang"),
            F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"),
        )
    keys = ("host", "domain", "suffix", "declared")

    def shares(batches):
        for b in batches:
            yield {**{c: column(b, c) for c in keys}, "p": list(softmax(matrix(b, "ll", n)))}

    rows = map_arrow(scored, [*keys, "ll"], "host string, domain string, suffix string, declared string, p array<double>", shares)

    def total() -> Column:
        return F.array(*(F.sum(F.col("p")[i]) for i in range(n)))

    # The language mix of the whole table: one row, by the driver.
    whole = rows.agg(total().alias("s")).collect()[0].s
    mass = np.array([x or 0.0 for x in whole]) + 1.0
    share = mass / mass.sum()

    open_set = "unknown" in scored.columns
    of_text = ["ll", "unknown"] if open_set else ["ll"]
    out = scored.select("id", *keys, *of_text)
    none = F.array_repeat(F.lit(0.0), n)
    for key in keys:
        sums = rows.where(F.col(key).isNotNull()).groupBy(key).agg(total().alias(f"{key}_s"), F.count("*").alias(f"{key}_n"))
        out = out.join(sums, key, "left").withColumns({
            f"{key}_s": F.coalesce(f"{key}_s", none), f"{key}_n": F.coalesce(f"{key}_n", F.lit(0)),
        })

    def judge(batches):
        for b in batches:
            ll = matrix(b, "ll", n)
            p = softmax(ll)

            def mixed(key: str, own: np.ndarray | None, above: np.ndarray) -> np.ndarray:
                """The key's language mix, without the row's own part if that is
                given, smoothed towards ``above``."""
                total, rows_there = matrix(b, f"{key}_s", n), np.array(column(b, f"{key}_n"))[:, None]
                if own is not None:
                    total, rows_there = np.maximum(total - own, 0), np.maximum(rows_there - 1, 0)
                return (total + SMOOTH * above) / (rows_there + SMOOTH)

            logs = ll + np.log(mixed("host", p, mixed("domain", p, share)))
            # How often a suffix or declaration goes with the language, next to
            # how often any does: its likelihood up to a factor shared by all.
            for key in ("suffix", "declared"):
                logs = logs + np.log(mixed(key, None, share) / share)
            top = logs.max(1)
            every = np.exp(logs - top[:, None]).sum(1)
            accepted = True
            if open_set:
                unknown = column(b, "unknown")
                # The languages' priors add up to the rest.
                odds = np.log(UNKNOWN / (1 - UNKNOWN)) + np.array([u or 0.0 for u in unknown])
                every = every + np.exp(np.minimum(odds - top, 700))
                accepted = np.array([any(x is not None for x in e) for e in zip(unknown, column(b, "host"), column(b, "declared"))], bool)
            best = 1 / every
            yield {
                **{c: column(b, c) for c in ("id", "host", "declared")},
                "text_lang": [languages[k] if low < 0 else None for k, low in zip(ll.argmax(1), ll.min(1))],
                "lang": [languages[k] for k in logs.argmax(1)],
                "posterior": best, "accepted": (best >= ACCEPT) & accepted,
            }

    given = ["id", "host", "declared", *of_text, *(f"{k}_{x}" for k in keys for x in "sn")]
    return map_arrow(out, given, RESULT, judge)


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """The languages of web pages with page_id, url and html."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    declared = F.lower(F.regexp_extract("html", PAGE_LANG, 1))
    rows = pages.select(
        F.col("page_id").alias("id"), F.col("html").alias("body"),
        F.when(host != "", host).alias("host"), F.when(declared != "", declared).alias("declared"),
        F.lit(None).cast("long").alias("hash"),
    )
    return fuse(stage(text_evidence(rows, model, True), "page-evidence"), model.languages).withColumnRenamed("id", "page_id")


def identify_documents(docs: DataFrame, model: TextModel) -> DataFrame:
    """The languages of documents: lang is the declaration, source the host."""
    rows = docs.select(
        F.col("doc_id").alias("id"), F.col("text").alias("body"), F.when(F.col("source") != "", F.col("source")).alias("host"),
        F.when(F.col("lang") != "", F.col("lang")).alias("declared"),
        F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).alias("hash"),
    )
    return fuse(stage(text_evidence(rows, model, False), "doc-evidence"), model.languages).withColumnRenamed("id", "doc_id")
