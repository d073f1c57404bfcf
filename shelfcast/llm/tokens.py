"""Whole texts to token ids with the tokenizers library, each distinct run of
non-blank characters encoded once per worker.

Arrow splits a block of texts and numbers its distinct chunks, so Python sees
each chunk of a block once, and a text's ids are gathered by number.

White space never joins two pieces of either public tokenizer's pre-tokenizer:
every piece is either inside one chunk, a run of white space and the non-blank
characters after it, or inside the white space alone. So a text's ids are its
chunks' ids in a row, and a chunk that was met before costs one dictionary
lookup a block. The library still makes every id.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept

# The Unicode white space characters.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LED_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
BARE_CHUNK = re.compile(f"[^{WHITE}]+")
# Texts whose words are not all apart by one blank or one line feed.
UNUSUAL = f"  | \n|\n |\n\n|^[ \n]|[ \n]$|^$|[\t\x0b-\r\x1c-\x1f{WHITE[4:]}]"
# Fixed value: letters or digits, then ASCII marks other than the apostrophe,
# which may begin a contraction. Either tokenizer's pattern cuts between the two.
MARKED = re.compile(r"([^\W_]+)([!-&(-/:-@\[-^`{-~]+)")
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'_")
LETTERS_MARKED = re.compile(r"([A-Za-z]+)([!-&(-/:-;=-@\[-^`{-~]*)")
LINE_FEED = ("\n",)
CONTROL_BLANK = re.compile("[\x1c-\x1f]")


def bare_chunks(text: str) -> list[str]:
    """Runs of non-blank characters."""
    return BARE_CHUNK.findall(text) if CONTROL_BLANK.search(text) else text.split()


def led_chunks(text: str) -> list:
    """Chunk keys: ``w`` for the chunk of one space and w, a tuple for the chunk
    at the start of a text, and else the chunk with its white space."""
    chunks: list = LED_CHUNK.findall(text)
    if chunks and chunks[0][0] not in _BLANKS:
        chunks[0] = (chunks[0],)
    return [c[1:] if type(c) is str and c[0] == " " and len(c) > 1 and not BLANK_SECOND.match(c) else c for c in chunks]


BLANK_SECOND = re.compile(f" [{WHITE}]")


#: Words that an encoder remembers, twice over at most.
CACHE = 400_000


class RecentCache:
    """Values by key, of bounded size: entries not asked for during the last
    ``size`` new ones are forgotten, and long keys at once."""

    def __init__(self, size: int):
        self.size, self.young, self.old, self.long = size, {}, {}, []

    def complete(self, keys: list[list], make) -> dict:
        """A dictionary that holds every key of the lists ``keys``;
        ``make(list)`` gives the values of the unknown ones. It is good until
        the next call."""
        for k in self.long:
            del self.young[k]
        self.long = []
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = set(filterfalse(young.__contains__, chain.from_iterable(keys)))
        for k in [k for k in missing if k in old] if old else ():
            young[k] = old[k]
            missing.discard(k)
        if missing:
            young.update(make(list(missing)))
            # What ``make`` gives beyond what was asked, it gives in short keys.
            self.long = [k for k in missing if len(k) > 40]
        return young


def blocks(texts: list[str], size: int) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``size`` characters."""
    block, held = [], 0
    for t in texts:
        block.append(t)
        held += len(t)
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """The texts in order, in arrays of about ``size`` bytes, or of one text."""
    held = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(held, (held[lo - 1] if lo else 0) + size, "right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


def marked(whole: pa.Array, lower: bool) -> tuple[list[str], np.ndarray, list[str], np.ndarray]:
    """Chunks of letters or digits before closing marks, cut in two: the distinct
    first parts (of other chunks, all of them) and the number of each chunk's,
    and the same of the second parts, with -1 for a chunk without."""
    base = pc.ascii_rtrim(whole, characters=MARKS)
    two = pc.and_(pc.less(pc.binary_length(base), pc.binary_length(whole)), pc.utf8_is_alnum(base))
    for odd in ("<|", "İ") if lower else ("<|",):
        two = pc.and_not(two, pc.match_substring(whole, odd))
    at = np.flatnonzero(two.to_numpy(zero_copy_only=False))
    long = pc.utf8_length(base.take(at)).to_numpy().tolist()
    tails = pa.array([w[n:] for w, n in zip(_strings(whole.take(at)), long)], pa.string()).dictionary_encode()
    tail = np.full(len(whole), -1)
    tail[at] = tails.indices.to_numpy()
    bases = pc.if_else(two, base, whole).dictionary_encode()
    return _strings(bases.dictionary), bases.indices.to_numpy(), _strings(tails.dictionary), tail


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def numbered(lists: pa.ListArray, without_first: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct strings of ``lists`` but the empty one, the numbers of all in
    a row, and where each list begins in it (with the end of the last). The first
    of each list may be left out; no list is empty."""
    words, begins = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy().astype(np.int64))])
    if without_first:
        rest = np.ones(len(words), bool)
        rest[begins[:-1]] = False
        words, begins = words.filter(pa.array(rest)), begins - np.arange(len(begins))
    found = words.dictionary_encode()
    words, numbers = found.dictionary, found.indices.to_numpy()
    empty = pc.index(words, "").as_py()
    if empty >= 0:
        full = numbers != empty
        begins = np.concatenate([[0], np.cumsum(full)])[begins]
        numbers = numbers[full]
        numbers = numbers - (numbers > empty)
        words = words.filter(pc.not_equal(words, ""))
    return words, numbers, begins


class TextEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, byte_level: bool, cache: int = CACHE):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.byte_level = byte_level
        self.cache = RecentCache(cache)
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        for name, i in names.items():
            self.token_bytes[i] = len(name) if byte_level else len(name.removesuffix("</w>"))

    def _alone(self, keys: list, out: dict) -> None:
        """Chunks that cannot be told apart in a row of chunks, one by one."""
        lead = " " if self.byte_level else ""
        spelled = [k[0] if type(k) is tuple else k if k[0] in _BLANKS else lead + k for k in keys]
        for k, e in zip(keys, self.tokenizer.encode_batch_fast(spelled, add_special_tokens=False)):
            out[k] = np.array(e.ids, "<u4").tobytes()

    def _bytes(self, key: str) -> int:
        """Bytes of the chunk's tokens."""
        if key.isascii():
            return len(key) + self.byte_level
        if self.byte_level:
            return len(key.encode()) + 1
        return len("".join(map(str.lower, unicodedata.normalize("NFC", key))).encode())

    def encode_chunks(self, keys: list) -> dict:
        """Ids of each distinct chunk. Letters before closing marks are a piece
        of their own, so a chunk of both is put together from its two parts."""
        young, lower = self.cache.young, not self.byte_level
        whole, tails, odd, two, same = set(), set(), [], [], []
        firsts, fed = {k for k in keys if type(k) is tuple}, []
        for k in keys:
            if type(k) is tuple:
                continue
            if k[0] == "\n" and not INNER_BLANK.search(k, 1) and len(k) > 1:
                # The line feed is a piece of its own before a word.
                fed.append((k, (k[1:],)))
                firsts.update(((k[1:],), LINE_FEED))
                continue
            ascii_only, m = k.isascii(), None
            if not (ascii_only and k.isalpha()):
                if k[0] in _BLANKS or "<|" in k or not ascii_only and INNER_BLANK.search(k):
                    odd.append(k)
                    continue
                if not lower or "İ" not in k:  # its lower case ends in a mark
                    m = MARKED.fullmatch(k)
            base, tail = m.groups() if m else (k, "")
            if lower and (ascii_only or base.isascii()):
                base = base.lower()
            whole.add(base)
            if tail:
                tails.add((tail,))
                two.append((k, base, (tail,)))
            elif base != k:
                same.append((k, base))
        letters = set()
        for k in filterfalse(young.__contains__, firsts):
            m = LETTERS_MARKED.fullmatch(k[0]) if self.byte_level else None
            if not m:
                odd.append(k)
                continue
            base, tail = m.groups()
            letters.add(base)
            if tail:
                tails.add((tail,))
                two.append((k, (base,), (tail,)))
        out: dict = {}
        self._alone(odd + [t for t in tails if t not in young], out)
        self._firsts([w for w in letters if (w,) not in young], out)
        self._rows(list(filterfalse(young.__contains__, whole)), out)
        for k, base in same:
            out[k] = out.get(base) or young[base]
        for k, base, tail in two:
            out[k] = (out.get(base) or young[base]) + (out.get(tail) or young[tail])
        for k, word in fed:
            out[k] = (out.get(LINE_FEED) or young[LINE_FEED]) + (out.get(word) or young[word])
        return out

    def _rows(self, plain: list, out: dict) -> None:
        """Chunks of one blank and a word, encoded many to a row and told apart
        by the bytes that their tokens cover."""
        lead = " " if self.byte_level else ""
        for words in (list(filter(str.isascii, plain)), list(filterfalse(str.isascii, plain))):
            for lo in range(0, len(words), 1024):
                some = words[lo : lo + 1024]
                rows = [some[i : i + 16] for i in range(0, len(some), 16)]
                found = self.tokenizer.encode_batch_fast([lead + " ".join(r) for r in rows], add_special_tokens=False)
                self._cut(rows, [e.ids for e in found], out, self._alone)

    def _firsts(self, words: list, out: dict) -> None:
        """Words of ASCII letters without a blank before them: lines of a row,
        whose line feeds are single tokens."""

        def ended(words, out):
            for w, e in zip(words, self.tokenizer.encode_batch_fast([w + "\n" for w in words], add_special_tokens=False)):
                out[w] = np.array(e.ids, "<u4").tobytes()

        lines: dict = {}
        for lo in range(0, len(words), 1024):
            some = words[lo : lo + 1024]
            rows = [some[i : i + 16] for i in range(0, len(some), 16)]
            found = self.tokenizer.encode_batch_fast(["\n".join(r) + "\n" for r in rows], add_special_tokens=False)
            self._cut(rows, [e.ids for e in found], lines, ended)
        for w, ids in lines.items():
            out[w,] = ids[:-4]

    def _cut(self, rows: list[list[str]], row_ids: list[list[int]], out: dict, alone) -> None:
        """The ids of each word of rows of words. Rows that do not come out even
        are looked at in halves, and the last one word by word, by ``alone``."""
        words = list(chain.from_iterable(rows))
        ids = np.array(list(chain.from_iterable(row_ids)), "<u4")
        if words[0].isascii():
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + self.byte_level)
        else:
            ends = np.cumsum(np.fromiter(map(self._bytes, words), np.int64, len(words)))
        covered = np.cumsum(self.token_bytes[ids])
        cut = np.searchsorted(covered, ends)
        if cut[-1] == len(ids) - 1 and np.array_equal(covered[cut], ends):
            raw, at = ids.tobytes(), 0
            for k, end in zip(words, (4 * cut + 4).tolist()):
                out[k] = raw[at:end]
                at = end
        elif len(rows) == 1:
            alone(words, out)
        else:
            half = len(rows) // 2
            self._cut(rows[:half], row_ids[:half], out, alone)
            self._cut(rows[half:], row_ids[half:], out, alone)

    def encode(self, texts: list[str] | pa.Array, size: int | None = None) -> Iterator[bytes]:
        """Ids of each text, in order. Texts are handled in blocks of a few
        million bytes (or ``size``), so memory does not grow with the list."""
        for block in slices(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), size or BLOCK):
            if not self.byte_level:
                yield from self._gather(*numbered(pc.ascii_split_whitespace(block)))
                continue
            unusual = pc.match_substring_regex(block, UNUSUAL)
            plain = self._led(block.filter(pc.invert(unusual)))
            for text, odd in zip(block, unusual.to_pylist()):
                if not odd:
                    yield next(plain)
                    continue
                keys = led_chunks(text.as_py())
                known = self.cache.complete([keys], self.encode_chunks)
                yield b"".join(map(known.__getitem__, keys))

    def _led(self, block: pa.Array) -> Iterator[bytes]:
        """Ids of texts whose words are apart by one blank or one line feed."""
        lists = pc.split_pattern(pc.replace_substring(block, "\n", " \n"), " ")
        first = [(w,) for w in pc.list_element(lists, 0).to_pylist()] if len(block) else []
        known = dict(zip(first, map(self.cache.complete([first], self.encode_chunks).__getitem__, first)))
        for w, rest in zip(first, self._gather(*numbered(lists, without_first=True))):
            yield known[w] + rest

    def _gather(self, chunks: pa.Array, numbers: np.ndarray, begins: np.ndarray) -> Iterator[bytes]:
        """For each list of chunk numbers the ids of its chunks."""
        bases, base, tails, tail = marked(chunks, not self.byte_level)
        tails = [(t,) for t in tails]
        known = self.cache.complete([bases, tails], self.encode_chunks)
        made = [*map(known.__getitem__, bases), *map(known.__getitem__, tails), b""]
        size = np.fromiter(map(len, made), np.int64, len(made)) // 4
        ids, start = np.frombuffer(b"".join(made), "<u4"), np.cumsum(size) - size
        # A chunk's ids are those of its two parts, of which the second may be empty.
        parts = np.stack([base, np.where(tail < 0, len(made) - 1, tail + len(bases))], 1).ravel()
        n = size[parts]
        place = np.cumsum(n)
        ids = ids[np.repeat(start[parts] - place + n, n) + np.arange(n.sum())]
        size = n.reshape(-1, 2).sum(axis=1)
        start = np.cumsum(size) - size
        for first in range(0, len(begins) - 1, 64):
            # Some texts at a time, so that the working arrays stay short.
            ends = begins[first : first + 65]
            some = numbers[ends[0] : ends[-1]]
            n = size[some]
            place = np.concatenate([[0], np.cumsum(n)])
            raw = ids[np.repeat(start[some] - place[:-1], n) + np.arange(place[-1])].tobytes()
            cuts = (4 * place[ends - ends[0]]).tolist()
            yield from map(raw.__getitem__, map(slice, cuts[:-1], cuts[1:]))


#: Bytes of text that are split and numbered at once.
BLOCK = 12_000_000
INNER_BLANK = re.compile(f"[{WHITE}]")
_BLANKS = frozenset(c for c in map(chr, range(0x3001)) if LED_CHUNK.match(c) and not BARE_CHUNK.match(c))


def encoder(path: str, byte_level: bool, cache: int = CACHE) -> TextEncoder:
    """The worker's encoder for a vocabulary file, kept between its tasks."""
    key = (path, byte_level) if cache == CACHE else (path, byte_level, cache)
    return kept(key, lambda: TextEncoder(path, byte_level, cache))
