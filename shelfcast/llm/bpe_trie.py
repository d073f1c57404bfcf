"""BPE encoding and decoding over a trie of distinct words.

In byte-pair encoding the tokens of a prefix are determined by one token for
each position, the last one of the prefix that ends there: a token ends at a
position if, merged alone with the last token of the prefix before it, the two
stay apart. So the encoding of a word extends that of its prefixes, and words
that share a prefix share its states. The distinct words of a block are laid
out as a trie (in sorted order, each word branches from the one before at their
common prefix), the states are carried down depth first, and each shared prefix
is computed once. Word ends are symbols of their own.

Texts are normalised and split as the vocabulary file says: NFC, white space to
blanks, lower case by character, then the file's pattern, then bytes shown as
printable characters. Special tokens in a text are cut out first.

Defined cases: a null or empty text has no tokens and decodes to the empty
string. Null ids and repeated rows pass through row by row. Further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
from hashlib import sha256
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import column, joined, kept, map_arrow, text_array
from .tokens import BLOCK, INNER_BLANK, RecentCache, bare_chunks, numbered, slices

# Fixed value: the pattern of the vocabulary file's pre-tokenizer.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Its matches in a word that ends in marks, other than the apostrophe.
WORD_AND_MARKS = re.compile(r"([a-z]+)([!-&(-/:-@\[-`{-~]+)")
END = "</w>"


def byte_alphabet() -> dict[int, str]:
    """Byte -> printable character: printable Latin-1 bytes stand for
    themselves, the others follow from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class TrieBPE:
    def __init__(self, path: str, cache: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.ids.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.ids))
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in special.items()}
        self.numerals = {i: str(i) for i in self.names}
        self.special = special
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.alphabet = byte_alphabet()
        self.apart: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.cache, self.word_ids = RecentCache(cache), RecentCache(cache)
        # Where to look for the token that ends after d symbols: any order is
        # right, as only one token fits; most are of two or three symbols.
        first = [k for k in (2, 3, 1, 4, 5) if k <= self.longest]
        lengths = [*first, *(k for k in range(1, self.longest + 1) if k not in first)]
        self.starts = [[d - k for k in lengths if k <= d] for d in range(self.longest + 1)]

    # -- the merge rule, on one or two tokens --------------------------------

    @staticmethod
    def symbols(token: str) -> list[str]:
        if token.endswith(END) and len(token) > len(END):
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def merged(self, parts: list[str]) -> list[str]:
        """Plain byte-pair merging: the lowest rank first, the leftmost of equals."""
        ranks = self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands(self, token: int) -> bool:
        """Is the token the encoding of its own text?"""
        ok = self.whole.get(token)
        if ok is None:
            name = self.names[token]
            ok = self.whole[token] = self.merged(self.symbols(name)) == [name]
        return ok

    def stay_apart(self, a: int, b: int) -> bool:
        ok = self.apart.get((a, b))
        if ok is None:
            x, y = self.names[a], self.names[b]
            if len(self.apart) > 500_000:
                self.apart.clear()
            ok = self.apart[a, b] = self.merged(self.symbols(x) + self.symbols(y)) == [x, y]
        return ok

    # -- the trie --------------------------------------------------------------

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Token ids of distinct words (byte alphabet, without the end mark)."""
        out: dict[str, list[int]] = {}
        ids, longest, apart, end, starts = self.ids.get, self.longest, self.apart, END, self.starts
        last: list[int] = [0]  # last[d], back[d]: the last token of the prefix of d symbols, and where it begins
        back: list[int] = [0]
        before = ""
        for w in sorted(words):
            n = len(w)
            shared, most = 0, min(n - 1, len(before) - 1)
            while shared < most and w[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], back[shared + 1 :]
            for d in range(shared + 1, n + 1):
                mark = end if d == n else ""
                for s in starts[d] if d <= longest else [d - longest + x for x in starts[longest]]:
                    t = ids(w[s:d] + mark)
                    if t is None:
                        continue
                    if s == 0:
                        if not self.stands(t):
                            continue
                    else:
                        ok = apart.get((last[s], t))
                        if not (self.stay_apart(last[s], t) if ok is None else ok):
                            continue
                    last.append(t)
                    back.append(s)
                    break
                else:
                    raise ValueError(f"no token ends {w[:d]!r}: the vocabulary lacks one of its symbols")
            tokens, d = [], n
            while d:
                tokens.append(last[d])
                d = back[d]
            out[w] = tokens[::-1]
            before = w
            # The state at the word's end is that of its end symbol; a longer
            # word branches before it, so it is never shared.
        return out

    # -- texts -----------------------------------------------------------------

    def words(self, chunk: str) -> list[str]:
        """The words of a chunk without white space or special tokens."""
        if chunk.isascii() and chunk.isprintable():
            chunk = chunk.lower()
            if chunk.isalpha():
                return [chunk]
            m = WORD_AND_MARKS.fullmatch(chunk)
            return list(m.groups()) if m else PIECE.findall(chunk)
        if INNER_BLANK.search(chunk):
            return [w for part in bare_chunks(chunk) for w in self.words(part)]
        norm = unicodedata.normalize("NFC", chunk)
        norm = "".join(map(str.lower, norm)) if "Σ" in norm else norm.lower()
        return [
            w if w.isascii() and w.isprintable() else "".join(map(self.alphabet.__getitem__, w.encode())) for w in PIECE.findall(norm)
        ]

    def spelled(self, ids: list[int]) -> tuple[int, str, str]:
        """The number of tokens, the ids, and the decoded text: as the vocabulary
        file has no decoder, the tokens joined by blanks."""
        return len(ids), " ".join(map(self.numerals.__getitem__, ids)), " ".join(map(self.names.__getitem__, ids))

    def spelled_words(self, words: list[str]) -> dict[str, tuple[int, str, str]]:
        return {w: self.spelled(ids) for w, ids in self.encode_words(words).items()}

    def spelled_chunks(self, chunks: list[str]) -> dict[str, tuple[int, str, str]]:
        out, split, cut = {}, {}, {}
        for c in chunks:
            if "<|" in c:
                parts = self.special_cut.split(c)
                cut[c] = [x for i, p in enumerate(parts) for x in ([self.special[p]] if i % 2 else self.words(p))]
                split[c] = [w for w in cut[c] if type(w) is str]
            else:
                split[c] = self.words(c)
        known = self.word_ids.complete(list(split.values()), self.spelled_words)
        for c, ws in split.items():
            if c in cut:
                got = [known[w] if type(w) is str else self.spelled([w]) for w in cut[c]]
            elif len(ws) == 1:
                out[c] = known[ws[0]]
                continue
            else:
                got = [known[w] for w in ws]
            n, ids, names = zip(*got) if got else ((), (), ())
            out[c] = sum(n), " ".join(ids), " ".join(names)
        return out

    def encode(self, batch: list[str] | pa.Array):
        """For each text: the number of tokens, the ids and the decoded text,
        the last two as strings joined by blanks."""
        for block in slices(batch if isinstance(batch, pa.Array) else pa.array(batch, pa.string()), BLOCK):
            words, numbers, begins = numbered(pc.ascii_split_whitespace(block))
            chunks = words.to_numpy(zero_copy_only=False).tolist()
            known = self.cache.complete([chunks], self.spelled_chunks)
            made = list(map(known.__getitem__, chunks))
            count = np.fromiter(map(_count, made), np.int64, len(made))
            ids, names = list(map(_ids, made)), list(map(_decoded, made))
            for lo, hi in zip(begins[:-1].tolist(), begins[1:].tolist()):
                of = numbers[lo:hi].tolist()
                # A chunk of white space alone has no token and adds no blank.
                if not count[numbers[lo:hi]].all():
                    of = [k for k in of if count[k]]
                yield int(count[numbers[lo:hi]].sum()), " ".join(map(ids.__getitem__, of)), " ".join(map(names.__getitem__, of))


_count, _ids, _decoded = map(itemgetter, range(3))


def model(path: str) -> TrieBPE:
    """The worker's model of a vocabulary file, kept between its tasks."""
    return kept(path, lambda: TrieBPE(path))


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the decoded text."""

    def run(batches):
        bpe = model(vocabulary)
        for b in joined(batches, BLOCK):
            rows = [(n, sha256(i.encode()).hexdigest(), sha256(d.encode()).hexdigest()) for n, i, d in bpe.encode(text_array(b))]
            yield {
                "doc_id": column(b, "doc_id"), "n_tokens": [r[0] for r in rows],
                "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows],
            }

    return map_arrow(docs, ["doc_id", "text"], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", run)
