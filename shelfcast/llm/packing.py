"""Best-fit packing of token sequences: best-two-fit.

Texts become pieces of at most ``size`` tokens, and pieces are packed into
sequences of that size. A bin is opened with the longest unpacked piece and
filled greedily with the longest that fits. Then its smallest piece is replaced
by two unpacked ones if they fill the gap that it leaves more tightly, and the
smallest goes back to be packed later.

Pieces are dealt at random into groups of about ``group_rows`` and each group is
packed by one task. A group loses at most a part of its last bins, so the count
of sequences stays within a fraction of a percent of one global packing, while
no task holds more than a group.

Defined cases: a null or empty text is its end token alone. A row with a null
``doc_id`` is packed like any other. Repeated rows are separate documents.
Further columns are ignored, whatever their names. No rows, no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import column, joined, map_arrow, stage, text_array
from .tokens import encoder

SIZE = 2048
END_ID = 0
GROUP_ROWS = 20_000
#: Bytes of text that a task encodes at once, and words that its worker remembers.
#: Packing ends the pipeline, when the executor's heap is grown to its limit, so
#: its workers take less than the tokenizer operators'.
BLOCK, WORDS = 4_000_000, 200_000


def token_pieces(docs: DataFrame, vocabulary: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each row."""

    def run(batches):
        enc, end = encoder(vocabulary, False, WORDS), np.array([end_id], "<u4").tobytes()
        for b in joined(batches, BLOCK):
            rows: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc, ids in zip(column(b, "doc_id"), enc.encode(text_array(b), BLOCK)):
                ids += end
                for k, lo in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[lo : lo + 4 * size]
                    rows["doc_id"].append(doc)
                    rows["piece"].append(k)
                    rows["start"].append(lo // 4)
                    rows["length"].append(len(part) // 4)
                    rows["ids_crc32"].append(zlib.crc32(part))
            yield rows

    return map_arrow(docs, ["doc_id", "text"], "doc_id long, piece int, start long, length long, ids_crc32 long", run)


def pack_two_fit(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece, by best-two-fit."""
    order = np.argsort(lengths, kind="stable")
    waiting: dict[int, list[int]] = {}
    for i in order.tolist():
        waiting.setdefault(int(lengths[i]), []).append(i)
    sizes = sorted(waiting)  # lengths that still have unpacked pieces

    def take(length: int) -> int:
        row = waiting[length]
        i = row.pop()
        if not row:
            del waiting[length]
            sizes.pop(bisect_right(sizes, length) - 1)
        return i

    def give(i: int, length: int) -> None:
        if length not in waiting:
            waiting[length] = []
            sizes.insert(bisect_right(sizes, length), length)
        waiting[length].append(i)

    def best_two(gap: int, least: int) -> tuple[int, int] | None:
        """Two unpacked lengths with the largest sum over ``least``, up to ``gap``."""
        best, pair = least, None
        for k in range(bisect_right(sizes, gap - 1) - 1, -1, -1):
            a = sizes[k]
            if 2 * a <= best:
                break
            j = bisect_right(sizes, min(gap - a, a)) - 1
            if j >= 0 and sizes[j] == a and len(waiting[a]) < 2:
                j -= 1
            if j >= 0 and a + sizes[j] > best:
                best, pair = a + sizes[j], (a, sizes[j])
                if best == gap:
                    break
        return pair

    bins, offsets, number = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    while sizes:
        held, gap = [], size
        while (k := bisect_right(sizes, gap) - 1) >= 0:
            gap -= sizes[k]
            held.append(take(sizes[k]))
        if gap and len(held) > 1 and sizes:
            small = int(lengths[held[-1]])  # greedy filling takes the smallest last
            pair = best_two(gap + small, small)
            if pair:
                dropped = held.pop()
                held += [take(x) for x in pair]
                give(dropped, small)
        at = 0
        for i in held:
            bins[i], offsets[i] = number, at
            at += int(lengths[i])
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, size: int = SIZE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``pieces`` should be
    staged: it is counted first."""
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    open_pieces = pieces.select(*names).where(F.col("length") < size)
    groups = max(1, -(-open_pieces.count() // group_rows))
    dealt = open_pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], kind="stable")
        group = int(pdf.pop("_group").iloc[0])
        bins, offsets = pack_two_fit(pdf["length"].to_numpy(), size)
        return pdf.assign(sequence_id=(bins * groups + group) * 2, offset=offsets)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in open_pieces.schema) + ", sequence_id long, offset long"
    filled = dealt.groupBy("_group").applyInPandas(fill, schema)
    full = pieces.select(*names).where(F.col("length") >= size)
    alone = full.select("*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return filled.unionByName(alone)


def pack_documents(docs: DataFrame, vocabulary: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    return pack(stage(token_pieces(docs, vocabulary, size, end_id), "pieces"), size)
