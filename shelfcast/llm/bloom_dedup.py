"""Exact duplicates by two passes of Bloom filtering, in DataFrame functions only.

A text's SHA-256 digest marks a cell of a bitmap. Pass one counts the rows of
each cell and keeps, as a bitmap, the cells that two rows or more fell into. Pass
two does so again with another hash, for the rows that the first bitmap let
through. A digest that occurs twice is in both bitmaps; one that occurs once
rarely is. Only the rows in both shuffle, to be grouped by their whole digest, so a
false positive costs a shuffle and never a wrong answer. All other rows pass
straight through as groups of one.

What the two passes exchange is counters of cells (combined before they move),
not rows. Digests are dealt into slices of at most SLICE_ROWS rows, written
apart, so a bitmap has a fixed greatest size however many rows there are: each
slice is filtered against its own pair of broadcast bitmaps, and each row is
read by one slice alone.

Nulls and odd input: a null text is the empty text, and equals other empty
texts. A null id is smaller than all others; if a group has only null ids, its
``keep_id`` is null. Of rows with equal text and equal id exactly one stays.
Texts are compared whole, by their SHA-256. An empty table gives an empty
result. Columns other than the id and the text are never looked at, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import BROADCAST_IDS, Workspace
from .joins import join_groups

#: Bits of a bitmap for each row that enters it.
BITS_PER_ROW = 8
#: Rows of a slice: its bitmaps take at most 64 MB each.
SLICE_ROWS = 1 << 26
#: Bits of one row of a bitmap table, as Spark's bitmap functions cut them.
BITMAP_BITS = 32_768


def digest_of(text_column: str):
    """SHA-256 of a text in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256))


def bitmap_size(n_rows: int) -> int:
    """Bits for ``n_rows``: a power of two."""
    return max(BITMAP_BITS, 1 << (max(1, n_rows) * BITS_PER_ROW - 1).bit_length())


def cell(key: str, seed: int, bits: int):
    """Cell 1 .. ``bits`` of a key; seeds give independent cells."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(bits)) + 1


def repeated_cells(rows: DataFrame, key: str, seed: int, bits: int) -> DataFrame:
    """The bitmap (bucket, bits) of the cells that two rows or more are in."""
    twice = rows.groupBy(cell(key, seed, bits).alias("at")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits")
    )


def with_hit(rows: DataFrame, bitmap: DataFrame, key: str, seed: int, bits: int, name: str) -> DataFrame:
    """``rows`` with a boolean: is the row's cell set? The bitmap has at most
    ``bits`` / BITMAP_BITS rows of 4 kB, fixed by SLICE_ROWS, and is broadcast."""
    at = cell(key, seed, bits)
    place = F.bitmap_bit_position(at)
    byte = F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(value, (place % 8).cast("int")) == 1, F.lit(False))
    found = rows.withColumn("_bucket", F.bitmap_bucket_number(at)).join(F.broadcast(bitmap), "_bucket", "left")
    return found.withColumn(name, hit).drop("_bucket", "_bits")


def possibly_repeated(work: Workspace, rows: DataFrame, key: str, n_rows: int) -> DataFrame:
    """``rows`` (a written table) with the boolean ``maybe``: false only for
    keys that occur once."""
    first_bits = bitmap_size(n_rows)
    first = work.stage(repeated_cells(rows, key, 1, first_bits), "bloom-one")
    passed = with_hit(rows, first, key, 1, first_bits, "_one").where("_one").drop("_one")
    second_bits = bitmap_size(min(n_rows, passed.count()))
    second = work.stage(repeated_cells(passed, key, 2, second_bits), "bloom-two")
    both = with_hit(with_hit(rows, first, key, 1, first_bits, "_one"), second, key, 2, second_bits, "_two")
    return both.withColumn("maybe", F.col("_one") & F.col("_two")).drop("_one", "_two")


def _slice(work: Workspace, rows: DataFrame) -> DataFrame:
    """The decisions about the rows of one slice."""
    n_rows = rows.count()
    marked = work.stage(possibly_repeated(work, rows, "digest", n_rows), "marked")
    alone = marked.where("NOT maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                             F.lit(True).alias("kept"), "digest")
    repeated = marked.where("maybe").select("doc_id", "row", "digest")
    groups = work.stage(
        repeated.groupBy("digest").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(F.struct(F.col("doc_id").alias("id"), F.col("row").alias("at"))).alias("keep")
        ),
        "groups",
    )
    met = join_groups(repeated, groups, "digest", "group_size", n_rows).select(
        "doc_id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.at")).alias("kept"), "digest"
    )
    return alone.unionByName(met)


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (id of the row of its group
    that stays, the largest), group_size, kept, digest (binary)."""
    work = Workspace(docs.sparkSession, "bloom-dedup")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), digest_of(text_column).alias("digest"))
    slices = max(1, -(-docs.count() // SLICE_ROWS))
    part = F.pmod(F.xxhash64(F.col("digest"), F.lit(0)), F.lit(slices)).cast("int")
    # Written once, with a name for each row that later reads agree on.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    digests = [work.stage(rows, "digests")]
    if slices > 1:
        digests = work.stage_parts(digests[0].withColumn("slice", part), "slice", slices, "slices")
    out = [work.stage(_slice(work, d), "decided") for d in digests]
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def without_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each text, with all their columns."""
    work = Workspace(docs.sparkSession, "bloom-kept")
    found = exact_duplicates(docs, id_column, text_column).where("NOT kept")
    # A twin has the id and the text of the row that stays: one of them stays.
    gone = work.stage(
        found.select(F.col("doc_id").alias("_gone_id"), F.col("digest").alias("_gone_digest"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("_twin")).distinct(),
        "gone",
    )
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    marked = docs.withColumn("_digest", digest_of(text_column))
    same = F.col(id_column).cast("long").eqNullSafe(F.col("_gone_id")) & (F.col("_digest") == F.col("_gone_digest"))
    met = marked.join(side, same, "left")
    twins = met.where("_twin").dropDuplicates([id_column, "_digest"])
    return met.where("_twin IS NULL").unionByName(twins).select(*docs.columns)
