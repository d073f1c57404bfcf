"""Text and lenient-parse expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.split/strip sees it: Unicode spaces plus the four
# information separators U+001C..U+001F, which Java's \s does not include.
_WS = r"(?U)[\s\x{1c}-\x{1f}]+"
_WS_EDGES = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """null -> '', strip, lower-case, collapse inner whitespace to one space."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    stripped = F.regexp_replace(text, _WS_EDGES, "")
    return F.lower(F.regexp_replace(stripped, _WS, " "))


def text_to_bool(c: Column | str) -> Column:
    """'true' in any case -> true; everything else, null included -> false."""
    return F.coalesce(F.lower(_col(c).cast("string")) == F.lit("true"), F.lit(False))


def lenient_double(c: Column | str) -> Column:
    """Numeric coercion where unparsable text becomes null (never an error)."""
    return _col(c).try_cast("double")


def pipe_piece_count(c: Column | str) -> Column:
    """Number of '|'-separated pieces; the empty string counts 0."""
    col = _col(c)
    return F.when(F.coalesce(col, F.lit("")) == "", F.lit(0)).otherwise(
        F.size(F.split(col, r"\|"))
    ).cast("int")
