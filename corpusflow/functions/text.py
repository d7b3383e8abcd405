"""Column-level text helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token and whitespace rules shared by indexing, ranking and
# chunking. Tokens are maximal runs of Unicode letters or digits, lower-cased.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
# Whitespace as Python's str.isspace() defines it: Unicode White_Space plus the
# separators U+001C-U+001F (Java's (?U)\s lacks those four).
WS = r"[\s\x1c-\x1f]"
# Sentence boundary: whitespace run that follows one of . ! ?
SENTENCE_SPLIT = r"(?U)(?<=[.!?])" + WS + "+"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Strip leading/trailing Unicode whitespace (``trim`` only strips spaces)."""
    return F.regexp_replace(col_of(c), "(?U)^" + WS + "+|" + WS + "+$", "")


def tokens(c) -> Column:
    """Lower-cased letter/digit tokens as ``array<string>`` (empties removed)."""
    return F.filter(F.split(F.lower(col_of(c)), TOKEN_SPLIT, -1), lambda t: t != F.lit(""))


def sentences(c) -> Column:
    """Split after ``.!?`` + whitespace, strip each piece, drop empties."""
    parts = F.split(col_of(c), SENTENCE_SPLIT, -1)
    return F.filter(F.transform(parts, ustrip), lambda s: F.length(s) > 0)


def record_text(names: list[str], cols: list[Column] | None = None) -> Column:
    """``name: value`` lines in field order; null renders as ``None``."""
    cols = cols or [F.col(n) for n in names]
    lines = [F.concat(F.lit(f"{n}: "), F.coalesce(c.cast("string"), F.lit("None")))
             for n, c in zip(names, cols)]
    return F.concat_ws("\n", *lines)
