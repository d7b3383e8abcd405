"""M1-M8: PII finders and maskers as pure column expressions (no UDF).

Masking is position-exact: the text is split by the finder pattern into the
pieces between matches, the matches are masked, and the two arrays are
interleaved again, so every match is replaced where it was found.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.text import col_of

# Finder patterns (Python `re` syntax; `(?U)` gives Java the same
# Unicode meaning of \b and \d), in the order masking applies them.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"\b(?:\+?1[-.]?)?\(?([0-9]{3})\)?[-.]?([0-9]{3})[-.]?([0-9]{4})\b"
CARD = (r"\b(?:4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}"
        r"|6(?:011|5[0-9]{2})[0-9]{12}|(?:2131|1800|35\d{3})\d{11})\b")
SSN = r"\b(?!000|666|9\d{2})\d{3}-(?!00)\d{2}-(?!0000)\d{4}\b"
IBAN = r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b"

PATTERNS = {
    "EMAIL_ADDRESS": EMAIL,
    "PHONE_NUMBER": PHONE,
    "CREDIT_CARD": CARD,
    "US_SSN": SSN,
    "IBAN_CODE": IBAN,
}
ENTITY_TYPES = list(PATTERNS)
# A character every match of the pattern contains (used to skip passes).
REQUIRED_CHAR = {"EMAIL_ADDRESS": "@", "US_SSN": "-"}
MASK_CHAR = "*"


def _jpat(p: str) -> Column:
    return F.lit("(?U)" + p)


def find_all(text, entity_type: str) -> Column:
    """M1-M5: all matches of one finder, left to right, as ``array<string>``."""
    return F.regexp_extract_all(col_of(text), _jpat(PATTERNS[entity_type]), 0)


def _stars(n: Column, mask_char: str = MASK_CHAR) -> Column:
    return F.repeat(F.lit(mask_char), n)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\D", "")


def mask_match(hit: Column, entity_type: str, mask_char: str = MASK_CHAR) -> Column:
    """How one match is masked: email keeps its domain, phone keeps its last 4
    digits (separators dropped), everything else becomes mask characters."""
    if entity_type == "EMAIL_ADDRESS":
        local = F.substring_index(hit, "@", 1)
        domain = F.substring_index(hit, "@", -1)
        return F.concat(_stars(F.length(local), mask_char), F.lit("@"), domain)
    if entity_type == "PHONE_NUMBER":
        d = _digits(hit)
        n = F.length(d)
        return F.when(n > 4, F.concat(_stars(n - 4, mask_char), F.substring(d, -4, 4))) \
                .otherwise(_stars(n, mask_char))
    return _stars(F.length(hit), mask_char)


def _lengths_prefix(arr: Column, i: Column) -> Column:
    """Sum of lengths of the first ``i`` elements of ``arr``."""
    return F.aggregate(F.slice(arr, 1, i), F.lit(0), lambda acc, s: acc + F.length(s))


FINDING_TYPE = "array<struct<type:string,start:int,end:int,original_length:int>>"


def split_matches(text, entity_type: str) -> tuple[Column, Column]:
    """``(pieces, hits)``: the text between matches and the matches, so that
    pieces[0] + hits[0] + pieces[1] + ... + pieces[n] rebuilds the text."""
    t = col_of(text)
    pat = _jpat(PATTERNS[entity_type])
    return F.split(t, pat, -1), F.regexp_extract_all(t, pat, 0)


def rebuild_masked(pieces: Column, hits: Column, entity_type: str,
                   mask_char: str = MASK_CHAR) -> Column:
    """Interleave pieces with masked hits (position-exact replacement)."""
    masked = F.transform(hits, lambda h: mask_match(h, entity_type, mask_char))
    return F.array_join(F.zip_with(pieces, masked,
                                   lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")


def findings(pieces: Column, hits: Column, entity_type: str) -> Column:
    """``array<struct<type, start, end, original_length>>`` with offsets into
    the text the pieces/hits came from."""
    def one(h, i):
        start = _lengths_prefix(pieces, i + 1) + _lengths_prefix(hits, i)
        return F.struct(F.lit(entity_type).alias("type"), start.alias("start"),
                        (start + F.length(h)).alias("end"),
                        F.length(h).alias("original_length"))
    return F.coalesce(F.transform(hits, one), F.array().cast(FINDING_TYPE))


def mask_pass(text, entity_type: str, mask_char: str = MASK_CHAR) -> tuple[Column, Column]:
    """One masking pass as a pair of column expressions ``(masked, findings)``.

    Use :func:`mask_text_columns` to chain passes: it gives every pass its own
    projection so earlier passes are evaluated once.
    """
    pieces, hits = split_matches(text, entity_type)
    return rebuild_masked(pieces, hits, entity_type, mask_char), findings(pieces, hits, entity_type)


def mask_text_columns(df, text_col: str, out_col: str, findings_col: str,
                      entities: list[str] | None = None, mask_char: str = MASK_CHAR):
    """M6 on a DataFrame: apply the finders in fixed order, each over the
    result so far. Each pass splits once into helper columns, rebuilds the
    text, then drops the helpers, so cost is linear in the number of passes."""
    cur = F.col(text_col)
    df = df.withColumn(out_col, cur).withColumn(findings_col, F.array().cast(FINDING_TYPE))
    for et in ENTITY_TYPES:
        if entities is not None and et not in entities:
            continue
        pieces, hits = split_matches(F.col(out_col), et)
        if et in REQUIRED_CHAR:
            # cheap literal test first: no required character, no match possible
            has = F.col(out_col).contains(REQUIRED_CHAR[et])
            pieces = F.when(has, pieces).otherwise(F.array(F.col(out_col)))
            hits = F.when(has, hits).otherwise(F.array().cast("array<string>"))
        df = df.withColumns({"__pcs": pieces, "__hts": hits})
        df = df.withColumns({
            out_col: F.when(F.col(out_col).isNull(), F.lit(None).cast("string"))
                      .otherwise(rebuild_masked(F.col("__pcs"), F.col("__hts"), et, mask_char)),
            findings_col: F.concat(F.col(findings_col), findings(F.col("__pcs"), F.col("__hts"), et)),
        }).drop("__pcs", "__hts")
    return df


def mask_field(value, field_type, mask_char: str = MASK_CHAR) -> Column:
    """M8: mask a typed field; ``field_type`` is a string or a column and is
    compared case-insensitively."""
    v = col_of(value)
    ft = F.lower(F.lit(field_type) if isinstance(field_type, str) else field_type)
    d = _digits(v)
    nd = F.length(d)
    star_all = _stars(F.length(v), mask_char)
    # local part = text before the first "@", domain = everything after it
    email = F.when(F.instr(v, "@") > 0,
                   F.concat(_stars(F.instr(v, "@") - 1, mask_char), F.lit("@"),
                            F.regexp_extract(v, r"(?s)^[^@]*@(.*)$", 1))).otherwise(star_all)
    phone = F.when(nd > 4, F.concat(_stars(nd - 4, mask_char), F.substring(d, -4, 4))) \
             .otherwise(_stars(nd, mask_char))
    ssn = F.when(nd == 9, F.concat(_stars(F.lit(3), mask_char), F.lit("-"),
                                   _stars(F.lit(2), mask_char), F.lit("-"), F.substring(d, -4, 4))) \
           .otherwise(star_all)
    card = F.when(nd >= 13, F.concat(_stars(nd - 4, mask_char), F.substring(d, -4, 4))) \
            .otherwise(_stars(nd, mask_char))
    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(ft == "email", email)
             .when(ft == "phone", phone)
             .when(ft.isin("ssn", "social_security"), ssn)
             .when(ft == "credit_card", card)
             .otherwise(star_all))
