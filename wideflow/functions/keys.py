"""Business row keys: base-32 numbers, packed invoice numbers, year parts.

Failures that would abort a job in the source system (non-digit text, a cut
past the start of the code, a too-short month) yield NULL here; callers turn
NULL into a reject reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _c, is_blank, jtrim

# Spark's base-32 digits 0-9A-V are re-lettered to the
# alphabet without I, O, S, Z by shifting the letters from I onward.
_STD_FROM = "IJKLMNOPQRSTUV"
_ALPHA_TO = "JKLMNPQRTUVWXY"

_DIGITS_RE = r"^[+-]?[0-9]+$"


def base32(n, negatives: str = "unsigned") -> Column:
    """Base-32 text of a 64-bit integer (0 -> '0').

    ``negatives='unsigned'`` encodes a negative n as 2^64+n (the shift-based
    codec); ``'reject'`` gives NULL for it (the division-based codec fails on
    negatives; both agree on n >= 0). The value enters ``conv`` as its
    two's-complement hex digits, so every 64-bit value, also the most negative
    one, is read as unsigned.
    """
    n = _c(n).cast("bigint")
    out = F.translate(F.conv(F.hex(n), 16, 32), _STD_FROM, _ALPHA_TO)
    if negatives == "reject":
        return F.when(n >= 0, out)
    if negatives != "unsigned":
        raise ValueError(f"unknown negatives policy {negatives!r}")
    return out


def digits_to_long(s) -> Column:
    """Signed decimal text to bigint; NULL when not digits or out of range."""
    s = _c(s)
    return F.when(s.rlike(_DIGITS_RE), s.try_cast("bigint"))


def _code10(fpdm: Column) -> Column:
    return F.when(F.length(fpdm) > 10, F.right(fpdm, F.lit(10))).otherwise(fpdm)


def _digits(code10: Column, fphm: Column, mode: str) -> Column:
    """The packed digits from the cut code and the number (the one statement of the rule)."""
    if mode == "intended":
        return F.concat(code10, F.right(fphm, F.lit(8)))
    if mode != "compat":
        raise ValueError(f"unknown mode {mode!r}")
    cut = F.length(fphm) - 8
    long_no = F.when(cut <= F.length(code10),
                     F.concat(F.substr(code10, cut + 1, F.length(code10) + 1), fphm))
    return F.when(F.length(fphm) > 8, long_no).otherwise(F.concat(fphm, fphm))


def packed_digits(fpdm, fphm, mode: str = "compat") -> Column:
    """Digit string behind the packed invoice number.

    compat: the code is cut to its last 10 characters; then, for a number
    longer than 8, the code is cut again from position len(number)-8 and the
    whole number appended; for a shorter number the number is doubled (the
    code is ignored). NULL where the cut would start past the end of the code.
    intended: last 10 of the code followed by the last 8 of the number.
    """
    return _digits(_code10(_c(fpdm)), _c(fphm), mode)


def packed_invoice_no(fpdm, fphm, mode: str = "compat") -> Column:
    """Base-32 packed invoice number, NULL when it cannot be built."""
    return base32(digits_to_long(packed_digits(fpdm, fphm, mode)))


def _year(kpyf: Column, trimmed: Column, default_year: str | None) -> Column:
    cut = F.when(F.length(trimmed) >= 4, F.substr(trimmed, F.lit(3), F.lit(2)))
    if default_year is None:
        return F.when(~is_blank(kpyf), cut)
    return F.when(is_blank(kpyf), F.lit(default_year)).otherwise(cut)


def year_part(kpyf, default_year: str | None = None) -> Column:
    """Characters 3-4 of the trimmed month; the default when the month is blank.

    NULL (a reject) when the trimmed month is shorter than 4 characters.
    """
    kpyf = _c(kpyf)
    return _year(kpyf, jtrim(kpyf), default_year)


def header_row_key(code, yy, fpbm) -> Column:
    """Seller code + 2-digit year + packed number (NULL if any part is NULL)."""
    return F.concat(_c(code), _c(yy), _c(fpbm))


def detail_row_key(code, yy, fpbm, line_no) -> Column:
    return F.concat(_c(code), _c(yy), _c(fpbm), _c(line_no))


# Staged forms. A nested key expression reuses its parts several times
# (the cut code appears in three places, the digit string in two); written as
# one Column tree every reuse is evaluated again. Staging each part as its own
# column keeps one evaluation per row: Catalyst does not inline a non-trivial
# expression into a projection that references it more than once.

_D, _M, _A, _G, _T = "_pk_code", "_pk_no", "_pk_code10", "_pk_digits", "_pk_month"


def with_packed_invoice_no(df: DataFrame, fpdm: Column, fphm: Column, out: str,
                           mode: str = "compat") -> DataFrame:
    """Adds ``out`` = packed_invoice_no(fpdm, fphm, mode), computed in stages."""
    df = df.withColumns({_D: fpdm, _M: fphm})
    df = df.withColumn(_A, _code10(F.col(_D)))
    df = df.withColumn(_G, _digits(F.col(_A), F.col(_M), mode))
    df = df.withColumn(out, base32(digits_to_long(F.col(_G))))
    return df.drop(_D, _M, _A, _G)


def with_year_part(df: DataFrame, kpyf: Column, out: str, default_year: str | None = None) -> DataFrame:
    """Adds ``out`` = year_part(kpyf, default_year), trimming once."""
    df = df.withColumn(_T, jtrim(kpyf))
    return df.withColumn(out, _year(kpyf, F.col(_T), default_year)).drop(_T)
