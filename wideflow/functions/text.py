"""Blank tests, trimming, fills, hashing and tokens as Column expressions.

All of these compile to JVM expressions inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of "missing" used by the source jobs.
BLANK_WORDS = ["", "null"]
BLANK_WORDS_WITH_NO = ["", "null", "no"]
MINUS_ONE = "-1"
NULL_WORD = "null"

# Java's String.trim strips every char <= U+0020 from both ends.
JAVA_WS = "".join(chr(i) for i in range(0x21))

# The 32-symbol alphabet without I, O, S, Z.
ALPHABET32 = "0123456789ABCDEFGHJKLMNPQRTUVWXY"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """True for NULL, '' and 'null'; never NULL itself."""
    c = _c(c)
    return c.isNull() | c.isin(*BLANK_WORDS)


def is_blank_or_no(c) -> Column:
    c = _c(c)
    return c.isNull() | c.isin(*BLANK_WORDS_WITH_NO)


def not_blank(c) -> Column:
    return ~is_blank(c)


def jtrim(c) -> Column:
    """Java-style trim: control characters and spaces at both ends.

    ``btrim`` with a character set takes the whole text apart; only a text that begins or ends with such a character
    (all sort before '!') goes through it.
    """
    c = _c(c)
    return F.when((c < "!") | (F.right(c, F.lit(1)) < "!"), F.btrim(c, F.lit(JAVA_WS))).otherwise(c)


def fill_minus_one(c) -> Column:
    """NULL, '' and 'null' become '-1'."""
    c = _c(c)
    return F.when(is_blank(c), F.lit(MINUS_ONE)).otherwise(c)


def fill_null_word(c) -> Column:
    """NULL and '' become 'null'."""
    c = _c(c)
    return F.when(c.isNull() | (c == ""), F.lit(NULL_WORD)).otherwise(c)


FILLS = {"-1": fill_minus_one, "null": fill_null_word}


def nonblank_or_null(c) -> Column:
    """The value when it is not blank, else NULL (so coalesce chains skip it)."""
    c = _c(c)
    return F.when(is_blank(c), F.lit(None).cast("string")).otherwise(c)


def md5_hex(c, salt: str | None = None) -> Column:
    """Lower-case MD5 hex of the UTF-8 text, NULL in, NULL out."""
    c = _c(c)
    if salt:
        c = F.concat(c, F.lit(salt))
    return F.md5(c.cast("binary"))


def token32(length: int, seed: int = 7, key: Column | None = None) -> Column:
    """A token of ``length`` symbols from the 32-symbol alphabet.

    With ``key`` the token is a repeatable function of the key (two hex digits of
    the key's MD5 per position, for up to 16 symbols); without it each position draws from ``rand`` with seeds spread
    far apart, so neighbouring positions are not the same stream shifted.
    """
    picks = []
    if key is not None and length > 16:
        raise ValueError("a stable token has at most 16 symbols")
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary")) if key is not None else None
    for i in range(length):
        if key is not None:
            idx = F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int") % 32
        else:
            idx = F.floor(F.rand(seed + i * 1000003) * 32).cast("int")
        picks.append(F.substr(F.lit(ALPHABET32), idx + 1, F.lit(1)))
    return F.concat(*picks)
