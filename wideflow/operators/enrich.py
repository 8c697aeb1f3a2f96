"""Company-code resolution for invoice rows (seller and buyer codes).

Three rule sets exist in the source jobs and are kept selectable:

* ``standard``: seller = code by trimmed name, else by trimmed tax id, else
  '-1' (a blank code - NULL, '' or 'null' - counts as missing); buyer = code
  by trimmed name, '-1' when the trimmed name or the code is blank.
* ``keep_empty``: like standard, but only NULL and 'null' send the seller to
  the fallback, so an empty code counts as found.
* ``nullable``: no '-1' default; the seller is the tax-id result as is (NULL
  when absent); the buyer is '' for a blank trimmed name and the raw code
  (NULL when absent) otherwise.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MINUS_ONE, is_blank, jtrim, nonblank_or_null
from .lookup import NO_KEY, lookup_columns

RULES = ("standard", "keep_empty", "nullable")

_NK, _TK, _BK = "_name_key", "_tax_key", "_buyer_key"


def _key(c: Column, when_ok: Column | None = None, blank_test=None) -> Column:
    t = F.coalesce(jtrim(c), F.lit(NO_KEY))
    ok = [when_ok] if when_ok is not None else []
    if blank_test is not None:
        ok.append(~blank_test(t))
    return F.when(reduce(and_, ok), t).otherwise(F.lit(NO_KEY)) if ok else t


def _found(c: Column) -> Column:
    return c.isNotNull() & (c != "null")


def seller_expr(n: Column, t: Column, rule: str) -> Column:
    if rule == "standard":
        return F.coalesce(nonblank_or_null(n), nonblank_or_null(t), F.lit(MINUS_ONE))
    if rule == "keep_empty":
        return F.when(_found(n), n).when(_found(t), t).otherwise(F.lit(MINUS_ONE))
    if rule == "nullable":
        return F.when(_found(n), n).otherwise(t)
    raise ValueError(f"unknown rule {rule!r}")


def buyer_expr(bk: Column, b: Column, rule: str) -> Column:
    if rule == "nullable":
        return F.when(bk == NO_KEY, F.lit("")).otherwise(b)
    return F.when(bk == NO_KEY, F.lit(MINUS_ONE)).otherwise(
        F.coalesce(nonblank_or_null(b), F.lit(MINUS_ONE)))


def header_codes(df: DataFrame, by_name: DataFrame, by_tax: DataFrame,
                 rule: str = "standard", gate: Column | None = None, max_bytes: int | None = None) -> DataFrame:
    """Adds ``gfqybm`` (buyer) and ``xfqybm`` (seller) codes.

    ``gate`` marks the rows that will be looked up; rows outside it get NULL
    codes and are looked up nowhere. ``max_bytes`` overrides the session's
    bound for broadcasting a lookup.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    keyed = df.withColumns({
        _NK: _key(F.col("xfmc"), gate),
        _TK: _key(F.col("xfsbh"), gate),
        _BK: _key(F.col("gfmc"), gate, blank_test=is_blank),
    })
    codes = [buyer_expr(F.col(_BK), F.col("_b"), rule).alias("gfqybm"),
             seller_expr(F.col("_n"), F.col("_t"), rule).alias("xfqybm")]
    # each lookup is planned on its own; seller and buyer names share one dictionary
    out = lookup_columns(keyed, by_name, {_NK: "_n", _BK: "_b"}, max_bytes)
    out = lookup_columns(out, by_tax, {_TK: "_t"}, max_bytes, probes=keyed)
    out = out.select(*keyed.columns, *codes)
    if gate is not None:
        # rows outside the gate have blank keys; they carry no codes
        out = out.withColumns({c: F.when(gate, F.col(c)) for c in ("gfqybm", "xfqybm")})
    return out.drop(_NK, _TK, _BK)


def seller_code_by_tax(df: DataFrame, by_tax: DataFrame, tax_col: str = "xf_nsrsbh",
                       out_col: str = "xfqybm", gate: Column | None = None) -> DataFrame:
    """Line-item seller code by trimmed tax id; blank or absent -> '-1'."""
    keyed = df.withColumn(_TK, _key(F.col(tax_col), gate))
    code = F.coalesce(nonblank_or_null(F.col("_t")), F.lit(MINUS_ONE)).alias(out_col)
    return lookup_columns(keyed, by_tax, {_TK: "_t"}).select(*keyed.columns, code).drop(_TK)
