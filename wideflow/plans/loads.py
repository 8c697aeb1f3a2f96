"""Invoice loads: clean -> resolve codes -> build row key, with a reject reason per row.

One lazy plan per load. Every input row gets exactly one outcome: accepted
(``reject_reason`` NULL, ``row_key`` set) or rejected with the first failing
rule in the source jobs' evaluation order, so accepted + rejected = input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keys import detail_row_key, header_row_key, with_packed_invoice_no, with_year_part
from ..functions.text import MINUS_ONE, is_blank, is_blank_or_no, jtrim
from ..operators.enrich import header_codes, seller_code_by_tax
from ..schema import DETAIL_COLS, HEADER_STORED_COLS, SOURCE_TAG

REJECT = "reject_reason"
#: Every reason that a load may give.
REASONS = ("blank_seller_name", "garbled_seller_name", "blank_seller_tax_id", "unresolved_seller", "blank_invoice_code", "blank_invoice_no",
           "blank_line_no", "short_month", "bad_month", "bad_invoice_no", "dash_in_key")


def header_gate(variant: str = "load") -> Column:
    """Seller name and tax id present, name not garbled ('?').

    ``preview`` also treats 'no' as missing (the early preview jobs).
    """
    blank = is_blank_or_no if variant == "preview" else is_blank
    return ~blank(F.col("xfmc")) & ~F.col("xfmc").contains("?") & ~blank(F.col("xfsbh"))


def _header_gate_reason(variant: str) -> Column:
    blank = is_blank_or_no if variant == "preview" else is_blank
    return (F.when(blank(F.col("xfmc")), "blank_seller_name")
            .when(F.col("xfmc").contains("?"), "garbled_seller_name")
            .when(blank(F.col("xfsbh")), "blank_seller_tax_id"))


def enrich_header(header: DataFrame, by_name: DataFrame, by_tax: DataFrame,
                  rule: str = "standard", variant: str = "load") -> DataFrame:
    """The 21 header columns + source, gfqybm, xfqybm for rows passing the gate."""
    gate = header_gate(variant)
    out = header_codes(header.filter(gate), by_name, by_tax, rule=rule)
    return out.withColumn("source", F.lit(SOURCE_TAG)).select(*HEADER_STORED_COLS)


def tag_header(header: DataFrame, by_name: DataFrame, by_tax: DataFrame, year: str,
               mode: str = "compat", rule: str = "standard", variant: str = "load") -> DataFrame:
    """All input rows, enriched, with ``row_key`` and ``reject_reason``.

    variant ``load``: gate, drop seller '-1', require code and number, year
    from the trimmed month or ``year`` when blank.
    variant ``preview``: 'no' is also missing, only a NULL/'null' seller code
    is dropped (so '-1' passes).
    """
    gate = header_gate(variant)
    # Key parts first, as staged columns below the lookup join: the acceptance
    # filter (which needs the joined seller code) stops at the join, so it sees
    # these as plain columns instead of re-inlining their expressions.
    df = with_year_part(header, F.col("kpyf"), "_yy", year)
    df = with_packed_invoice_no(df, jtrim(F.col("fpdm")), jtrim(F.col("fphm")), "_fpbm", mode)
    df = header_codes(df, by_name, by_tax, rule=rule, gate=gate)
    df = df.withColumn("source", F.when(gate, F.lit(SOURCE_TAG)))
    if variant == "preview":
        unresolved = F.col("xfqybm").isNull() | (F.col("xfqybm") == "null")
    else:
        unresolved = F.col("xfqybm") == MINUS_ONE
    reason = (_header_gate_reason(variant)
              .when(unresolved, "unresolved_seller")
              .when(is_blank(F.col("fpdm")), "blank_invoice_code")
              .when(is_blank(F.col("fphm")), "blank_invoice_no")
              .when(F.col("_yy").isNull(), "bad_month")
              .when(F.col("_fpbm").isNull(), "bad_invoice_no"))
    key = header_row_key(jtrim(F.col("xfqybm")), F.col("_yy"), F.col("_fpbm"))
    return (df.withColumn(REJECT, reason)
            .withColumn("row_key", F.when(F.col(REJECT).isNull(), key))
            .select("row_key", *HEADER_STORED_COLS, REJECT))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REJECT).isNotNull())


def header_keyed(header, by_name, by_tax, year: str = "16", mode: str = "compat") -> DataFrame:
    """Accepted header rows: row_key + the 24 stored columns (values unfilled)."""
    return accepted(tag_header(header, by_name, by_tax, year, mode))


def detail_gate() -> Column:
    """Seller tax id, code, number and line number present; month longer than 4."""
    return (~is_blank(F.col("xf_nsrsbh")) & ~is_blank(F.col("fpdm")) & ~is_blank(F.col("fphm"))
            & ~is_blank(F.col("fpmxxh")) & ~is_blank(F.col("kpyf")) & (F.length(F.col("kpyf")) > 4))


def tag_detail(detail: DataFrame, by_tax: DataFrame, mode: str = "compat") -> DataFrame:
    """All line rows with ``sjly`` set to the source tag, ``xfqybm``, ``row_key`` and ``reject_reason``.

    The key is code + year + packed number + trimmed line number; a key with a
    '-' anywhere is dropped (an unresolved '-1' code, or a dash in the line
    number or month).
    """
    gate = detail_gate()
    # key parts below the lookup join (see tag_header)
    df = with_year_part(detail, F.col("kpyf"), "_yy")
    df = with_packed_invoice_no(df, jtrim(F.col("fpdm")), jtrim(F.col("fphm")), "_fpbm", mode)
    df = df.withColumn("_line", jtrim(F.col("fpmxxh")))
    df = seller_code_by_tax(df, by_tax, gate=gate).withColumn("sjly", F.lit(SOURCE_TAG))
    df = df.withColumn("_key", detail_row_key(F.col("xfqybm"), F.col("_yy"), F.col("_fpbm"), F.col("_line")))
    reason = (F.when(is_blank(F.col("xf_nsrsbh")), "blank_seller_tax_id")
              .when(is_blank(F.col("fpdm")), "blank_invoice_code")
              .when(is_blank(F.col("fphm")), "blank_invoice_no")
              .when(is_blank(F.col("fpmxxh")), "blank_line_no")
              .when(is_blank(F.col("kpyf")) | (F.length(F.col("kpyf")) <= 4), "short_month")
              .when(F.col("_yy").isNull(), "bad_month")
              .when(F.col("_fpbm").isNull(), "bad_invoice_no")
              .when(F.col("xfqybm") == MINUS_ONE, "unresolved_seller")
              .when(F.col("_key").contains("-"), "dash_in_key"))
    return (df.withColumn(REJECT, reason)
            .withColumn("row_key", F.when(F.col(REJECT).isNull(), F.col("_key")))
            .select("row_key", *DETAIL_COLS, "xfqybm", REJECT))


def detail_keyed(detail, by_tax, mode: str = "compat") -> DataFrame:
    """Accepted line rows: row_key + the 16 line columns (sjly = source tag) + xfqybm."""
    return accepted(tag_detail(detail, by_tax, mode))


def observed(tagged: DataFrame) -> tuple[DataFrame, Observation]:
    """``tagged`` with its outcomes counted by the pass that writes it: ``rows``, ``accepted`` and one count per reason.

    Observe what a write's last stage produces: Spark counts a task of that stage once, however often it is run.
    """
    counts = Observation()
    reason = F.col(REJECT)
    return tagged.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(reason.isNull()).alias("accepted"),
                          *[F.count_if(reason == r).alias(r) for r in REASONS]), counts


def reject_counts(tagged: DataFrame) -> DataFrame:
    """Rows per outcome ('accepted' or the reject reason)."""
    return (tagged.groupBy(F.coalesce(F.col(REJECT), F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n")))
