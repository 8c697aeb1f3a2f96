"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each text runs on DuckDB with the base tables pre-registered as views; the
invoice views are inlined as CTEs from the same SQL the Spark side uses.
These are test artefacts: the Spark code never parses or runs them.
"""

from __future__ import annotations

from ..schema import DETAIL_COLS, HEADER_COLS, HEADER_STORED_COLS
from ..sources.fixtures import fixture_sql

JT_RE = r"'^[\x00-\x20]+|[\x00-\x20]+$'"


def jt(x: str) -> str:
    """Java-style trim."""
    return f"regexp_replace({x}, {JT_RE}, '', 'g')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {x} IN ('', 'null'))"


def blank_no(x: str) -> str:
    return f"({x} IS NULL OR {x} IN ('', 'null', 'no'))"


def nb(x: str) -> str:
    """NULL when blank."""
    return f"(CASE WHEN {blank(x)} THEN NULL ELSE {x} END)"


def fill_m1(x: str) -> str:
    return f"(CASE WHEN {blank(x)} THEN '-1' ELSE {x} END)"


def fill_nw(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN 'null' ELSE {x} END)"


def b32(n: str) -> str:
    return f"translate(to_base({n}, 32), 'IJKLMNOPQRSTUV', 'JKLMNPQRTUVWXY')"


def to_long(d: str) -> str:
    return f"(CASE WHEN regexp_full_match({d}, '[+-]?[0-9]+') THEN TRY_CAST({d} AS BIGINT) END)"


def packed_digits(d: str, m: str, mode: str = "compat") -> str:
    a = f"(CASE WHEN length({d}) > 10 THEN right({d}, 10) ELSE {d} END)"
    if mode == "intended":
        return f"({a} || right({m}, 8))"
    return (f"(CASE WHEN length({m}) > 8 THEN (CASE WHEN length({m}) - 8 <= length({a}) "
            f"THEN substr({a}, length({m}) - 7) || {m} END) ELSE {m} || {m} END)")


def fpbm(d: str, m: str, mode: str = "compat") -> str:
    return b32(to_long(packed_digits(d, m, mode)))


def year(k: str, default: str | None) -> str:
    cut = f"(CASE WHEN length({jt(k)}) >= 4 THEN substr({jt(k)}, 3, 2) END)"
    if default is None:
        return f"(CASE WHEN NOT {blank(k)} THEN {cut} END)"
    return f"(CASE WHEN {blank(k)} THEN '{default}' ELSE {cut} END)"


def fixtures_cte(*names: str) -> str:
    return ",\n".join(f"{n} AS ({fixture_sql(n)})" for n in names)


def lookups_cte() -> str:
    """Unique lookups: one row per non-empty key, greatest code on duplicates."""
    return (fixtures_cte("code_by_name", "code_by_tax") + ",\n"
            "nm AS (SELECT row_key, max(qybm) AS qybm FROM code_by_name WHERE row_key IS NOT NULL AND row_key <> '' GROUP BY row_key),\n"
            "tx AS (SELECT row_key, max(qybm) AS qybm FROM code_by_tax WHERE row_key IS NOT NULL AND row_key <> '' GROUP BY row_key)")


HEADER21 = ", ".join(HEADER_COLS)
HEADER24 = ", ".join(HEADER_STORED_COLS)
DETAIL16 = ", ".join(DETAIL_COLS)


def seller(rule: str) -> str:
    found = lambda x: f"({x} IS NOT NULL AND {x} <> 'null')"
    if rule == "standard":
        return f"COALESCE({nb('n_code')}, {nb('t_code')}, '-1')"
    if rule == "keep_empty":
        return f"(CASE WHEN {found('n_code')} THEN n_code WHEN {found('t_code')} THEN t_code ELSE '-1' END)"
    return f"(CASE WHEN {found('n_code')} THEN n_code ELSE t_code END)"


def buyer(rule: str) -> str:
    if rule == "nullable":
        return f"(CASE WHEN {blank(jt('gfmc'))} THEN '' ELSE b_code END)"
    return f"(CASE WHEN {blank(jt('gfmc'))} THEN '-1' ELSE COALESCE({nb('b_code')}, '-1') END)"


def enriched_cte(rule: str = "standard", variant: str = "load", lookups: str | None = None) -> str:
    """CTE ``enr``: gated header rows with source, gfqybm, xfqybm."""
    bl = blank_no if variant == "preview" else blank
    gate = f"NOT {bl('xfmc')} AND NOT contains(xfmc, '?') AND NOT {bl('xfsbh')}"
    return ((lookups or lookups_cte()) + ",\n" + fixtures_cte("inv_header") + ",\n"
            f"g AS (SELECT * FROM inv_header WHERE {gate}),\n"
            "lk AS (SELECT g.*, n.qybm AS n_code, t.qybm AS t_code, b.qybm AS b_code FROM g\n"
            f"  LEFT JOIN nm n ON n.row_key = {jt('g.xfmc')}\n"
            f"  LEFT JOIN tx t ON t.row_key = {jt('g.xfsbh')}\n"
            f"  LEFT JOIN nm b ON b.row_key = {jt('g.gfmc')} AND NOT {blank(jt('g.gfmc'))}),\n"
            f"enr AS (SELECT {HEADER21}, 'hive' AS source, {buyer(rule)} AS gfqybm, {seller(rule)} AS xfqybm FROM lk)")


def header_keyed_cte(year_default: str = "16", mode: str = "compat", rule: str = "standard",
                     variant: str = "load", lookups: str | None = None) -> str:
    """CTE ``hk``: accepted header rows with row_key."""
    if variant == "preview":
        keep = "xfqybm IS NOT NULL AND xfqybm <> 'null'"
    else:
        keep = "xfqybm <> '-1'"
    yy = year("kpyf", year_default)
    pb = fpbm(jt("fpdm"), jt("fphm"), mode)
    return (enriched_cte(rule, variant, lookups) + ",\n"
            f"k AS (SELECT *, {yy} AS yy, {pb} AS fpbm FROM enr WHERE {keep} AND NOT {blank('fpdm')} AND NOT {blank('fphm')}),\n"
            f"hk AS (SELECT {jt('xfqybm')} || yy || fpbm AS row_key, {HEADER24} FROM k WHERE yy IS NOT NULL AND fpbm IS NOT NULL)")


def with_(cte: str, select: str) -> str:
    return f"WITH {cte}\n{select}"


def detail_keyed_cte(mode: str = "compat", lookups: str | None = None) -> str:
    """CTEs ``dg`` (gated lines), ``dl`` (with code), ``dk0`` (key parts), ``dk`` (accepted)."""
    gate = " AND ".join([f"NOT {blank(c)}" for c in ("xf_nsrsbh", "fpdm", "fphm", "fpmxxh", "kpyf")]
                        + ["length(kpyf) > 4"])
    key = f"(xfqybm || yy || fpbm || {jt('fpmxxh')})"
    return ((lookups or lookups_cte()) + ",\n" + fixtures_cte("inv_detail") + ",\n"
            f"dg AS (SELECT * FROM inv_detail WHERE {gate}),\n"
            f"dl AS (SELECT dg.* REPLACE ('hive' AS sjly), COALESCE({nb('t.qybm')}, '-1') AS xfqybm FROM dg "
            f"LEFT JOIN tx t ON t.row_key = {jt('dg.xf_nsrsbh')}),\n"
            f"dk0 AS (SELECT *, {year('kpyf', None)} AS yy, {fpbm(jt('fpdm'), jt('fphm'), mode)} AS fpbm FROM dl),\n"
            f"dk AS (SELECT {key} AS row_key, {DETAIL16}, xfqybm FROM dk0 WHERE yy IS NOT NULL AND fpbm IS NOT NULL "
            f"AND xfqybm <> '-1' AND NOT contains({key}, '-'))")


def unpivot_sql(src: str, cols: str, family: str, fill=None, key: str = "row_key") -> str:
    parts = []
    for c in [x.strip() for x in cols.split(",")]:
        v = fill(c) if fill else c
        parts.append(f"SELECT {key} AS row_key, '{family}' AS family, '{c}' AS qualifier, {v} AS value FROM {src}")
    return "\nUNION ALL\n".join(parts)


def latest_sql(src: str, part: str = "row_key, family, qualifier",
               cols: str = "row_key, family, qualifier, ts, seq, value") -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {part} "
            f"ORDER BY ts DESC NULLS LAST, seq DESC NULLS LAST, value DESC NULLS LAST) AS rn_ FROM {src}) WHERE rn_ = 1")


def dedupe_sql(src: str, key: str, order_cols: str, cols: str) -> str:
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in order_cols.split(","))
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn_ "
            f"FROM {src}) WHERE rn_ = 1")
