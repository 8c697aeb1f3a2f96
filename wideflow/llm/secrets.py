"""Secret scans over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query of trigrams that every match
must hold (in lower case). The index keeps, for each trigram that any rule asks for,
the rows whose text holds it; intersecting these postings gives each rule's candidates, and
only they are scanned with the rule. Rules without mandatory trigrams scan all texts.

Only DataFrame functions run on the texts. Spans come from what a pattern matches and
what lies between its matches, so they count code points, with an exclusive end.

Defined cases: a null text counts as empty and has no spans; null ids and repeated rows
are scanned like any other (postings are kept by a hash of id and text: a clash could only add a
candidate); equal starts are ordered as the rules are listed; an empty table gives no rows;
columns other than id and text pass through unread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, small_enough, staged, text_or_empty

#: Candidate lists of up to so many rows are broadcast; beyond it the texts are shuffled to them.
BROADCAST_CANDIDATES = 500_000
#: Alternatives that a query keeps apart; beyond it a part of the pattern asks for nothing.
MAX_STRINGS = 16
#: Matches of a text whose spans are gathered in one array before they are joined to the others. Growing an array copies it, so
#: a text of n matches costs n * RUN / 2 + (n / RUN) ** 2 / 2 copied elements instead of n * n / 2.
RUN = 256


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; those whose ``group`` is shorter than ``min_chars`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 0


# Fixed values of the contract's base kinds. The last two ask for whole runs, so a minimum
# length inside the pattern finds the same matches as a filter after it.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Public formats of credentials.
FORMAT_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("login_url", r"[a-z]{2,8}://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._-]{3,64}@"),
)
RULES = BASE_RULES + FORMAT_RULES

# A query is a set of conjunctions, each a set of trigrams; one of them has to hold.
_ALL = frozenset([frozenset()])


def _and(a, b):
    both = frozenset(x | y for x in a for y in b)
    return both if len(both) <= MAX_STRINGS else min(a, b, key=len)


def _of_strings(strings) -> frozenset:
    return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def trigram_query(pattern: str) -> frozenset:
    """Conjunctions of lower-case trigrams, one of which every text with a match holds; {{}} asks for nothing."""
    from re import _constants as c
    from re import _parser as parser

    def walk(items):
        """(strings, query): all that the items match, if few (else None), and what they ask for."""
        query, run, finite = _ALL, {""}, True
        for op, arg in items:
            strings, own = part(op, arg)
            if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
                run = {x + y for x in run for y in strings}
                continue
            query, finite = _and(query, _of_strings(run)), False
            if strings is not None:
                run = set(strings)
            else:
                query, run = _and(query, own), {""}
        return (run if finite else None), _and(query, _of_strings(run))

    def part(op, arg):
        if op is c.LITERAL:
            return {chr(arg).lower()}, _ALL
        if op is c.SUBPATTERN:
            return walk(arg[3])
        if op is c.IN:
            chars = {chr(v).lower() for o, v in arg if o is c.LITERAL}
            small = all(o is c.LITERAL for o, _ in arg) and len(chars) <= 8
            return (chars if small else None), _ALL
        if op is c.BRANCH:
            options = [walk(x) for x in arg[1]]
            if all(s is not None for s, _ in options):
                return set().union(*(s for s, _ in options)), _ALL
            queries = frozenset().union(*(q for _, q in options))
            return None, _ALL if frozenset() in queries else queries
        if op in (c.MAX_REPEAT, c.MIN_REPEAT):
            low, high, inner = arg
            strings, query = walk(inner)
            if (low, high) == (0, 1) and strings is not None:
                return strings | {""}, _ALL
            if low == high == 1:
                return strings, query
            return None, (_and(query, _of_strings(strings)) if strings is not None else query) if low else _ALL
        return None, _ALL

    got = walk(parser.parse(pattern))[1]
    return _ALL if frozenset() in got else got


def _row_key(id_col: str, text: str) -> Column:
    return F.xxhash64(F.col(id_col), text_or_empty(text))


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The index: ``(trigram, row)`` for each of ``trigrams`` that a row's lower-case text holds."""
    low = docs.select(_row_key(id_col, text).alias("row"), ascii_lower(text_or_empty(text)).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("row", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, kinds)``: the rules whose query a row's trigrams answer; rules that ask for nothing are left out."""
    spark = docs.sparkSession
    asked = [(r.kind, i, len(conj), t) for r in rules for i, conj in enumerate(sorted(map(sorted, trigram_query(r.pattern)))) for t in conj]
    index = staged(postings(docs, sorted({a[3] for a in asked}), id_col, text).distinct(), "secret-postings")
    wanted = spark.createDataFrame(asked, "kind string, conj int, need int, trigram string")  # a few rows per rule
    met = (index.join(F.broadcast(wanted), "trigram").groupBy("row", "kind", "conj", "need").agg(F.count("*").alias("n"))
           .where("n = need"))
    return met.groupBy("row").agg(F.collect_set("kind").alias("kinds"))


def _rule_spans(rule: Rule, number: int, text: Column) -> Column:
    """Array of (start, number, end, kind) of a rule's matches in a text."""
    pattern = F.lit(rule.pattern)
    found, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern)
    sizes = F.transform(F.arrays_zip(found.alias("m"), between.alias("g"), F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("v")),
                        lambda z: F.struct(F.length(z["m"]).alias("m"), F.length(z["g"]).alias("g"), F.length(z["v"]).alias("v")))
    none = F.array().cast("array<struct<start:int,rule:int,end:int,kind:string>>")
    begins = F.array().cast("array<int>")

    def step(s, z):
        start = s["at"] + z["g"]
        span = F.struct(start.alias("start"), F.lit(number).alias("rule"), (start + z["m"]).alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct((start + z["m"]).alias("at"), F.when(z["v"] >= rule.min_chars, F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    def run_of(run):  # the spans of a run of matches that follow a place
        return F.aggregate(run["z"], F.struct(run["at"].alias("at"), none.alias("spans")), step, lambda s: s["spans"])

    def place(s, run):
        long = F.aggregate(run, F.lit(0), lambda n, z: n + z["m"] + z["g"])
        return F.struct((s["at"] + long).alias("at"), F.concat(s["begins"], F.array(s["at"])).alias("begins"))

    def spans_of(runs):
        at = F.aggregate(runs, F.struct(F.lit(0).alias("at"), begins.alias("begins")), place, lambda s: s["begins"])
        return F.flatten(F.transform(F.arrays_zip(runs.alias("z"), at.alias("at")), run_of))

    def runs_of(z):
        count = F.ceil(F.size(z) / RUN).cast("int")
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(z, i * RUN + 1, RUN))).otherwise(
            F.array().cast("array<array<struct<m:int,g:int,v:int>>>"))

    # The last part between matches has no match: its sizes are null there and end the sum.
    matches = F.filter(sizes, lambda z: z["m"].isNotNull())
    return _bound(_bound(matches, runs_of), spans_of)


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once, however often it is used, in lambdas too."""
    return F.transform(F.array(value), use)[0]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All of ``docs`` with ``spans``: an array of (start, rule, end, kind), ordered by start, then rule."""
    found = staged(candidates(docs, rules, id_col, text), "secret-candidates").withColumnsRenamed({"row": "_sc_row", "kinds": "_sc_kinds"})
    side = F.broadcast(found) if small_enough(found, BROADCAST_CANDIDATES) else found
    joined = docs.join(side, _row_key(id_col, text) == F.col("_sc_row"), "left").withColumn("_sc_text", text_or_empty(text))
    t = F.col("_sc_text")
    none = F.array().cast("array<struct<start:int,rule:int,end:int,kind:string>>")
    parts = []
    for i, r in enumerate(rules):
        asked = F.lit(True) if trigram_query(r.pattern) == _ALL else F.coalesce(F.array_contains("_sc_kinds", r.kind), F.lit(False))
        parts.append(F.when(asked & t.rlike(r.pattern), _rule_spans(r, i, t)).otherwise(none))
    return joined.withColumn("spans", F.sort_array(F.concat(*parts))).drop("_sc_row", "_sc_kinds", "_sc_text")


def span_list(spans: Column, kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` of an ordered span array, comma-joined; of the given kinds only, if any are given."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
