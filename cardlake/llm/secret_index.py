"""Secret scan behind a trigram inverted index, in DataFrame operations only.

For every rule a Boolean query over trigrams is derived from its regular expression: an
``or`` of ``and``s, one for each way its literal parts can read. The index holds, for each
trigram that some rule needs, the postings of the documents with it (lower-cased), in
segments of documents, so the postings of a frequent trigram are many short lists.
Postings are intersected and united by segment; the surviving documents are verified with
the rule's own regular expression. Rules without mandatory trigrams scan every text.

Spans are code points, end exclusive, found left to right without overlap for each kind; matches
that fail the kind's length rule are dropped.

Defined results: a null text is an empty one (no spans; the digest of the empty string).
Null ids, repeated ids and repeated rows are passed through row by row: a row is looked up by a
hash of its id and text, and a clash of hashes could only add a candidate. Other columns of the
input are carried where a caller asks for them and never read by name otherwise. An empty table
gives no rows.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.tables import parallelism

SEGMENTS_PER_PARTITION = 16
_SPELLINGS = 64  # literal spellings followed at once while deriving trigrams
_CLASS = 8  # characters of a class that are spelled out


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 0
    base: bool = False


# The base kinds (their order breaks ties), then the method's own.
RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
         r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]+", 0, 16, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[A-Za-z0-9._~-]{1,64}:[A-Za-z0-9._~!-]{3,64}@"),
)
REDACTED = "[SECRET]"
#: Characters of a block of a text that is cut at many places.
BLOCK = 1024

Query = frozenset  # of clauses (frozensets of trigrams); an empty clause is always true
ALWAYS: Query = frozenset({frozenset()})


def _either(a: Query, b: Query) -> Query:
    """``a or b``, without clauses that another clause implies."""
    both = a | b
    return frozenset(c for c in both if not any(d < c for d in both))


def _both(a: Query, b: Query) -> Query:
    return _either(frozenset(c | d for c in a for d in b), frozenset())


def _spelled(strings: set[str]) -> Query:
    """Some of ``strings`` occurs: its trigrams all occur."""
    out: Query = frozenset()
    for s in strings:
        low = s.lower()
        out = _either(out, frozenset({frozenset(low[i: i + 3] for i in range(len(low) - 2))}))
    return out


def _class_spellings(items: list) -> set[str] | None:
    chars: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            chars.add(chr(arg).lower())
        elif op is sre.RANGE and arg[1] - arg[0] < _CLASS:
            chars.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
        if len(chars) > _CLASS:
            return None
    return chars


def _derive(items) -> tuple[set[str] | None, Query]:
    """All spellings of a parsed sequence (lower case; None if too many), and the query
    that any match satisfies."""
    query = ALWAYS
    run: set[str] = {""}  # spellings since the last part that could not be spelled out
    whole = True
    for op, arg in items:
        part: set[str] | None = None
        inner = ALWAYS
        if op is sre.LITERAL:
            part = {chr(arg).lower()}
        elif op is sre.IN:
            part = _class_spellings(arg)
        elif op is sre.SUBPATTERN:
            part, inner = _derive(arg[-1])
        elif op is sre.BRANCH:
            ways = [_derive(b) for b in arg[1]]
            inner = frozenset()
            for _, q in ways:
                inner = _either(inner, q)
            if all(s is not None for s, _ in ways):
                part = set().union(*(s for s, _ in ways))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            strings, q = _derive(body)
            inner = q if low else ALWAYS
            if strings is not None and high <= 4:
                part = {"".join(p) for k in range(low, high + 1) for p in product(strings, repeat=k)}
        joined = {a + b for a in run for b in part} if part is not None else None
        if joined is not None and len(joined) <= _SPELLINGS:
            run = joined
        else:
            query = _both(_both(query, _spelled(run)), inner)
            run, whole = {""}, False
    return (run if whole else None), _both(query, _spelled(run))


def trigram_query(pattern: str) -> Query:
    """The trigram query of a regular expression; ``ALWAYS`` if it has no mandatory trigram."""
    query = _derive(sre_parser.parse(pattern))[1]
    return ALWAYS if frozenset() in query else query


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, also where lambdas repeat it."""
    return F.transform(F.array(value), body)[0]


def _matches(text: Column, rule: Rule) -> Column:
    """Array of (gap before the match, match, whether it passes the length rule)."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    return _let(found, lambda m: F.zip_with(
        F.arrays_zip(F.slice(F.split(text, rule.pattern, -1), 1, F.size(m)).alias("gap"), m.alias("hit")), judged,
        lambda x, j: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"),
                              (F.length(j) >= F.lit(rule.least)).alias("ok"))))


_SPAN = "array<struct<start:int,no:int,end:int,kind:string>>"
_STEP = 64


def _spans(text: Column, no: int, rule: Rule) -> Column:
    """Passing matches as (start, rule number, end, kind). Starts are running sums of gap and match
    lengths, taken in blocks so that a text with very many matches stays cheap."""

    def width(x: Column) -> Column:
        return F.length(x["gap"]) + F.length(x["hit"])

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda acc, x: acc + width(x))

    def place(blocks: Column, offsets: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda block, b: F.transform(block, lambda x, i: _let(
            offsets[b] + total(F.slice(block, F.lit(1), i)) + F.length(x["gap"]),
            lambda start: F.struct(start.alias("start"), F.lit(no).alias("no"),
                                   (start + F.length(x["hit"])).alias("end"), F.lit(rule.kind).alias("kind"),
                                   x["ok"].alias("ok"))))))

    def spans_of(parts: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / F.lit(_STEP)).cast("int")),
            lambda b: F.slice(parts, b * F.lit(_STEP) + F.lit(1), F.lit(_STEP)))
        return _let(blocks, lambda bs: _let(
            F.aggregate(bs, F.array(F.lit(0)),
                        lambda acc, block: F.concat(acc, F.array(F.element_at(acc, -1) + total(block)))),
            lambda offsets: place(bs, offsets)))

    empty = F.array().cast("array<struct<start:int,no:int,end:int,kind:string,ok:boolean>>")
    found = _let(_matches(text, rule), lambda parts: F.when(F.size(parts) > 0, spans_of(parts)).otherwise(empty))
    return F.transform(F.filter(found, lambda s: s["ok"]), lambda s: F.struct(
        s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"), s["kind"].alias("kind")))


def candidates(keyed: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``row_key, rule_nos``: rows that satisfy the trigram query of at least one rule, from
    intersected postings. ``keyed`` has ``row_key`` and ``text``."""
    wanted = {n: q for n, r in enumerate(rules) if (q := trigram_query(r.pattern)) != ALWAYS}
    grams = sorted({t for q in wanted.values() for c in q for t in c})
    segments = SEGMENTS_PER_PARTITION * parallelism(keyed.sparkSession)
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    postings = keyed.select("row_key", F.lower("text").alias("low")).select(
        "row_key", F.explode(present).alias("gram")).groupBy(
        F.pmod("row_key", F.lit(segments)).alias("segment"), "gram").agg(F.collect_set("row_key").alias("rows"))
    index = postings.groupBy("segment").agg(
        F.map_from_entries(F.collect_list(F.struct("gram", "rows"))).alias("postings"))

    def listed(gram: str) -> Column:
        return F.coalesce(F.element_at("postings", F.lit(gram)), F.array().cast("array<bigint>"))

    def meets(query: Query) -> Column:
        out = None
        for clause in sorted(query, key=sorted):
            rows = None
            for gram in sorted(clause):
                rows = listed(gram) if rows is None else F.array_intersect(rows, listed(gram))
            out = rows if out is None else F.array_union(out, rows)
        return out

    def hits(no: int) -> Column:
        return F.transform(meets(wanted[no]), lambda k: F.struct(k.alias("row_key"), F.lit(no).alias("no")))

    named = F.flatten(F.array(*[hits(n) for n in wanted]))
    return index.select(F.explode(named).alias("hit")).select("hit.row_key", "hit.no").groupBy("row_key").agg(
        F.collect_set("no").alias("rule_nos"))


def _looked_up(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """Rows as a struct ``doc`` with their text, and the rules they are candidates of."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.struct("*").alias("doc"), text.alias("text"),
                        F.xxhash64(F.col(id_col), text).alias("row_key"))
    found = candidates(keyed.select("row_key", "text"), rules).withColumnRenamed("row_key", "found_key")
    return keyed.join(found, keyed.row_key == found.found_key, "left").select("doc", "text", "rule_nos")


def _applies(text: Column, no: int, rule: Rule) -> Column:
    """Whether the rule is to be verified on the row; a rule that scans fully first asks for one
    long enough match, which spares most texts the search for positions."""
    if trigram_query(rule.pattern) == ALWAYS:
        return text.rlike(rule.pattern[:-1] + "{%d}" % rule.least) if rule.pattern.endswith("]+") and (
            rule.least and not rule.group) else F.lit(True)
    return F.coalesce(F.array_contains("rule_nos", F.lit(no)), F.lit(False))


def _found(rules: tuple[Rule, ...]) -> Column:
    """All spans of the column ``text``, by start, then by rule order."""
    none = F.array().cast(_SPAN)
    return F.array_sort(F.concat(*[
        F.when(_applies(F.col("text"), n, r), _spans(F.col("text"), n, r)).otherwise(none) for n, r in enumerate(rules)]))


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id``, the number of spans of each base kind (``n_<kind>``), ``base_sha256`` over the base
    spans and ``spans`` over all, both ``kind:start:end`` by start, then by rule order."""
    rows = _looked_up(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), rules,
                      "doc_id", "text")
    spans = rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), _found(rules).alias("found"))
    base = [n for n, r in enumerate(rules) if r.base]

    def joined(spans_col: Column) -> Column:
        return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(no: int) -> Column:
        return F.size(F.filter("found", lambda s: s["no"] == no)).cast("long").alias(f"n_{rules[no].kind}")

    return spans.select("doc_id", *[count(n) for n in base], F.sha2(joined(F.filter(
        "found", lambda s: s["no"].isin(base))), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def _united(found: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the spans' union, as disjoint ``start, end`` in order. With starts and ends sorted each on their own, the
    k-th start begins a new stretch if all k spans that start before it have ended: if the k-th end is not behind it."""
    def stretches(starts: Column, ends: Column) -> Column:
        last = F.size(starts)
        opens = F.filter(F.sequence(F.lit(0), last), lambda k: (k == 0) | (k == last) | (F.get(starts, k) >= F.get(ends, k - 1)))
        return _let(opens, lambda at: F.transform(F.slice(at, 1, F.size(at) - 1), lambda k, i: F.struct(
            F.get(starts, k).cast("int").alias("start"), F.get(ends, F.get(at, i + 1) - 1).cast("int").alias("end"))))

    united = _let(F.array_sort(F.transform(found, lambda s: s["start"])), lambda starts: _let(
        F.array_sort(F.transform(found, lambda s: s["end"])), lambda ends: stretches(starts, ends)))
    return F.when(F.size(found) > 0, _let(united, use))


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """Characters [start, end) of a text given as blocks of ``BLOCK`` characters: the time does not grow with ``start``."""
    def within(at: Column, first: Column, characters: Column) -> Column:
        return F.coalesce(F.substring(F.get(blocks, at), first, characters), F.lit(""))

    a, b = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    several = F.concat(within(a, start % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, a + 2, b - a - 1), ""),
                       within(b, F.lit(1), end % BLOCK))
    return F.when(a == b, within(a, start % BLOCK + 1, end - start)).otherwise(several)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, with every found secret in the text replaced.
    All spans are those ``secret_scan`` finds in the original text; overlapping ones are replaced as
    one. A null text stays null. The work follows the text and its spans, not their product: the text is
    cut into blocks once, and what stays between two spans is taken from its blocks."""
    rows = _looked_up(docs, rules, id_col, text_col)
    text = F.col("text")

    def replaced(spans: Column) -> Column:
        def all_of(blocks: Column) -> Column:
            def piece(s: Column, i: Column) -> Column:
                at = F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(F.lit(0))
                return F.concat(_cut(blocks, at, s["start"]), F.lit(REDACTED))

            rest = _cut(blocks, F.element_at(spans, -1)["end"], F.length(text))
            return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

        return _let(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0)), all_of)

    text_out = F.coalesce(_let(_found(rules), lambda found: _united(found, replaced)), text)
    clean = F.when(F.col(f"doc.`{text_col}`").isNotNull(), text_out).alias(text_col)
    return rows.select(*[clean if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns])
