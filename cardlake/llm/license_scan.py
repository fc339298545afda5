"""Licence scan: Aho-Corasick over the word stream, then a shunting-yard parser.

One automaton holds the words of notice phrases and of the identifier tag
(``SPDX-License-Identifier``). A text is reduced to its lower-cased words joined by
one blank, so a phrase matches wherever its words stand consecutively, whatever
stands between them. After an identifier tag the licence expression is read from the
original text and evaluated: ``and`` / ``or`` / ``with``, parentheses, ``+``.

Defined results: a null text is an empty one; a text without words or phrases has
``n_words`` 0 or more, ``n_base`` 0, null word positions, empty label strings and score
0. A null ``doc_id`` and repeated rows are passed through row by row. An expression that
does not parse keeps its raw text and adds no label. Other columns of the input are not
read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.tables import python_tasks

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases, their label and how sure the phrase alone makes us.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": ("mit", 0.9),
    "the mit license": ("mit", 0.8),
    "gnu general public license version 2": ("gpl-2", 0.9),
    "gnu general public license version 3": ("gpl-3", 0.9),
    "gnu general public license": ("gpl", 0.7),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license version 2": ("mpl-2", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "bsd license": ("bsd", 0.7),
    "isc license": ("isc", 0.7),
    "cc by sa": ("cc-by-sa", 0.7),
    "cc by nd": ("cc-by-nd", 0.7),
    "cc by 4": ("cc-by", 0.7),
    "cc0 1": ("cc0", 0.7),
    "all rights reserved": ("all-rights-reserved", 0.4),
}
BASE_CERTAINTY = 0.9
IDENTIFIER_CERTAINTY = 1.0
TAG_WORDS = "spdx license identifier"
# Licence identifiers and the label they carry; other identifiers are their own label.
IDENTIFIER_LABELS = {
    "mit": "mit", "apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "cc-by-sa-4.0": "cc-by-sa",
    "cc-by-4.0": "cc-by", "cc0-1.0": "cc0", "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2",
    "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "mpl-2.0": "mpl-2", "bsd-2-clause": "bsd",
    "bsd-3-clause": "bsd", "isc": "isc",
}
PERMISSIVE = frozenset({"mit", "apache-2", "bsd", "isc", "cc0", "cc-by"})
RESTRICTED = frozenset({"cc-by-nc", "cc-by-nd", "all-rights-reserved"})

_TAG = re.compile(r"spdx[-_ ]license[-_ ]identifier[ \t]*:", re.IGNORECASE | re.ASCII)
_EXPRESSION = re.compile(
    r"[ \t]*(?P<e>(?:[()]|[A-Za-z0-9][A-Za-z0-9.+-]*|[ \t]+)+)")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*")
_OPERATORS = {"or": 1, "and": 2, "with": 3}

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of a-z, digits and non-ASCII characters after lower-casing A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: infix licence tokens to postfix; None if they are no expression."""
    out: list[str] = []
    stack: list[str] = []
    operand_due = True
    for tok in tokens:
        low = tok.lower()
        if tok == "(":
            if not operand_due:
                return None
            stack.append(tok)
        elif tok == ")":
            if operand_due:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif low in _OPERATORS:
            if operand_due:
                return None
            while stack and stack[-1] != "(" and _OPERATORS[stack[-1]] >= _OPERATORS[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_due = True
        else:
            if not operand_due:
                return None
            out.append(tok)
            operand_due = False
    if operand_due or "(" in stack:
        return None
    return out + stack[::-1]


def usage(label: str) -> int:
    """2 permissive, 0 restricted, 1 anything else."""
    return 2 if label in PERMISSIVE else 0 if label in RESTRICTED else 1


def evaluate(postfix: list[str]) -> tuple[set[str], int]:
    """Labels named by the expression, and its usage: the freest branch of an ``or``,
    the strictest of an ``and``; an exception (``with``) leaves its licence's usage."""
    stack: list[tuple[set[str], int]] = []
    for tok in postfix:
        if tok in _OPERATORS:
            right, left = stack.pop(), stack.pop()
            if tok == "with":
                stack.append(left)
            else:
                pick = max if tok == "or" else min
                few, many = sorted((left[0], right[0]), key=len)
                many.update(few)
                stack.append((many, pick(left[1], right[1])))
        else:
            low = tok.lower()
            later = low.endswith("+")
            low = low[:-1] if later else low
            label = IDENTIFIER_LABELS.get(low, low)
            stack.append(({label}, usage(label)))
    return stack.pop()


def _goes_on(operator: str, right: str | None) -> bool:
    """Whether an operator with this right operand belongs to the expression: written in lower case,
    it may be a word of the prose unless a licence (behind ``with`` an exception) follows it."""
    if operator.isupper() or right is None:
        return True
    right = right.lower().rstrip(".")
    formed = any(c.isdigit() or c in ".-" for c in right)
    return formed or operator.lower() != "with" and (right == "(" or right.removesuffix("+") in IDENTIFIER_LABELS)


def read_expression(text: str, at: int) -> tuple[str, set[str], int] | None:
    """The licence expression that starts at ``at``: the longest parsable run of tokens on the line, so prose that
    follows the expression does not spoil it. One pass remembers the last token that ends a whole
    expression. Dots and hyphens behind an identifier are punctuation, and the expression ends there."""
    found = _EXPRESSION.match(text, at)
    tokens = _TOKEN.findall(found["e"]) if found else []
    depth, operand_due, whole = 0, True, 0
    for i, tok in enumerate(tokens):
        ended = False
        if tok == "(":
            if not operand_due:
                break
            depth += 1
        elif tok == ")":
            if operand_due or not depth:
                break
            depth -= 1
        elif tok.lower() in _OPERATORS:
            if operand_due or not _goes_on(tok, tokens[i + 1] if i + 1 < len(tokens) else None):
                break
            operand_due = True
        else:
            if not operand_due:
                break
            operand_due = False
            tokens[i] = tok.rstrip(".-")
            ended = tokens[i] != tok
        if not depth and not operand_due:
            whole = i + 1
        if ended:
            break
    postfix = to_postfix(tokens[:whole]) if whole else None
    return (" ".join(tokens[:whole]), *evaluate(postfix)) if postfix else None


@cache
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    phrases = [*BASE_PHRASES, *NOTICE_PHRASES, TAG_WORDS]
    for p in dict.fromkeys(phrases):
        a.add_word(f" {p} ", p)
    a.make_automaton()
    return a


def scan(text: str | None) -> dict:
    """Everything the scan knows of one text."""
    words = words_of(text)
    stream = b" " + b" ".join(words) + b" "
    line = stream.decode("utf-8", "surrogatepass")
    n_base, first, last = 0, None, None
    base: set[str] = set()
    certainty: dict[str, float] = {}
    tagged = False
    at, index = 0, 0  # words before position ``at`` of the stream
    for end, phrase in automaton().iter(line):
        start = end - len(phrase)  # the blank before the phrase is end - len - 1
        if phrase == TAG_WORDS:
            tagged = True
            continue
        if phrase in BASE_PHRASES:
            index += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            n_base += 1
            first = index - 1 if first is None else min(first, index - 1)
            last = index - 1 if last is None else max(last, index - 1)
            base.add(BASE_PHRASES[phrase])
            label, sure = BASE_PHRASES[phrase], BASE_CERTAINTY
        else:
            label, sure = NOTICE_PHRASES[phrase]
        certainty[label] = max(certainty.get(label, 0.0), sure)
    expressions, use = [], None
    if tagged:
        for tag in _TAG.finditer(text):
            read = read_expression(text, tag.end())
            if read:
                expressions.append(read[0])
                use = read[2] if use is None else min(use, read[2])
                for label in read[1]:
                    certainty[label] = IDENTIFIER_CERTAINTY
    if use is None and certainty:
        use = min(usage(x) for x in certainty)
    missed = 1.0
    for sure in certainty.values():
        missed *= 1.0 - sure
    return {
        "n_words": len(words), "n_base": n_base, "first_word": first, "last_word": last,
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(certainty)),
        "score": 1.0 - missed, "expressions": expressions,
        "usage": None if use is None else ("restricted", "other", "permissive")[use],
    }


_RESULT = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
    ("score", pa.float64()), ("expressions", pa.list_(pa.string())), ("usage", pa.string()),
])
_DDL = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>, usage string")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and the scan's columns. A map over rows: no shuffle."""
    python_tasks(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = pa.RecordBatch.from_pylist([scan(t.as_py()) for t in b.column(1)], schema=_RESULT)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *rows.columns], names=["doc_id", *_RESULT.names])

    return named.mapInArrow(run, f"doc_id long, {_DDL}")
