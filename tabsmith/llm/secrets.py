"""Secret scans over a trigram inverted index, with DataFrame operations only.

From each rule's regex a Boolean query of trigrams follows that every match must contain.
The index lists, for each trigram that some rule asks for, the documents that have it. Postings
are intersected per rule, and only candidates are searched with the regex; a rule
without mandatory trigrams searches every text.

Defined results: null and empty texts have no spans; rows that share doc_id and text are judged
alike; spans are in code points, end exclusive; other columns stay, an input column called
spans is replaced.
"""

from __future__ import annotations

import json
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import shielded, text_or_empty


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and non-overlapping, whose `group` has `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


#: The first three are the base rules. [0-9a-f]+ of 16 characters or more and
#: AKIA[A-Z0-9]+ of 18 or more are runs as long as they can be, so their length is in the pattern.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

#: Strings followed at once through a regex, and trigrams asked for in one alternative: fewer
#: make a weaker query, never a wrong one.
MOST_STRINGS, MOST_TRIGRAMS = 64, 4


def _clause(strings: set[str]) -> list[list[str]]:
    """One alternative of trigrams per string; none at all if a string has no trigram."""
    found = []
    for s in sorted(strings):
        grams = list(dict.fromkeys(s[i:i + 3] for i in range(len(s) - 2)))
        if not grams:
            return []
        step = max(1, -(-len(grams) // MOST_TRIGRAMS))
        found.append(grams[::step])
    return [list(x) for x in dict.fromkeys(map(tuple, found))]


def _exact(item) -> set[str] | None:
    """All strings that an element of a parsed regex matches, in lower case; None if there are too many."""
    op, arg = item
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        chars = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if op is sre.SUBPATTERN:
        return _exact_all(arg[-1])
    if op is sre.BRANCH:
        parts = [_exact_all(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 5:
        one = _exact_all(arg[2])
        if one is not None and sum(len(one) ** k for k in range(arg[0], arg[1] + 1)) <= MOST_STRINGS:
            return {"".join(p) for k in range(arg[0], arg[1] + 1) for p in product(one, repeat=k)}
    return None


def _exact_all(items) -> set[str] | None:
    strings = {""}
    for item in items:
        one = _exact(item)
        if one is None or len(strings) * len(one) > MOST_STRINGS:
            return None
        strings = {a + b for a in strings for b in one}
    return strings


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """Clauses that all hold for a text with a match; a clause is a list of alternatives, each a list of trigrams.

    Trigrams are in lower case, for texts in lower case. No clause: every text is a candidate.
    """
    clauses = []

    def follow(items) -> None:
        strings = {""}

        def over() -> None:
            if clause := _clause(strings):
                clauses.append(clause)

        for item in items:
            one = _exact(item)
            if one is not None and len(strings) * len(one) <= MOST_STRINGS:
                strings = {a + b for a in strings for b in one}
                continue
            over()
            strings = {""} if one is None else one
            op, arg = item
            if one is None and op is sre.SUBPATTERN:
                follow(arg[-1])
            elif one is None and op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                follow(arg[2])
        over()

    follow(sre_parser.parse(pattern))
    return clauses


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "__doc": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "__nodoc": F.col("doc_id").isNull(),
        "__body": F.xxhash64(text_or_empty())})


_KEY = ["__doc", "__nodoc", "__body"]


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: a row (trigram, document) for each of `trigrams` that a document's text has, in any case."""
    # as a generated column the lower-cased text is made once, not once per trigram
    low = _keyed(docs).select(*_KEY, F.explode(F.array(F.lower(text_or_empty()))).alias("__low"))
    found = F.array(*[F.when(F.col("__low").contains(F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)])
    return low.select(F.explode(found).alias("trigram"), *_KEY).filter("trigram is not null")


def candidates(docs: DataFrame, rules=RULES) -> DataFrame | None:
    """The documents that pass the trigram query of some rule, with the kinds whose query they pass."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    if not queries:
        return None
    trigrams = sorted({t for q in queries.values() for clause in q for alternative in clause for t in alternative})
    asked = [
        {"trigram": trigrams.index(t), "kind": kind, "clause": 1 << c, "alternative": a, "bit": 1 << i,
         "whole": (1 << len(alternative)) - 1, "clauses": (1 << len(q)) - 1}
        for kind, q in queries.items() for c, clause in enumerate(q) for a, alternative in enumerate(clause)
        for i, t in enumerate(alternative)]
    kind = "array<struct<trigram int, kind string, clause int, alternative int, bit int, whole int, clauses int>>"
    plan = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(asked)), kind)))
    # the rows of a document meet once; all three steps use that partitioning
    index = postings(docs, trigrams).repartition(*_KEY)
    alternatives = index.join(F.broadcast(plan), "trigram").groupBy(*_KEY, "kind", "clauses", "clause", "alternative", "whole").agg(
        F.bit_or("bit").alias("seen")).filter("seen = whole")
    kinds = alternatives.groupBy(*_KEY, "kind", "clauses").agg(
        F.bit_or("clause").alias("held")).filter("held = clauses")
    return kinds.groupBy(*_KEY).agg(F.collect_set("kind").alias("__kinds"))


def _matches(rule: Rule, order: int) -> Column:
    """Spans (start, rule's number, end, kind) of a rule in the column __text."""
    text, pattern = F.col("__text"), F.lit(rule.java)
    pairs = F.arrays_zip(
        F.split(text, rule.java, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"))
    kind = "struct<at:int,out:array<struct<start:int,rule:int,end:int,kind:string>>>"
    empty = F.from_json(F.lit('{"at": 0, "out": []}'), kind)

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), F.lit(order).alias("rule"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(F.length(pair["value"]) >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out")).cast(kind)

    return F.aggregate(pairs, empty, add, lambda acc: acc["out"])


@shielded
def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """`docs` with spans: an array of (start, rule, end, kind), by start, then by the rules' order."""
    kept = [c for c in docs.columns if c.lower() != "spans"]
    kind = "array<struct<start:int,rule:int,end:int,kind:string>>"
    found = candidates(docs, rules)
    keyed = _keyed(docs).withColumn("__text", text_or_empty())
    if found is None:
        joined = keyed.withColumn("__kinds", F.lit(None).cast("array<string>"))
    else:
        # few columns on the right; the texts need no sort this way
        joined = keyed.join(found.hint("shuffle_hash"), _KEY, "left")
    parts = []
    for order, rule in enumerate(rules):
        look = F.col("__text").rlike(rule.java)
        if trigram_query(rule.pattern):
            look = F.coalesce(F.array_contains("__kinds", rule.kind), F.lit(False)) & look
        parts.append(F.when(look, _matches(rule, order)).otherwise(F.array().cast(kind)))
    return joined.select(*kept, F.sort_array(F.concat(*parts)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
