"""Secret scan with a trigram inverted index. Built-in functions only.

From every rule's regex a Boolean query over trigrams is derived: what any match must contain. The trigrams that
occur in some query are posted as (trigram, row key) for each text that holds them, in lower case. A rule's
query in disjunctive form is answered by intersecting the postings of each conjunction; the rows found are the
candidates on which the regex itself is run. Rules without a mandatory trigram (long runs of hex digits) are run
on every text.

Spans are code points of the original text, end exclusive, leftmost and not overlapping within a kind. Three base
kinds are always reported; further kinds add spans.

Nulls are empty texts, without spans. Rows are told apart by a hash of id and text; equal rows share their
candidates, and a clash of hashes only means a regex run in vain. A text of any length is scanned whole; for n matches
in it the time spent on positions grows as n times its square root. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import text_or_empty

_parser = re._parser


@dataclass(frozen=True)
class Rule:
    """``regex`` is valid for Java and Python. Matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


#: Fixed patterns of the base kinds, in their order.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
#: Further kinds: published formats of keys and tokens.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", least=20),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", least=15),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", least=39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", least=28),
)
RULES = BASE_RULES + MORE_RULES

#: Longer lists of alternatives are no longer followed; the query then asks for less.
_MAX_EXACT = 32


def _trigrams(strings: set[str]) -> list[frozenset[str]] | None:
    """Any of ``strings`` as a query: one conjunction per string, None where a string has no trigram."""
    if any(len(s) < 3 for s in strings):
        return None
    return list(dict.fromkeys(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)))


def _both(a, b):
    """AND of two queries in disjunctive form; None is 'anything'."""
    if a is None or b is None:
        return b if a is None else a
    if len(a) * len(b) > _MAX_EXACT:
        return a if len(a) <= len(b) else b
    return list(dict.fromkeys(x | y for x in a for y in b))


def _analyse(nodes) -> tuple[set[str] | None, list[frozenset[str]] | None]:
    """The strings a parsed regex can match exactly (None: too many to list), and the query every match meets."""
    query, run, exact = None, {""}, True
    for op, arg in nodes:
        name, inner, own = str(op), None, None
        if name == "LITERAL":
            inner = {chr(arg).lower()}
        elif name == "IN":
            members = {chr(v).lower() for o, v in arg if str(o) == "LITERAL"}
            inner = members if len(members) <= 8 and all(str(o) == "LITERAL" for o, _ in arg) else None
        elif name == "SUBPATTERN":
            inner, own = _analyse(arg[-1])
        elif name == "BRANCH":
            parts = [_analyse(branch) for branch in arg[1]]
            inner = set().union(*(p[0] for p in parts)) if all(p[0] is not None for p in parts) else None
            queries = [_trigrams(p[0]) if p[0] is not None else p[1] for p in parts]
            own = None if inner is not None or None in queries else [c for q in queries for c in q]
        elif name == "MAX_REPEAT":
            least, most, body = arg
            strings, below = _analyse(body)
            if strings is not None and least == most == 1:
                inner = strings
            elif strings is not None and (least, most) == (0, 1):
                inner = strings | {""}
            elif least:
                own = _trigrams(strings) if strings is not None else below
        if inner is not None and len(run) * len(inner) <= _MAX_EXACT:
            run = {a + b for a, b in product(run, inner)}
            continue
        query = _both(query, _trigrams(run))
        exact = False
        if inner is not None:
            run = inner
        else:
            query, run = _both(query, own), {""}
    return (run if exact else None), _both(query, _trigrams(run))


def trigram_query(regex: str) -> list[frozenset[str]] | None:
    """The trigrams (lower case) of which any text with a match holds all of one set; None if there are none."""
    return _analyse(_parser.parse(regex))[1]


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (trigram, key) for every text that holds one of ``trigrams``."""
    lower = docs.select(_key().alias("key"), F.lower(text_or_empty()).alias("lower"))
    held = F.array_compact(F.array(*[F.when(F.contains("lower", F.lit(t)), F.lit(t)) for t in trigrams]))
    return lower.select("key", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules): the rows whose postings meet a rule's query, with one bit per rule."""
    rows = [
        (trigram, clause, 1 << place, (1 << len(parts)) - 1, 1 << number)
        for number, rule in enumerate(rules)
        for clause, parts in enumerate(trigram_query(rule.regex) or ())
        for place, trigram in enumerate(sorted(parts))
    ]
    wanted = index.sparkSession.createDataFrame(rows, "trigram string, clause int, bit long, every long, rule long")
    return (
        index.join(F.broadcast(wanted), "trigram")  # one row per trigram of the rules
        .groupBy("key", "rule", "clause", "every")
        .agg(F.bit_or("bit").alias("bits"))
        .where("bits = every")
        .groupBy("key")
        .agg(F.bit_or("rule").alias("rules"))
    )


def _spans(rule: Rule, number: int) -> Column:
    """Array of (start, rule, end) of the rule's matches in ``text``. Lengths of matches and of what lies between
    them add up to positions; a match that is too short is passed over but counts.

    An array grows by copying, so n matches are cut into blocks of about the square root of n: the blocks' lengths give
    where each begins, and each is then gone through from there."""
    pattern = "'" + rule.regex.replace("\\", "\\\\").replace("'", "\\'") + "'"
    pieces = F.expr(f"""
        CASE WHEN text RLIKE {pattern} THEN
          transform(
            arrays_zip(regexp_extract_all(text, {pattern}, 0), split(text, {pattern}, -1),
                       regexp_extract_all(text, {pattern}, {rule.group})),
            m -> struct(length(m['1']) AS gap, coalesce(length(m['0']), 0) AS long,
                        coalesce(length(m['2']), 0) >= {rule.least} AS counts))
        END""")

    def cut(all_pieces: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_pieces))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(all_pieces), width), lambda i: F.slice(all_pieces, i, width))

    def begun(blocks: Column) -> Column:
        empty = F.expr("named_struct('at', 0, 'out', cast(array() AS array<int>))")
        total = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda at, m: at + m["gap"] + m["long"]))
        return F.aggregate(
            total,
            empty,
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )

    def within(block: Column, at: Column) -> Column:
        none = F.expr("cast(array() AS array<struct<start: int, rule: int, end: int>>)")

        def step(acc: Column, m: Column) -> Column:
            start = acc["at"] + m["gap"]
            end = start + m["long"]
            span = F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end"))
            out = F.when(m["counts"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        return F.aggregate(block, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def joined(blocks: Column) -> Column:
        return let(begun(blocks), lambda starts: F.flatten(F.zip_with(blocks, starts, within)))

    return F.when(pieces.isNotNull(), let(pieces, lambda every: let(cut(every), joined)))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of every row; spans is an array of (start, rule, end), sorted; rule counts from 0."""
    queries = [trigram_query(rule.regex) for rule in rules]
    trigrams = sorted({t for q in queries for clause in q or () for t in clause})
    narrow = docs.select("doc_id", "text")
    found = candidates(postings(narrow, trigrams), rules)
    rows = narrow.withColumn("key", _key()).join(found, "key", "left")
    rows = rows.select("doc_id", text_or_empty().alias("text"), F.coalesce("rules", F.lit(0)).alias("rules"))
    none = F.expr("cast(array() AS array<struct<start: int, rule: int, end: int>>)")
    per_rule = [
        F.coalesce(
            _spans(rule, n) if query is None else F.when(F.col("rules").bitwiseAND(1 << n) != 0, _spans(rule, n)), none
        )
        for n, (rule, query) in enumerate(zip(rules, queries, strict=True))
    ]
    return rows.select("doc_id", F.array_sort(F.concat(*per_rule)).alias("spans"))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """'kind:start:end' of each span, joined by commas."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"])), ","
    )
