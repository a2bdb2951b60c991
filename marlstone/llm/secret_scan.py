"""Secret scanning over a trigram inverted index, with DataFrame functions only.

Every rule's regular expression is parsed, and the trigrams that any match must hold become a Boolean query (AND of a
string's trigrams, OR of alternatives). The index has posting lists for the trigrams that some query asks for: for each
trigram and block of documents, the ids of the block's documents that hold it. A query is answered by intersecting and
uniting the lists of a block; blocks are bounded hash buckets of ids, so no list grows with the corpus and a trigram that
is everywhere costs every block alike. Candidates are then verified by the rule itself on the whole text; rules without
mandatory trigrams scan all texts. Candidate ids meet the documents again in a broadcast of a checked size, beyond it in
a shuffled join.

Spans are code points, end exclusive, leftmost and non-overlapping for each rule. Defined results: null texts count as
empty; rows with a null id are candidates for every rule; rows that share an id are verified one by one; letters of a
case-blind rule are A-Z and a-z only; of matches that start at the same place the rule that is listed first comes first; a
text of any length is read whole; an empty table gives an empty result; a column named secret_spans is replaced, all others pass.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import materialize, sized

try:
    from re import _parser as sre
except ImportError:  # older Pythons
    import sre_parse as sre

#: Documents of one block of the index; matches of a text that are worked off in one go.
BLOCK_DOCS, CHUNK = 8192, 256


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # understood alike by Java's and Python's regular expressions
    group: int = 0
    least: int = 0  # characters of that group


# The base rules, then public key formats.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
BASE = ("assign", "access", "hex")

# ---- Boolean queries: True (anything), a trigram, ("and", ...) or ("or", ...) ------------------------------------


def _all(parts) -> object:
    flat = set()
    for p in parts:
        flat |= set() if p is True else set(p[1:]) if p[0] == "and" else {p}
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("and", *sorted(flat, key=str))


def _any(parts) -> object:
    flat = set(parts)
    if True in flat or not flat:
        return True
    # An alternative that asks for more than another one adds nothing.
    asks = {p: {p} if isinstance(p, str) else set(p[1:]) if p[0] == "and" else None for p in flat}
    flat = {p for p in flat if not any(q != p and asks[q] is not None and asks[p] is not None and asks[q] < asks[p] for q in flat)}
    return next(iter(flat)) if len(flat) == 1 else ("or", *sorted(flat, key=str))


def _of_strings(strings: set[str]) -> object:
    """What must be there if one of the strings is."""
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _walk(items) -> tuple[set[str] | None, object]:
    """Of a parsed sequence: all strings it matches (lower case; None if too many), and a query for any match."""
    known, query, whole = {""}, [], True
    for op, arg in items:
        name, strings, asks = str(op), None, True
        if name == "LITERAL":
            strings = {chr(arg).lower()}
        elif name == "SUBPATTERN":
            strings, asks = _walk(arg[-1])
        elif name == "BRANCH":
            got = [_walk(x) for x in arg[1]]
            if all(s is not None for s, _ in got):
                strings = set().union(*(s for s, _ in got))
            else:
                asks = _any([_of_strings(s) if s is not None else q for s, q in got])
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= 6:
            strings = {chr(a).lower() for _, a in arg}
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, body = arg
            s, q = _walk(body)
            literal = str(body[0][0]) == "LITERAL" or len(body) > 1 or str(body[0][0]) == "SUBPATTERN"
            if (low, high) == (0, 1) and s is not None and literal:
                strings = s | {""}
            elif low and s is not None and len(s) == 1:
                query.append(_of_strings({next(iter(s)) * low}))
            elif low:
                asks = q if s is None else _of_strings(s)
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        if strings is not None and len(known) * len(strings) <= 64:
            known = {a + b for a in known for b in strings}
        else:
            query += [_of_strings(known), asks if strings is None else _of_strings(strings)]
            known, whole = {""}, False
    if whole:
        return known, _of_strings(known)
    return None, _all([*query, _of_strings(known)])


def trigram_query(pattern: str) -> object:
    """The Boolean query over lower-case trigrams that every text with a match satisfies."""
    return _walk(sre.parse(pattern))[1]


def trigrams_of(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1:]))


# ---- the index ---------------------------------------------------------------------------------------------------


def build_index(docs: DataFrame, trigrams: list[str], id: str = "doc_id", text: str = "text", blocks: int = 1) -> DataFrame:
    """Posting lists: block, trigram, ids."""
    low = docs.filter(F.col(id).isNotNull()).select(F.col(id).alias("i"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    postings = low.select("i", F.pmod(F.xxhash64("i"), F.lit(blocks)).alias("block"), F.explode(held).alias("trigram"))
    return postings.groupBy("block", "trigram").agg(F.collect_set("i").alias("ids"))


def answer(index: DataFrame, queries: dict[int, object], kind: str) -> DataFrame:
    """Candidates of each numbered query: id and a mask with the bits of the queries it satisfies."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists"))
    none = F.expr(f"cast(array() as array<{kind}>)")

    def ids(q) -> Column:
        if isinstance(q, str):
            return F.coalesce(F.try_element_at("lists", F.lit(q)), none)
        return reduce(F.array_intersect if q[0] == "and" else F.array_union, map(ids, q[1:]))

    def marked(q, bit: int) -> Column:
        return F.transform(ids(q), lambda i: F.struct(i.alias("id"), F.lit(bit).alias("bit")))

    hits = [marked(q, 1 << n) for n, q in queries.items()]
    return lists.select(F.explode(F.concat(*hits)).alias("h")).groupBy("h.id").agg(F.bit_or("h.bit").alias("mask"))


# ---- verification ------------------------------------------------------------------------------------------------


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Matches of a rule that are long enough: array of (start, order, kind, end)."""
    p = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), lambda s: F.char_length(s).cast("long"))
    found = F.transform(F.regexp_extract_all(text, p, 0), lambda s: F.char_length(s).cast("long"))
    value = F.transform(F.regexp_extract_all(text, p, rule.group), lambda s: F.char_length(s).cast("long"))
    none = F.expr("cast(array() as array<struct<start: long, order: int, kind: string, end: long>>)")

    # The text after the last match has no match beside it: the three arrays end with the matches.
    rows = F.zip_with(F.slice(between, 1, F.size(found)), F.arrays_zip(found.alias("size"), value.alias("value")), lambda g, x: F.struct(g.alias("gap"), x["size"].alias("size"), x["value"].alias("value")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        one = F.array(F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end")))
        kept = F.when(x["value"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    def chunk(xs: Column, at: Column) -> Column:
        return F.aggregate(xs, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    # Each step copies what it has: chunks keep that short, and their starts come from their sums.
    zero = F.lit(0).cast("long")
    parts = F.transform(F.sequence(F.lit(0), F.floor(F.size(found) / CHUNK).cast("int")), lambda c: F.slice(rows, c * CHUNK + 1, CHUNK))
    sums = F.transform(parts, lambda xs: F.aggregate(xs, zero, lambda acc, x: acc + x["gap"] + x["size"]))
    first = F.aggregate(sums, F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)), lambda acc: F.slice(acc, F.lit(1), F.size(acc) - 1))
    several = F.flatten(F.zip_with(parts, first, chunk))
    return F.when(F.size(found) <= CHUNK, chunk(rows, zero)).otherwise(several)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with secret_spans: array of (start, order, kind, end), sorted; order is the rule's place among ``rules``."""
    queries = {n: q for n, q in enumerate(trigram_query(r.pattern) for r in rules) if q is not True}
    kind = docs.schema[id].dataType.simpleString()
    vocabulary = sorted(set().union(*map(trigrams_of, queries.values()))) if queries else []
    body = F.coalesce(F.col(text), F.lit(""))
    cols = [c for c in docs.columns if c.lower() != "secret_spans"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__doc"), F.col(id).alias("__id"), body.alias("__text"))
    if vocabulary:
        blocks = max(1, -(-docs.count() // BLOCK_DOCS))
        found = materialize(answer(build_index(docs, vocabulary, id, text, blocks), queries, kind), "secret-candidates")
        rows = rows.join(sized(found.select(F.col("id").alias("__c"), "mask")), F.col("__id") == F.col("__c"), "left")
        rows = rows.withColumn("mask", F.when(F.col("__id").isNull(), F.lit(-1)).otherwise(F.coalesce("mask", F.lit(0))))
    none = F.expr("cast(array() as array<struct<start: long, order: int, kind: string, end: long>>)")
    parts = []
    for n, r in enumerate(rules):
        asked = F.col("mask").bitwiseAND(1 << n) != 0 if n in queries else F.lit(True)
        asked = asked & F.col("__text").rlike(r.pattern)
        parts.append(F.when(asked, spans_of(F.col("__text"), r, n)).otherwise(none))
    return rows.select("__doc.*", F.array_sort(F.concat(*parts)).alias("secret_spans"))
