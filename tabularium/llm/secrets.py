"""Secret scans over a trigram inverted index, DataFrame functions only.

``trigram_query`` derives from a rule's regular expression a Boolean query of trigrams that every match must contain,
letters folded to lower case. The index holds a posting (trigram, doc_id) for each trigram that some rule's query names
and each document whose folded text has it; intersecting the postings by document evaluates the queries. Candidates go
into a Bloom filter of bounded size, so that the texts are verified where they lie and never shuffled; a false positive
costs one more verification. Rules without mandatory trigrams (``hex``) scan every text.

Spans are exact: offsets count code points, ends are exclusive, and a rule's matches are leftmost and do not overlap.

Defined results: a null text counts as empty and has no span. Rows that repeat a doc_id are each scanned by their own
text. Very long texts are scanned whole. An empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_filter, bloom_probe, bloom_words, clean_text, stash


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Base rules in the order of their kinds. A maximal run of 24 or more is the same as a run that is then measured.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Rules that the index makes cheap to add: their kinds follow the base ones.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE + MORE
MASK = "[SECRET]"
BITS = 62

SPAN = "struct<start:int,rank:int,end:int,kind:string>"

# ---- Boolean trigram queries: a set of sets of trigrams, an OR of ANDs; the empty set within means any text.

ANY = frozenset({frozenset()})
_MANY = 64


def _least(query: frozenset) -> frozenset:
    return frozenset(a for a in query if not any(b < a for b in query))


def _and(p: frozenset, q: frozenset) -> frozenset:
    both = _least(frozenset(a | b for a in p for b in q))
    return both if len(both) <= _MANY else _least(p)


def _of_strings(strings: set[str]) -> frozenset:
    if any(len(s) < 3 for s in strings):
        return ANY
    return _least(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _node(op: str, arg) -> tuple[set[str] | None, frozenset]:
    """The strings that a part matches if they are few, and a query that holds for it anyway."""
    if op == "LITERAL":
        return {chr(arg).lower()}, ANY
    if op == "IN" and all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= 8:
        return {chr(a).lower() for _, a in arg}, ANY
    if op == "SUBPATTERN":
        return _sequence(arg[-1])
    if op == "BRANCH":
        parts = [_sequence(p) for p in arg[1]]
        if all(e is not None for e, _ in parts):
            return set().union(*(e for e, _ in parts)), ANY
        return None, _least(frozenset().union(*(_and(q, _of_strings(e)) if e is not None else q for e, q in parts)))
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, part = arg
        exact, query = _sequence(part)
        if most == 1 and exact is not None:
            return (exact | {""} if least == 0 else exact), ANY
        if least:
            return None, _and(query, _of_strings(exact)) if exact is not None else query
    return None, ANY


def _sequence(parsed) -> tuple[set[str] | None, frozenset]:
    strings, query, whole = {""}, ANY, True
    for op, arg in parsed:
        exact, own = _node(str(op), arg)
        query = _and(query, own)
        if exact is not None and len(strings) * len(exact) <= _MANY:
            strings = {a + b for a in strings for b in exact}
            continue
        query, whole = _and(query, _of_strings(strings)), False
        strings = exact if exact is not None else {""}
    return (strings, query) if whole else (None, _and(query, _of_strings(strings)))


def trigram_query(pattern: str) -> frozenset:
    """OR of ANDs of trigrams that any text with a match has once folded; ANY if none is mandatory."""
    exact, query = _sequence(re._parser.parse(pattern))
    return _of_strings(exact) if exact is not None else query


# ---- index and candidates


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram: place in ``trigrams``, doc_id)."""
    folded = F.lower(clean_text())
    present = F.array_compact(F.array(*(F.when(F.contains(folded, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams))))
    return stash(docs.select("doc_id", F.explode(present).alias("trigram")), "postings")


def candidates(postings: DataFrame, trigrams: list[str], queries: dict[int, frozenset]) -> DataFrame:
    """(doc_id, rule) of the documents that satisfy a rule's query: postings intersected by document."""
    number, words = F.col("trigram"), range(0, len(trigrams), BITS)
    masks = [F.bit_or(F.when((number >= w) & (number < w + BITS), F.call_function("shiftleft", F.lit(1).cast("long"), (number - w).cast("int"))).otherwise(F.lit(0).cast("long"))).alias(f"m{w}") for w in words]
    place = {t: i for i, t in enumerate(trigrams)}

    def has(conjunction: frozenset) -> Column:
        tests = []
        for w in words:
            if m := sum(1 << (place[t] - w) for t in conjunction if w <= place[t] < w + BITS):
                tests.append(F.col(f"m{w}").bitwiseAND(F.lit(m)) == F.lit(m))
        return reduce(Column.__and__, tests)

    hits = [F.when(reduce(Column.__or__, [has(c) for c in sorted(q, key=sorted)]), F.lit(r)) for r, q in queries.items()]
    return postings.groupBy("doc_id").agg(*masks).select("doc_id", F.explode(F.array_compact(F.array(*hits))).alias("rule"))


# ---- verification


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule: what lies between the matches and the matches themselves alternate and add up to the text."""
    pattern = F.lit(rule.pattern)
    found, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["between"])
        end = start + F.char_length(x["found"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        grown = F.when(F.char_length(x["kept"]) >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), grown.alias("out"))

    parts = F.arrays_zip(found.alias("found"), kept.alias("kept"), F.slice(between, 1, F.size(found)).alias("between"))
    return F.aggregate(parts, zero, step)["out"]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: array of (start, rank, end, kind) by start, then by the rules' order.

    A column of that name is replaced.
    """
    queries = {r: q for r, rule in enumerate(rules) if (q := trigram_query(rule.pattern)) != ANY}
    trigrams = sorted({t for q in queries.values() for c in q for t in c})
    flagged = docs
    if trigrams:
        postings = trigram_index(docs.select("doc_id", "text"), trigrams)
        found = stash(candidates(postings, trigrams, queries), "candidates")
        words = bloom_words(found.count())
        bloom = stash(bloom_filter(found.select(F.xxhash64("doc_id", "rule").alias("__tb_x")), "__tb_x", words), "bloom")
        for r in queries:
            flagged = bloom_probe(flagged, bloom, F.xxhash64("doc_id", F.lit(r)), words, f"__tb_rule{r}")
    text, none = clean_text(), F.array().cast(f"array<{SPAN}>")
    each = []
    for r, rule in enumerate(rules):
        test = F.rlike(text, F.lit(rule.pattern))
        if r in queries:
            test = F.col(f"__tb_rule{r}") & test
        each.append(F.when(test, _matches(text, rule, r)).otherwise(none))
    return flagged.withColumn(spans, F.sort_array(F.concat(*each))).drop(*(f"__tb_rule{r}" for r in queries))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, base_sha256 and spans of every row of (doc_id, text)."""
    found = scan(docs.select("doc_id", "text"), spans="__tb_spans")
    spans = F.col("__tb_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *(count(r.kind) for r in BASE), F.sha2(_written(base), 256).alias("base_sha256"), _written(spans).alias("spans"))


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mask``; n_chars, if there is one, follows."""
    text, spans = F.col("text"), F.col("__tb_spans")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        apart = (s["start"] >= acc["at"]) | (acc["at"] == 0)
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, piece).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    found = scan(docs, spans="__tb_spans").withColumn("text", F.when(F.size(spans) > 0, done).otherwise(text))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)
