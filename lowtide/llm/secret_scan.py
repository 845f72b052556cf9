"""Secret scan with a trigram inverted index.

Each rule's regular expression gives a Boolean query of trigrams that any match
must contain. Posting lists of the queries' trigrams are built over all texts
(lower-cased), intersected per text, and only texts that satisfy a rule's query
are searched with its expression. A rule without mandatory trigrams searches all
texts.

Spans are code points, end exclusive, leftmost and non-overlapping per kind; a
match whose checked group is too short is dropped after it has consumed its
text. Null text is the empty text. Rows with equal id and text give equal rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.sources.sinks import stage


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the expressions of the base kinds
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
FURTHER = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"[a-z]{2,10}://[^\x20\x09-\x0D/:@]{1,100}:[^\x20\x09-\x0D/:@]{1,100}@"),
)

MOST_STRINGS = 64
#: spans that grow one array; a text has any number of such runs
RUN = 256
SPANS = "array<struct<start: bigint, rank: int, end: bigint, kind: string>>"


def mandatory(pattern: str) -> list[list[frozenset[str]]]:
    """The trigram query of an expression: a conjunction of alternatives, each a set of trigrams; empty if none is mandatory.

    Follows the parsed expression: pieces that stand for few strings are
    multiplied out, and such a run of strings is closed by a piece that stands
    for many.
    """
    clauses: list[list[frozenset[str]]] = []

    def close(strings: set[str]) -> None:
        if strings and all(len(s) >= 3 for s in strings):
            clauses.append([frozenset(s[i: i + 3] for i in range(len(s) - 2)) for s in sorted(strings)])

    def exact(node) -> set[str] | None:
        """All strings a piece stands for, lower-cased, if they are few."""
        kind, value = str(node[0]), node[1]
        if kind == "LITERAL":
            return {chr(value).lower()}
        if kind == "IN":
            if all(str(k) == "LITERAL" for k, _ in value) and len(value) <= 8:
                return {chr(v).lower() for _, v in value}
            return None
        if kind == "AT":
            return {""}
        if kind == "SUBPATTERN":
            return exact_run(value[-1])
        if kind == "BRANCH":
            parts = [exact_run(b) for b in value[1]]
            return None if any(p is None for p in parts) else set().union(*parts)
        if kind in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = value
            inner = exact_run(body)
            if inner is None or high > 4:
                return None
            out = set()
            for times in range(low, int(high) + 1):
                out |= reduce(lambda xs, _: {x + y for x in xs for y in inner}, range(times), {""})
            return out
        return None

    def exact_run(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            more = exact(node)
            if more is None or len(out) * len(more) > MOST_STRINGS:
                return None
            out = {x + y for x in out for y in more}
        return out

    def walk(nodes) -> None:
        run = {""}
        for node in nodes:
            more = exact(node)
            if more is not None and len(run) * len(more) <= MOST_STRINGS:
                run = {x + y for x in run for y in more}
                continue
            close(run)
            run = more if more is not None else {""}
            if more is None:
                kind, value = str(node[0]), node[1]
                if kind == "SUBPATTERN":
                    walk(value[-1])
                elif kind in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
                    walk(value[2])
        close(run)

    walk(re._parser.parse(pattern))
    return clauses


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: ``(trigram, doc_id, body)`` for the texts that contain it in either case."""
    low = F.lower("text")
    found = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("low"), t))
    return texts.select("doc_id", "body", low.alias("low")).select("doc_id", "body", F.explode(found).alias("trigram"))


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(doc_id, body, kinds)``: the kinds whose query a text satisfies."""
    queries = {r.kind: mandatory(r.pattern) for r in rules}
    trigrams = sorted({t for q in queries.values() for c in q for s in c for t in s})
    index = stage(postings(texts, trigrams), "trigram-postings")
    lists = index.groupBy("doc_id", "body").agg(F.collect_set("trigram").alias("has"))

    def holds(query: list[list[frozenset[str]]]) -> Column:
        return reduce(lambda x, y: x & y, (reduce(lambda x, y: x | y, (
            F.size(F.array_except(F.array(*map(F.lit, sorted(s))), "has")) == 0 for s in clause)) for clause in query))

    kinds = F.filter(F.array(*(F.when(holds(q), F.lit(k)) for k, q in queries.items() if q)), lambda k: k.isNotNull())
    return lists.select("doc_id", "body", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def spans_of(rule: Rule, order: int, text: Column) -> Column:
    """Array of (start, order, end, kind) of a rule's matches: gaps and matches alternate, so their lengths give the places."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern, -1)
    rows = F.arrays_zip(found.alias("m"), checked.alias("v"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"))
    rows = F.transform(rows, lambda x: F.struct(
        F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("own"), (F.length(x["v"]) >= rule.least).alias("kept")))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        end = start + x["own"]
        one = F.array(F.struct(start.alias("start"), F.lit(order).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(x["kept"], F.concat(s["out"], one)).otherwise(s["out"]).alias("out"))

    def placed(rows: Column) -> Column:
        # growing an array copies it, so it grows in runs; each run starts where the lengths before it end
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(rows), F.lit(1)), F.lit(RUN)), lambda at: F.slice(rows, at, F.lit(RUN)))
        return F.transform(F.array(runs), lambda runs: F.flatten(F.zip_with(runs, starts(runs), lambda run, at: F.aggregate(
            run, F.struct(at.alias("at"), F.expr(f"cast(array() as {SPANS})").alias("out")), step)["out"])))[0]

    def starts(runs: Column) -> Column:
        zero = F.lit(0).cast("long")
        size = F.transform(runs, lambda run: F.aggregate(run, zero, lambda n, x: n + x["gap"] + x["own"]))
        begin = F.struct(zero.alias("at"), F.expr("cast(array() as array<bigint>)").alias("out"))
        return F.aggregate(size, begin, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]

    return F.transform(F.array(rows), placed)[0]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + FURTHER) -> DataFrame:
    """``doc_id, text`` and ``spans``, an array of (start, rank, end, kind) sorted by start and rule order."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("body", F.xxhash64("text"))
    c = candidates(texts, rules).alias("c")
    t = texts.alias("t")
    joined = t.join(c, F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.body") == F.col("c.body")), "left").select(
        "t.doc_id", "t.text", "kinds")
    none = F.expr(f"cast(array() as {SPANS})")
    parts = []
    for order, rule in enumerate(rules):
        spans = spans_of(rule, order, F.col("text"))
        if mandatory(rule.pattern):
            spans = F.when(F.array_contains(F.coalesce("kinds", F.expr("cast(array() as array<string>)")), rule.kind), spans).otherwise(none)
        else:
            # a short first look: most texts have no match long enough
            spans = F.when(F.regexp_like(F.col("text"), F.lit(f"(?:{rule.pattern[:-1]}{{{rule.least},}})" if rule.pattern.endswith("]+") else rule.pattern)),
                           spans).otherwise(none)
        parts.append(spans)
    return joined.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
